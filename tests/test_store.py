"""Stored tables that change by file, joins of bucketed tables, bitmaps of events, and histories that are rebuilt."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ladderworks.operators import bitmaps, league, state
from ladderworks.plans.file_queries import _bucketed
from ladderworks.sources.store import Conflict, KeyedTable


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_changes_are_those_of_the_whole_table(spark, tmp_path, kind):
    """Random changes, some of new keys between and beyond the others: after each the table is as if written anew."""
    rng = random.Random(2)
    key = (lambda k: k) if kind == "long" else (lambda k: f"k{k:05d}")
    rows = {(key(k), i): 0 for k in range(0, 3000, 3) for i in range(rng.randint(1, 3))}
    frame = lambda r: spark.createDataFrame([(*k, v) for k, v in r.items()], f"key {kind}, i int, v int")
    table = KeyedTable(spark, f"file://{tmp_path}/t", "key")
    assert table.create(frame(rows), 12).written == 12
    for n in range(1, 4):
        start = rng.randrange(2900)
        fresh = {(key(k), 0): n for k in range(start, start + 60, rng.choice([1, 2]))}
        if n == 3:
            fresh |= {(key(99_999), 0): n}
        before = table.manifest().count()
        change = table.replace(frame(fresh), 1)
        gone = {k for k, _ in fresh}
        rows = {k: v for k, v in rows.items() if k[0] not in gone} | fresh
        assert plain(table.read()) == plain(frame(rows))
        assert change.rewritten <= change.looked_into <= 4 and change.kept == before - change.rewritten and change.written == 1
    assert table.versions() == [1, 2, 3, 4] and table.read(1).where("v > 0").count() == 0
    assert table.vacuum(keep=1) >= 0 and table.versions() == [4] and plain(table.read()) == plain(frame(rows))


def test_files_without_a_key_in_question_stay(spark, tmp_path):
    """Keys that lie in a file's range, but not in the file, rewrite nothing."""
    table = KeyedTable(spark, f"file://{tmp_path}/t", "key")
    table.create(spark.range(0, 1000, 10).select(F.col("id").alias("key"), F.lit("a").alias("x")), 4)
    change = table.change(spark.createDataFrame([(5,), (401,), (None,)], "key long"), lambda old: old)
    assert (change.looked_into, change.rewritten, change.kept, change.written) == (2, 0, 4, 0) and table.read().count() == 100
    change = table.update(F.col("key").between(200, 220), {"x": F.lit("b")}, 1)
    assert change.rewritten == 1 and plain(table.read().where("x = 'b'").select("key")) == [(200,), (210,), (220,)]


def test_one_of_two_writers_wins(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first, second = KeyedTable(spark, path, "key"), KeyedTable(spark, path, "key")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "key long, x string")
    first.create(rows)
    with pytest.raises(Conflict):
        second.create(rows)

    def meanwhile(old):
        first.replace(spark.createDataFrame([(1, "first")], "key long, x string"))
        return old.withColumn("x", F.lit("second"))

    with pytest.raises(Conflict):
        second.change(rows.select("key"), meanwhile)
    assert plain(first.read()) == [(1, "first"), (2, "b")] and first.versions() == [1, 2]


def test_empty_tables_and_nulls(spark, tmp_path):
    rows = spark.createDataFrame([(None, "n"), (1, "a")], "key long, x string")
    empty = KeyedTable(spark, f"file://{tmp_path}/e", "key")
    with pytest.raises(FileNotFoundError):
        empty.read()
    empty.create(rows.limit(0))
    assert empty.read().count() == 0 and empty.replace(rows).version == 2 and plain(empty.read()) == plain(rows)
    assert empty.replace(rows.where("key = 1").withColumn("x", F.lit("z"))).version == 3 and plain(empty.read()) == [(1, "z"), (None, "n")]
    assert empty.replace(rows.limit(0)).rewritten == 0


def test_bucketed_tables_join_where_they_lie(spark, tmp_path):
    stored, fresh = _bucketed(spark, "/root/testdata/sf0.001")
    joined = league.name_drift(stored, fresh)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search(r"\bExchange\b", plan)


def test_bitmaps_over_several_buckets(spark):
    """Forty thousand events, of which each key has some; lists and counts by tier, over all, and merged."""
    n = 40_000
    rows = spark.range(n).select(F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("EventID"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("EventDate"), F.when(F.col("id") % 2 == 0, "32").otherwise("64").alias("Tier"), F.explode(F.expr("array('all', concat('m', id % 7), if(id % 9999 = 0, 'rare', NULL))")).alias("Deck"))
    numbers = bitmaps.event_numbers(rows).persist()
    bits = bitmaps.event_bitmaps(rows, numbers).persist()
    got = {(r.Tier, r.Deck): r.Events for r in bitmaps.counted(bits, "Tier", "Deck").collect()}
    want = {}
    for i in range(n):
        for d in ("all", f"m{i % 7}", *(["rare"] if i % 9999 == 0 else [])):
            for t in ("ALL", "32" if i % 2 == 0 else "64"):
                want[t, d] = want.get((t, d), 0) + 1
    assert got == want
    rare = [r for r in bitmaps.lists(bits.where("Deck = 'rare'"), numbers, "Tier").collect() if r.Tier == "ALL"][0]
    assert rare.EventIDs == "e00000;e09999;e19998;e29997;e39996" and rare.EventDates.count(";") == 4
    tiers = bits.where("Tier <> 'ALL' AND Deck <> 'all'")
    assert bitmaps.counted(bitmaps.merged(tiers, "Tier"), "Tier").agg(F.sum("Events")).first()[0] == n


def test_rebuilt_history_is_that_of_week_after_week(spark):
    rng = random.Random(4)
    runs = [(f"r{i:02d}", f"2026-{1 + i // 4:02d}-{1 + i % 4 * 7:02d}", f"2026-{1 + i // 4:02d}-{7 + i % 4 * 7:02d}") for i in range(12)]
    decks = [(p, d, a, round(rng.uniform(0, 9), 2)) for i, (p, *_) in enumerate(runs) if i not in (3, 7) for d, a in (("Storm", "Combo"), ("Burn", "Aggro"), ("Combo", "Storm")) if rng.random() < 0.8]
    history = []
    for week, (path, *_) in enumerate(sorted(runs, key=lambda r: (r[1], r[2], r[0])), 1):
        own = [(d, a, m) for p, d, a, m in decks if p == path]
        new = []
        for d, _, m in own:
            past = [x for name, _, x, _, _ in history if name == d][-4:]
            change = m - (sum(past) / len(past) if past else m)
            new.append((d, "Deck", m, week, "Rising" if change > 0.5 else "Falling" if change < -0.5 else "Stable"))
        for a in sorted({a for _, a, _ in own}):
            new.append((a, "Archetype", round(sum(m for _, b, m in own if b == a), 6), week, "Stable"))
        history += new
    df = spark.createDataFrame(decks, "path string, Deck string, Archetype string, Meta double")
    out = state.rebuilt_shares(spark.createDataFrame(runs, "path string, week_start string, week_end string"), df)
    assert sorted(map(tuple, out.select("Deck", "Level", "Meta", "WeekIndex", "Trend Label").collect())) == sorted(history)
