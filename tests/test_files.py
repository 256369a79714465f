"""Sources, sinks and streams against plain files."""

import datetime
import html
import os
import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from ladderworks.functions import text as T
from ladderworks.operators import similarity
from ladderworks.operators.ranking import ranks
from ladderworks.operators.similarity import name_suggestions, nearest_labels
from ladderworks.sources import sinks, tables
from ladderworks.streaming.sync import sync_stream
from pyspark.sql import functions as F


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_csv_files_are_read_by_name(spark, tmp_path):
    """Eleven columns, nine in another order, a byte order mark, an empty file: every value stays in its column."""
    full = "EventDate,Format,Tier,PlayerCount,EventSlug,EventID,Place,Deck,Archetype,Pilot,LoginID\n2026-01-04,Modern,C32,32,slug-a,1.0,1,Jund,Midrange,Ann,77\n"
    write(tmp_path, "a.csv", full)
    write(tmp_path, "b.csv", "﻿EventID,EventDate,Format,Tier,EventSlug,Place,Deck,Archetype,Pilot\n2,2026-01-05,Modern,C64,slug-b,2,Storm,Combo,\"Lee, Bo\"\n")
    write(tmp_path, "c.csv", "")
    got = [r.asDict() for r in tables.typed_history(tables.read_csv(spark, str(tmp_path), tables.HISTORY)).orderBy("EventID").collect()]
    assert [(r["EventID"], r["PlayerCount"], r["EventSlug"], r["Place"], r["Deck"], r["Pilot"], r["LoginID"]) for r in got] == [("1", 32, "slug-a", 1, "Jund", "Ann", "77"), ("2", None, "slug-b", 2, "Storm", "Lee, Bo", "")]
    assert got[0]["EventDate"] == datetime.date(2026, 1, 4)
    one = tables.read_csv(spark, f"{tmp_path}/b.csv", ("EventID", "Pilot", "Extra")).collect()
    assert [tuple(r) for r in one] == [("2", "Lee, Bo", "")]
    assert tables.read_csv(spark, f"{tmp_path}/none", tables.HISTORY).count() == 0


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a,b", 'q"', ""), ("é", None, "x")], "a string, b string, c string")
    sinks.write_csv(rows, f"file://{tmp_path}/t", one_file=True)
    files = [f for f in os.listdir(tmp_path / "t") if f.endswith(".csv")]
    raw = open(tmp_path / "t" / files[0], "rb").read()
    assert len(files) == 1 and raw.startswith(b"a,b,c\n") and b"\r" not in raw
    assert sorted(map(tuple, tables.read_csv(spark, f"file://{tmp_path}/t", ("a", "b", "c")).collect())) == [("a,b", 'q"', ""), ("é", "", "x")]


def test_versions_stay_and_events_are_replaced(spark, tmp_path):
    rows = spark.createDataFrame([("1", 1), ("2", 2)], "EventID string, v int")
    sinks.write_by_event(rows, f"{tmp_path}/e")
    sinks.write_by_event(rows.where("EventID = '2'").withColumn("v", F.lit(9)), f"{tmp_path}/e")
    assert sorted((str(r.EventID), r.v) for r in spark.read.parquet(f"{tmp_path}/e").collect()) == [("1", 1), ("2", 9)]
    first = sinks.write_version(rows, f"{tmp_path}/v", "1")
    sinks.write_version(rows.limit(0), f"{tmp_path}/v", "2")
    assert spark.read.parquet(first).count() == 2


def test_oldest_versions_go(spark, tmp_path):
    rows = spark.range(1)
    for v in ("1", "2", "3", "4"):
        sinks.write_version(rows, f"{tmp_path}/v[x]", v, keep=2)
    sinks.write_csv(rows, f"{tmp_path}/v[x]/other")
    sinks.write_version(rows, f"{tmp_path}/v[x]", "5", keep=2)
    assert sorted(n for n in os.listdir(tmp_path / "v[x]") if not n.startswith(".")) == ["other", "version=4", "version=5"]
    with pytest.raises(ValueError):
        sinks.write_version(rows, f"{tmp_path}/v[x]", "6", keep=0)


def test_review_items_hold_what_waits(spark):
    nearest = spark.createDataFrame([(1, "Jund", 0.98764, "Jund", 0.5), (2, "Jund", 0.99, "Jund", 0.98), (3, None, 0.0, None, 0.0)], "deck_id int, nearest string, nearest_sim double, second string, second_sim double")
    rated = similarity.classified(nearest, spark.createDataFrame([(1, 1), (2, 2), (3, 9)], "deck_id int, Place int"))
    entries = spark.createDataFrame([(d, f"e{d}", "2026-01-04", "Modern", "Challenge", "C32", "Ann", "u") for d in (1, 2, 3)], "deck_id int, event_id string, date string, format string, kind string, tier string, pilot string, event_url string")
    cards = similarity.key_items(spark.createDataFrame([(1, "Bolt", 4), (1, "Bog", 2)], "deck_id int, item string, qty int"))
    got = similarity.review_items(rated, cards, entries)
    assert tuple(got.columns) == similarity.REVIEW
    want = [("e1", 1, "winner", "Jund", 0.988, "Jund", 0.5, "Bolt x4; Bog x2", ""), ("e3", 9, "library too small", "", 0.0, "", 0.0, "", "")]
    assert sorted(map(tuple, got.select("event_id", "place", "reason", "nearest_label", "nearest_sim", "second_label", "second_sim", "key_cards", "resolved_deck").collect())) == want


def test_bracket_lists_are_left_out(spark, tmp_path):
    head = ",".join(tables.MATCHES)
    write(tmp_path, "1.csv", f"{head}\n1,2026-01-04,C32,Challenge,F,A,1,B,2,2,0,Jund,Storm\n")
    write(tmp_path, "_without.csv", "EventID\n9\n")
    assert [r.EventID for r in tables.bracket_matches(spark, str(tmp_path), "2026-01-01", "2026-02-01").collect()] == ["1"]


def test_stream_keeps_resolved_decks_and_other_months(spark, tmp_path):
    head = "EventID,EventDate,Format,Tier,Place,Deck,Archetype,Pilot\n"
    table = f"{tmp_path}/table"

    def run():
        sync_stream(spark, f"{tmp_path}/in", table, f"{tmp_path}/check").awaitTermination()
        return sorted((r.EventID, r.Month, r.Deck, r.Pilot) for r in spark.read.option("mergeSchema", True).parquet(table).withColumn("Month", F.col("Month").cast("string")).collect())

    write(f"{tmp_path}/in", "a.csv", head + "1,2026-01-04,Modern,C32,1,Jund,Mid,Ann\n1,2026-01-04,Modern,C32,2,Storm,Combo,Bo\n2,2026-02-04,Modern,C32,1,Elves,Creature,Cy\n")
    assert run() == [("1", "2026-01", "Jund", "Ann"), ("1", "2026-01", "Storm", "Bo"), ("2", "2026-02", "Elves", "Cy")]
    february = {f: os.path.getmtime(f"{table}/Month=2026-02/{f}") for f in os.listdir(f"{table}/Month=2026-02")}
    write(f"{tmp_path}/in", "b.csv", "Pilot,Deck,EventID,EventDate,Format,Tier,Place,Archetype\nAnn,NEEDS_MANUAL_REVIEW,1,2026-01-04,Modern,C32,1,x\nDi,Burn,1,2026-01-04,Modern,C32,2,Aggro\n")
    assert run() == [("1", "2026-01", "Burn", "Di"), ("1", "2026-01", "Jund", "Ann"), ("2", "2026-02", "Elves", "Cy")]
    assert february == {f: os.path.getmtime(f"{table}/Month=2026-02/{f}") for f in os.listdir(f"{table}/Month=2026-02")}
    assert run() == [("1", "2026-01", "Burn", "Di"), ("1", "2026-01", "Jund", "Ann"), ("2", "2026-02", "Elves", "Cy")]


def test_stream_reads_names_with_blanks_and_empty_files(spark, tmp_path):
    """Files are found by their names alone: one with a blank in its name, and one without a line, which changes nothing."""
    table = f"{tmp_path}/table"
    write(f"{tmp_path}/in", "a b%20c.csv", "EventID,EventDate,Format,Tier,Place,Deck,Archetype,Pilot\n1,2026-01-04,Modern,C32,1,Jund,Mid,Ann\n")
    write(f"{tmp_path}/in", "none.csv", "")
    sync_stream(spark, f"{tmp_path}/in", table, f"{tmp_path}/check").awaitTermination()
    assert [(r.EventID, r.Deck) for r in spark.read.parquet(table).collect()] == [("1", "Jund")]


def test_documents_by_name(spark, tmp_path):
    """Many documents make few files, each with its own range of names; a second write replaces the first."""
    rows = spark.range(5000).select(F.format_string("name %05d", "id").alias("name"), F.to_json(F.struct("id")).alias("doc"))
    for n in (5000, 4000):
        sinks.write_documents(rows.limit(n).repartition(7), f"{tmp_path}/docs", F.col("name"), F.col("doc"))
    found = spark.read.parquet(f"{tmp_path}/docs")
    assert found.count() == 4000
    files = found.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("name").alias("a"), F.max("name").alias("b")).orderBy("a").collect()
    assert len(files) <= 16 and all(x.b < y.a for x, y in zip(files, files[1:], strict=False))


def test_suggestions_as_by_comparing_all(spark):
    known = ["goblin guide", "goblin gide", "lightning bolt", "lightning helix", "tarmogoyf", "Tarmogoyf", "aa", "island"]
    new = ["goblin guid", "lightnin bolt", "lightning hlix", "tarmogof", "ab", "aaa", "dnalsi", "island", "", None]
    name = lambda xs: spark.createDataFrame([(x,) for x in xs], "name string")
    got = {r.name: (r.suggestion, r.confidence) for r in name_suggestions(name(new), name(known)).collect()}
    want = {}
    for n in filter(None, new):
        if best := get_close_matches(n, sorted(known), 1, 0.74):
            want[n] = (best[0], round(SequenceMatcher(None, n, best[0]).ratio(), 2))
    assert got == want


def test_character_references_as_by_the_standard_library(spark):
    texts = ["a &amp;lt; b &lt;c&gt;", "&#65;&#x42; &eacute;&Eacute; &copy; &euro;", "&nbsp;x&nbsp; y", "no &such; thing & more", "&#55296; &#39;", "", "&apos;&quot;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.unescaped(F.col("t")).alias("u"), T.strip_html("t").alias("s")).collect()
    for r in rows:
        want = r.t.replace("&#55296;", "&#55296;") if "55296" in r.t else html.unescape(r.t)
        assert r.u == want.replace("&#39;", "'"), r.t
        assert r.s == " ".join(r.u.split())


def test_ranks_are_those_of_one_sort(spark):
    rows = spark.range(5000).select("id", (F.xxhash64("id") % 40).alias("x"))
    got = [r.id for r in ranks(rows, -F.col("x"), F.col("id")).orderBy("Rank").collect()]
    assert got == [r.id for r in rows.orderBy(F.desc("x"), "id").collect()]
    assert [r.Rank for r in ranks(rows.limit(1), F.col("id")).collect()] == [1] and ranks(rows.limit(0), F.col("id")).count() == 0


def test_nearest_labels_alike_with_a_salted_library(spark, monkeypatch):
    decks = spark.createDataFrame([(d, f"i{(d * 7 + k) % 9}", 1 + k % 3) for d in range(12) for k in range(5)], "deck_id int, item string, qty int").dropDuplicates(["deck_id", "item"])
    library = decks.selectExpr("deck_id + 100 AS lib_id", "concat('L', deck_id % 3) AS label", "item", "qty")
    rows = lambda: sorted(map(tuple, nearest_labels(decks, library).collect()))
    want = rows()
    monkeypatch.setattr(similarity, "LIBRARY", 1)
    assert rows() == want and len(want) == 12


def test_labels_at_the_bound_are_those_of_all_pairs(spark):
    """Random decks and edits of them: the same neighbours as by comparing everything, from few candidates."""
    rng = random.Random(3)
    pool = [f"c{i}" for i in range(400)]
    base = [{c: rng.randint(1, 4) for c in rng.sample(pool, 20)} for _ in range(60)]
    edited = lambda d, k: {c: q for c, q in list(d.items())[k:]} | {rng.choice(pool): rng.randint(1, 4) for _ in range(k)}
    library = [(f"L{i % 7}", d) for i, d in enumerate(base)] + [(f"L{i % 5}", edited(d, i % 4)) for i, d in enumerate(base)] + [("L1", base[0]), ("L2", base[0])]
    decks = [edited(d, i % 3) for i, d in enumerate(base)] + [base[0], base[0], {"only": 1}, {"c0": 1000}, {"c0": 900, "c1": 1}]
    rows = lambda ds: [(i, c, q) for i, d in enumerate(ds) for c, q in d.items()]
    own = spark.createDataFrame(rows(decks), "deck_id int, item string, qty int")
    theirs = spark.createDataFrame([(i, library[i][0], c, q) for i, c, q in rows([d for _, d in library])], "lib_id int, label string, item string, qty int")

    def sim(a, b):
        return sum(min(a.get(c, 0), b.get(c, 0)) for c in a.keys() | b.keys()) / sum(max(a.get(c, 0), b.get(c, 0)) for c in a.keys() | b.keys())

    want = {}
    for i, d in enumerate(decks):
        (s1, _, l1), (s2, _, l2) = sorted((-sim(d, e), j, label) for j, (label, e) in enumerate(library))[:2]
        want[i] = (l1, round(-s1, 6), l2 if s2 else None, round(-s2, 6)) if -s1 >= 0.9 else (None, 0.0, None, 0.0)
    got = {r.deck_id: (r.nearest, r.nearest_sim, r.second, r.second_sim) for r in similarity.labels_at(own, theirs).collect()}
    assert got == want and sum(v[0] is not None for v in want.values()) > 30
    pairs = similarity.candidate_pairs(similarity.bags(own, "deck_id")[0], similarity.bags(theirs, "lib_id")[0], 0.9).count()
    assert pairs < 0.1 * len(decks) * len(library)
    empty = similarity.labels_at(own, theirs.limit(0)).collect()
    assert len(empty) == len(decks) and all(r.nearest is None for r in empty) and similarity.labels_at(own.limit(0), theirs).count() == 0
