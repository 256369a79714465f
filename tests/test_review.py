"""Reviews, rescans to a fixed point, states of events, and the stream that asks again."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ladderworks.operators import review
from ladderworks.operators import rules as R
from ladderworks.operators.state import SENTINEL
from ladderworks.streaming import pending

RULES = "pattern string, target string, match_type string, priority int, ordinal long"


def sim(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a.get(c, 0), b.get(c, 0)) for c in keys) / sum(max(a.get(c, 0), b.get(c, 0)) for c in keys)


def scanned(rows, bags, rounds):
    """row_id -> label after so many rounds, every deck compared with the whole library each time."""
    labels, done = {i: d for i, _, d in rows}, 0
    while rounds is None or done < rounds:
        done += 1
        library = [(i, d) for i, d in sorted(labels.items()) if d != SENTINEL and i in bags]
        new = {}
        for i, place, _ in rows:
            if labels[i] == SENTINEL and i in bags and len(library) > 1:
                (s1, _, l1), (_, _, l2) = sorted((-sim(bags[i], bags[j]), j, d) for j, d in library)[:2]
                if place != 1 and l1 == l2 and -s1 >= (0.95 if place <= 8 else 0.9):
                    new[i] = l1
        if not new:
            break
        labels |= new
    return labels, done


@pytest.mark.parametrize("rounds", [1, None])
def test_rescan_is_that_of_comparing_everything(spark, rounds):
    """Chains of decks, each near to the next only, so that a label moves on by one deck a round."""
    rng = random.Random(6)
    rows, bags = [], {}
    for chain in range(3):
        deck = {f"c{chain}-{k}": 4 for k in range(15)}
        for step in range(4):
            i = chain * 10 + step
            deck = dict(list(deck.items())[1:]) | {f"x{i}": 1} if step else deck
            bags[i] = dict(deck)
            rows.append((i, rng.choice([12, 20, 30]) if step < 3 else 1, f"L{chain}" if step == 0 else SENTINEL))
            if step == 0:
                bags[i + 1000] = dict(deck)
                rows.append((i + 1000, 9, f"L{chain}"))
    bags |= {500: {"odd": 60}, 501: dict(bags[0])}
    rows += [(500, 20, SENTINEL), (501, 3, "other"), (502, 20, SENTINEL)]  # 501 is like chain 0 and says something else; 502 has no deck
    history = spark.createDataFrame([(*r, "old") for r in rows], "row_id long, Place int, Deck string, Archetype string")
    cards = spark.createDataFrame([(i, c, q) for i, d in bags.items() for c, q in d.items()], "row_id long, item string, qty int")
    rules = spark.createDataFrame([("L1", "One", "exact", 1, 1)], RULES)
    mappings = R.load_mappings(spark.createDataFrame([("l2", "x", "Two", 1)], "raw_name string, canonical_name string, archetype string, ordinal long"))
    found, waiting, done = review.rescan(history, cards, rules, mappings, rounds=rounds)
    want, steps = scanned(rows, bags, rounds)
    got = {r.row_id: r for r in found.collect()}
    assert {i: r.Deck for i, r in got.items()} == want and done == steps
    named = {"L0": "Unknown", "L1": "One", "L2": "Two"}
    assert all(r.Archetype == ("old" if d != SENTINEL or r.Deck == SENTINEL else named[r.Deck]) for i, _, d in rows for r in [got[i]])
    left = {r.row_id: r.reason for r in waiting.collect()}
    assert set(left) == {i for i, _, _ in rows if want[i] == SENTINEL and i in bags} and left[500] == "too far"
    assert sum(v != SENTINEL for v in want.values()) >= 9 and (rounds or done >= 3)


def test_rescan_with_nothing_to_do(spark):
    history = spark.createDataFrame([(1, 2, "A", "x")], "row_id long, Place int, Deck string, Archetype string")
    cards = spark.createDataFrame([(1, "c", 1)], "row_id long, item string, qty int")
    none = spark.createDataFrame([], RULES)
    maps = spark.createDataFrame([], "raw_name string, canonical_name string, archetype string, ordinal long")
    found, waiting, _ = review.rescan(history, cards, none, maps, rounds=None)
    assert [tuple(r) for r in found.collect()] == [(1, 2, "A", "x")] and waiting.count() == 0


def test_selections_in_order(spark):
    history = spark.createDataFrame([("1.0", " Ann ", "d", "a"), ("1", "Bo", "d", "a"), ("2", "Cy", "d", "a"), ("2", "Cy", "e", "a")], "EventID string, Pilot string, Deck string, Archetype string")
    chosen = spark.createDataFrame([("1", "Ann", "first", 1), ("1", "Ann", "Boros Burn", 2), ("1", "Bo", " ", 3), ("2", "Cy", "x", 4), ("9", "Di", "x", 5)], "event_id string, pilot string, resolved_deck string, ordinal long")
    none, maps = spark.createDataFrame([], RULES), spark.createDataFrame([], "raw_name string, canonical_name string, archetype string, ordinal long")
    rows, outcomes = review.apply_selections(history, chosen, none, none, maps)
    assert sorted(map(tuple, rows.collect())) == [("1", "Bo", "d", "a"), ("1.0", " Ann ", "Boros Burn", "Aggro"), ("2", "Cy", "d", "a"), ("2", "Cy", "e", "a")]
    assert [r.outcome for r in outcomes.orderBy("ordinal").collect()] == ["applied", "applied", "skipped", "ambiguous", "not_found"]


def test_stream_asks_again_until_an_event_is_there(spark, tmp_path):
    """Four events over three files: one is found late, one is never published, one is there at once, one fails."""
    start = datetime.datetime(2026, 7, 1)
    at = lambda minutes: start + datetime.timedelta(minutes=minutes)
    files = [
        [("late", "PENDING", at(0)), ("never", "PENDING", at(0)), ("there", "OK", at(1)), ("bad", "PENDING", at(0)), ("bad", "ERROR", at(2))],
        [("late", "PENDING", at(70)), ("clock", "OK", at(200))],
        [("late", "OK", at(201)), ("clock", "OK", at(500))],
        [("clock", "OK", at(900))],
        [("clock", "OK", at(1300))],
        [("clock", "OK", at(1700))],
    ]
    schema = "EventID string, status string, ts timestamp"
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(files):
        frame = pd.DataFrame(rows, columns=["EventID", "status", "ts"])
        frame["ts"] = frame["ts"].astype("datetime64[us]")
        frame.to_parquet(tmp_path / "in" / f"{i}.parquet")
        import os

        os.utime(tmp_path / "in" / f"{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = pending.asked_again(stream, wait_seconds=3600, tries=2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).where(F.col("EventID") != "clock").collect():
        got.setdefault(r.EventID, []).append((r.what, r.tried))
    assert got["there"] == [("found", 0)] and got["bad"] == [("failed", 0)]
    assert sorted(got["never"]) == [("ask", 1), ("ask", 2), ("given up", 3)]
    assert ("found", 0) in got["late"] or ("found", 1) in got["late"]
    assert all(what in ("ask", "found") for what, _ in got["late"])
