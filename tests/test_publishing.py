"""What a run leaves to see when its checks or its completeness speak against it."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ladderworks.operators import invariants, publishing

COLUMNS = "check_id string, severity string, key string, detail string"


def state(spark, rows):
    registry = spark.createDataFrame([(i, "2026-07-20", size, kind) for i, size, kind, _ in rows], "EventID string, EventDate string, size int, kind string")
    history = spark.createDataFrame([(f"{i}.0", "Modern ") for i, *_, there in rows if there], "EventID string, Format string")
    return publishing.registry_state(registry, history, "modern")


def summary(spark, rows, premier=()):
    events = spark.createDataFrame([tuple(p) for p in premier], "date string, event_type string, event_id string")
    return publishing.completeness(state(spark, rows), publishing.premier_note(events, "Modern", "2026-07-13", "2026-07-26"))


def seen(path):
    return sorted(f for f in os.listdir(path) if not f.startswith("."))


@pytest.fixture
def tables(spark):
    return {"decks": spark.range(3), "pilots": spark.range(5)}


WHOLE = [("1", 64, "challenge", True), ("2", 32, "challenge", True), ("3", None, "premier", False), ("4", None, "ignored", False)]


def test_everything_is_published(spark, tmp_path, tables):
    none = spark.createDataFrame([("sums", "warn", "x", "1/2")], COLUMNS)
    out = publishing.publish(tables, none, summary(spark, WHOLE, [("2026-07-25", "Showcase", "9"), ("2026-07-19", "Super Qualifier", "8")]), str(tmp_path), window=("a", "b"), meta_window=("a", "b"))
    assert (out.state, out.counts) == ("full", {"fatal": 0, "hard": 0, "warn": 1})
    assert seen(tmp_path) == ["statistics", "statistics.status.json"]
    assert spark.read.parquet(f"{out.folder}/decks").count() == 3 and spark.read.parquet(f"{out.folder}/violations").count() == 1
    said = json.loads((tmp_path / "statistics.status.json").read_text())
    assert said["complete"] and not said["partial"] and said["window_consistent"] and said["rows"] == {"decks": 3, "pilots": 5}
    assert (said["registry_count"], said["fetched_count"], said["premier_count"], said["missing"]) == (2, 2, 1, [])
    assert said["tier_counts_registry"] == {"64": 1, "32": 1} and said["premier_note"] == "2026-07-19 Super Qualifier (8); 2026-07-25 Showcase (9)"
    again = publishing.publish({"decks": spark.range(7)}, none, summary(spark, WHOLE), str(tmp_path))
    assert spark.read.parquet(f"{again.folder}/decks").count() == 7 and seen(tmp_path) == ["statistics", "statistics.status.json"]


def test_incomplete_runs_are_withheld_or_marked(spark, tmp_path, tables):
    none = spark.createDataFrame([], COLUMNS)
    rows = [*WHOLE, ("99999999", 64, "challenge", False)]
    out = publishing.publish(tables, none, summary(spark, rows), str(tmp_path))
    assert (out.state, out.folder) == ("withheld", None) and seen(tmp_path) == ["statistics.status.json"]
    said = json.loads((tmp_path / "statistics.status.json").read_text())
    assert (said["complete"], said["registry_count"], said["fetched_count"]) == (False, 3, 2) and said["missing"] == [{"EventID": "99999999", "EventDate": "2026-07-20", "Status": "MISSING", "Reason": "not present in history_csv"}]
    assert said["premier_note"] == "No Modern premier events in window 2026-07-13..2026-07-26 (registry checked)"
    out = publishing.publish(tables, none, summary(spark, rows), str(tmp_path), allow_partial=True)
    assert out.state == "partial" and seen(tmp_path) == ["statistics.status.json", "statistics_PARTIAL"]
    assert json.loads((tmp_path / "statistics.status.json").read_text())["partial"] is True


def test_a_registry_that_was_not_read_is_incomplete(spark, tmp_path, tables):
    none = spark.createDataFrame([], COLUMNS)
    assert publishing.publish(tables, none, None, str(tmp_path)).state == "withheld"
    said = json.loads((tmp_path / "statistics.status.json").read_text())
    assert said["complete"] is False and said["registry_count"] is None and said["premier_count"] is None and said["premier_note"] == "Premier scan did not complete"
    assert publishing.publish(tables, none, summary(spark, [("3", None, "premier", False)]), str(tmp_path)).state == "withheld"


@pytest.mark.parametrize("change", [{"registry_count": None}, {"premier_count": None}])
def test_contradictions_are_errors(spark, tmp_path, tables, change):
    one = summary(spark, WHOLE).withColumns({c: F.lit(v).cast("long") for c, v in change.items()})
    with pytest.raises(AssertionError):
        publishing.publish(tables, spark.createDataFrame([], COLUMNS), one, str(tmp_path))
    assert seen(tmp_path) == []


def test_other_window_of_the_market_share(spark, tmp_path, tables):
    out = publishing.publish(tables, spark.createDataFrame([], COLUMNS), summary(spark, WHOLE), str(tmp_path), window=("a", "b"), meta_window=("a", "c"))
    assert (out.state, out.reason) == ("withheld", "windows differ") and seen(tmp_path) == ["statistics.status.json"]
    assert json.loads((tmp_path / "statistics.status.json").read_text())["window_consistent"] is False


@pytest.mark.parametrize("severity", ["hard", "fatal"])
def test_violations_withhold_the_tables(spark, tmp_path, tables, severity):
    found = spark.createDataFrame([("places", severity, "12", "31/31"), ("all_sums", "warn", "ALL", "")], COLUMNS)
    if severity == "fatal":
        with pytest.raises(AssertionError, match="places 12"):
            publishing.publish(tables, found, summary(spark, WHOLE), str(tmp_path))
    else:
        assert publishing.publish(tables, found, summary(spark, WHOLE), str(tmp_path)).reason == "checks"
    assert seen(tmp_path) == ["statistics.status.json"]
    said = json.loads((tmp_path / "statistics.status.json").read_text())
    assert said["invariant_problems"] == ["places 12: 31/31"] and said["complete"] is False


def test_a_job_that_fails_shows_nothing(spark, tmp_path, tables):
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        publishing.publish({**tables, "broken": broken}, spark.createDataFrame([], COLUMNS), summary(spark, WHOLE), str(tmp_path))
    assert [f for f in seen(tmp_path) if not f.startswith("_")] == []


def test_full_size_events(spark):
    """Places 1 to 32; one short, one twice, one beyond, a place that is missing, an id that is missing."""
    rows = [(e, "2026-01-01", "64", p, f"P{p}", str(p)) for e in "abcdef" for p in range(1, 33)]
    rows = [r for r in rows if (r[0], r[3]) != ("b", 32)]
    edit = {("c", 5): 6, ("d", 32): 33, ("e", 7): None}
    rows = [(*r[:3], edit.get((r[0], r[3]), r[3]), *r[4:]) for r in rows] + [(None, "2026-01-01", "64", 1, "P", "")]
    df = spark.createDataFrame(rows, "EventID string, EventDate string, Tier string, Place int, Pilot string, LoginID string")
    got = sorted((r.key, r.check_id, r.detail) for r in invariants.event_rules(df).collect())
    assert got == [("b", "places", "31/31"), ("b", "rows", "31"), ("c", "places", "32/31"), ("d", "places", "32/31"), ("e", "places", "31/31")]
