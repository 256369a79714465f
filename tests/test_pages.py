"""Stored answers of a paged service, with pages that are missing, broken or empty."""

import json
import os

import pytest

from ladderworks.sources import pages

CALL = ("calendar", "list", 3, {"from": "]1"})


def store(folder, source, page, body):
    name = pages.file_name("calendar", {"from": "]1", "c:limit": 3, "c:start": 3 * page})
    os.makedirs(f"{folder}/{source}", exist_ok=True)
    with open(f"{folder}/{source}/{name}", "w", encoding="utf-8") as f:
        f.write(body if isinstance(body, str) else json.dumps({"list": body}))


def rows(spark, folder):
    return sorted((r.page, r.source, json.loads(r.value)["id"]) for r in pages.all_rows(spark, f"file://{folder}", *CALL).collect())


def ids(*numbers):
    return [{"id": n, "text": "é"} for n in numbers]


def test_first_source_that_answers(spark, tmp_path):
    store(tmp_path, "primary", 0, ids(1, 2, 3))
    store(tmp_path, "primary", 1, '{"list": [{"id"')  # broken
    store(tmp_path, "backup", 1, '["no object"]')
    store(tmp_path, "cache", 1, ids(4, 5, 6))
    store(tmp_path, "backup", 2, ids(7, 8, 9))  # missing at the service
    store(tmp_path, "primary", 3, [])
    assert rows(spark, tmp_path) == [(0, "primary", 1), (0, "primary", 2), (0, "primary", 3), (1, "cache", 4), (1, "cache", 5), (1, "cache", 6), (2, "backup", 7), (2, "backup", 8), (2, "backup", 9)]


def test_a_short_page_is_the_last(spark, tmp_path):
    store(tmp_path, "primary", 0, ids(1, 2))
    store(tmp_path, "primary", 1, ids(3))
    store(tmp_path, "primary", 2, "broken")
    assert rows(spark, tmp_path) == [(0, "primary", 1), (0, "primary", 2)]


@pytest.mark.parametrize("body", [None, "broken"])
def test_a_page_that_nobody_can_answer_is_an_error(spark, tmp_path, body):
    store(tmp_path, "primary", 0, ids(1, 2, 3))
    if body:
        store(tmp_path, "cache", 1, body)
        store(tmp_path, "primary", 2, ids(9))
    with pytest.raises(Exception, match="no answer for calendar, page 1"):
        rows(spark, tmp_path)


def test_nothing_stored_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no answer for calendar, page 0"):
        rows(spark, tmp_path)


def test_only_the_pages_in_question_are_asked_for(spark, tmp_path):
    for p in range(5):
        store(tmp_path, "primary", p, ids(3 * p, 3 * p + 1, 3 * p + 2))
    found = pages.pages(spark, f"file://{tmp_path}", *CALL)
    assert found.rdd.getNumPartitions() == 6
    some = found.where("page >= 1 AND page < 5 AND page IN (0, 2, 3, 9) AND value LIKE '%7%'")
    assert some.rdd.getNumPartitions() == 2 and [json.loads(r.value)["id"] for r in some.collect()] == [7]
    assert found.where("page = 4").count() == 3 and found.where("page > 7").count() == 0


def test_answers_are_stored_and_found_again(spark, tmp_path):
    name = pages.file_name("calendar", {"from": "]1", "c:limit": 3, "c:start": 0})
    df = spark.createDataFrame([("primary", name, None), ("cache", name, json.dumps({"list": ids(5)}))], "source string, name string, body string")
    pages.store_answers(df, f"file://{tmp_path}")
    assert rows(spark, tmp_path) == [(0, "cache", 5)]
    assert sorted(os.listdir(tmp_path)) == ["cache", "primary"] and os.listdir(tmp_path / "cache") == [name]


def test_calendar_rows_that_are_no_challenge(spark):
    odd = [
        {"description": "Modern Challenge 64", "starttime": "2026-07-05 10:00", "tournamentid": "007"}, {"description": "Modern Challenge 64", "starttime": "2026-07-05 11:00", "tournamentid": 7},
        {"description": "modern challenge", "minimumplayers": "32", "starttime": "2026-07-06T", "tournamentid": 8}, {"description": "modern challenge", "minimumplayers": "many", "starttime": "2026-07-06T", "tournamentid": 9},
        {"description": "Modern Challenge 0", "starttime": "2026-07-06", "tournamentid": 10}, {"description": "Modern Challenge 64 x", "starttime": "2026-07-06", "tournamentid": 11},
        {"description": "Modern Challenge 64", "starttime": "2026-13-06", "tournamentid": 12}, {"description": "Modern Challenge 64", "starttime": "2026-07", "tournamentid": 13},
        {"description": "Modern Challenge 64", "starttime": "2026-08-06", "tournamentid": 14}, {"description": "Modern Challenge 64", "starttime": "2026-07-06", "tournamentid": "x1"}, {"description": None}, {},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in odd] + [("broken",), (None,)], "value string")
    got = sorted((str(r.EventDate), r["size"], r.event_id, r.slug) for r in pages.calendar_events(df, "Modern", "2026-07-01", "2026-07-31").collect())
    assert got == [("2026-07-05", 64, "7", "modern-challenge-64-2026-07-057")] * 2 + [("2026-07-06", 32, "8", "modern-challenge-32-2026-07-068")]  # 007 and 7 are two ids


def test_pages_share_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    names = [(n, pages.file_name("calendar", {"from": "]1", "c:limit": 3, "c:start": 3 * n})) for n in range(600)]
    answers = spark.createDataFrame(names, "page int, name string").select(F.lit("cache").alias("source"), "name", F.when(F.col("page") < 599, F.lit('{"list": [{"id": 1}, {"id": 2}, {"id": 3}]}')).otherwise('{"list": []}').alias("body"))
    pages.store_answers(answers, f"file://{tmp_path}")
    found = pages.pages(spark, f"file://{tmp_path}", *CALL)
    assert found.rdd.getNumPartitions() == 301 and found.where("source IS NOT NULL").select("page").distinct().count() == 600
    assert pages.all_rows(spark, f"file://{tmp_path}", *CALL).count() == 3 * 599
