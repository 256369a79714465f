"""Sums that lie on a half come out the same in whatever order they are added."""

from pyspark.sql import functions as F

from ladderworks.functions.scoring import steady
from ladderworks.operators import metagame as M


def test_halves_of_sums(spark):
    rows = spark.createDataFrame([(4801.499999999999 / 100,), (48.015,), (48.01500000000002,), (51.98500000000001,), (51.985,), (0.125,), (None,)], "x double")
    assert [r.x for r in rows.select(steady("x").alias("x")).collect()] == [48.02, 48.02, 48.02, 51.98, 51.98, 0.12, None]
    decks = spark.createDataFrame([("A", 48.01499999999999, 0.5, 1, None)], "Archetype string, Meta double, Winrate double, Games long, MyWinrate double")
    assert M.roll_up_archetypes(decks).select(F.col("Meta")).first().Meta == 48.02
