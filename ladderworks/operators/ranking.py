"""Ranks over a whole table, without a window that sends all its rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.sources.scratch import cut

#: Fixed value: bits of `monotonically_increasing_id` that count the rows of a partition; those above number the partition.
ROW_BITS = 33


def ranks(rows: DataFrame, *keys: Column, name: str = "Rank") -> DataFrame:
    """Adds the place of each row by the ascending keys, from 1. The keys must tell all rows apart.

    Rows are dealt out once by ranges of the keys, as many as the session's partitions or, if it adapts them, as the rows
    need. Each range is sorted, numbered and written; a row's place is its number after the counts of the ranges before. The
    ranges may differ from run to run, the places don't.
    """
    named = [f"_k{i}" for i in range(len(keys))]
    keyed = rows.select("*", *(k.alias(n) for k, n in zip(keys, named, strict=True)))
    placed = keyed.repartitionByRange(*named).sortWithinPartitions(*named).drop(*named)
    placed = cut(placed.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", ROW_BITS))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_range").alias("_r"), (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # a row for each range
    place = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1) + F.col("_before") + 1
    return placed.join(F.broadcast(before), F.col("_range") == F.col("_r")).withColumn(name, place.cast("int")).drop("_at", "_range", "_r", "_before")
