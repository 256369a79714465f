"""Exact deduplication with a split for heavy hitters.

Misra-Gries summaries of each partition's digests name the digests that may be frequent. Their exact counts and winners
are verified in one aggregation and broadcast (at most `counters` rows), so that the rows of large groups of copies are
judged map-side and never shuffled. All other digests take an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.llm.common import boxed, scratch, stripped

#: Counters of a Misra-Gries summary, and the most digests that are broadcast.
COUNTERS = 1024


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> dict[bytes, int]:
    """At most `counters` values with lower bounds of their counts; any value above 1/(counters + 1) of all is among them."""
    held: dict[bytes, int] = {}
    for batch in batches:
        found = pc.value_counts(batch.column(0))
        for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
            held[value] = held.get(value, 0) + n
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: n - cut for k, n in held.items() if n > cut}
    return held


def _order() -> Column:
    """Of equal texts the longest original comes first, then the smallest id (null last), then the first row."""
    return F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count("*").alias("size"), F.min(_order()).alias("first")).select("digest", "size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without white space; a null text is an empty one, and all empty texts are equal.
    The row with the most code points in its original text stays; ties go to the smallest id, a null id coming last; of
    rows that repeat an id and a text one stays. An empty table gives an empty result; other columns are ignored.
    """
    text = F.col(text_col)
    rows = scratch(docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(stripped(text), 256)).alias("digest"), F.coalesce(F.char_length(text), F.lit(0)).alias("n"), F.monotonically_increasing_id().alias("row")))

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries(batches, counters)
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["digest", "low"])

    named = rows.select("digest").mapInArrow(summary, "digest binary, low long").groupBy("digest").agg(F.sum("low").alias("low")).orderBy(F.desc("low"), "digest").limit(counters).select("digest")
    heavy = scratch(_winners(rows.join(F.broadcast(named), "digest", "left_semi")).where("size > 1"))
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    light = rows.join(F.broadcast(heavy), "digest", "left_anti")
    judged = marked.where("keep_row is not null").unionByName(light.join(_winners(light), "digest"))
    return judged.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of `docs` that stay, with all columns; of rows that repeat an id and a text, one with the longest text stays."""
    judged = scratch(exact_copies(docs, id_col, text_col, counters))
    seen = judged.groupBy(F.col("doc_id").alias("key"), F.unhex("text_sha256").alias("sha")).agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    text = F.col(text_col)
    known = boxed(docs, id=F.col(id_col), digest=F.unhex(F.sha2(stripped(text), 256)), length=F.char_length(text))
    same = F.col("id").eqNullSafe(F.col("key")) & (F.col("digest") == F.col("sha"))
    left = known.join(seen.where("not stays").hint("shuffle_hash"), same, "left_anti")
    again = seen.where("stays and n > 1")
    if again.take(1):
        first = Window.partitionBy("id", "digest").orderBy(F.desc("length"), F.xxhash64("doc"))
        once = left.join(again, same, "left_semi").withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.select("doc.*")
