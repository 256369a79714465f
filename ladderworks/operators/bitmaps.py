"""Events as bitmaps: which events a key was at, by tier and over all tiers, without a list of their ids.

Events get dense numbers; 32,768 of them share a bucket, whose bitmap has 4 KB. Bitmaps merge by a bitwise or, so that those
over all tiers, or over several periods, come from what is there. Ids are spelled out only where a table is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderworks.operators.ranking import ranks

#: Bytes of a bitmap.
BYTES = 4096
ALL = "ALL"


def event_numbers(rows: DataFrame) -> DataFrame:
    """Each event (EventID, EventDate, its first date) with its number, from 1 in the order of the ids."""
    events = rows.where("EventID IS NOT NULL").groupBy("EventID").agg(F.min("EventDate").alias("EventDate"))
    return ranks(events, F.col("EventID"), name="number")


def event_bitmaps(rows: DataFrame, numbers: DataFrame, key: str = "Deck") -> DataFrame:
    """Tier, key, bucket and bits of the events of each key, by tier and, as tier ALL, over all tiers, in one aggregation."""
    placed = rows.where(F.col(key).isNotNull()).join(numbers.select("EventID", "number"), "EventID").select("Tier", key, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    sets = placed.groupingSets([["Tier", key, "bucket"], [key, "bucket"]], "Tier", key, "bucket")
    found = sets.agg(F.bitmap_construct_agg("bit").alias("bits"), F.grouping("Tier").alias("_all"))
    return found.select(F.when(F.col("_all") == 1, ALL).otherwise(F.col("Tier")).alias("Tier"), key, "bucket", "bits")


def merged(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The bitmaps of each group, over whatever else told them apart."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Events of each group."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("Events"))


def _set_bits(bits: Column) -> Column:
    """Positions of the bits that are set; bytes without any are passed over."""
    byte = lambda i: F.conv(F.hex(F.substring(bits, i + 1, 1)), 16, 10).cast("int")
    some = F.filter(F.sequence(F.lit(0), F.lit(BYTES - 1)), lambda i: F.substring(bits, i + 1, 1) != F.lit(b"\x00"))
    return F.flatten(F.transform(some, lambda i: F.transform(F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: F.getbit(byte(i), b) == 1), lambda b: i * 8 + b)))


def spelled_out(bitmaps: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """The events of each group: the group, EventID and EventDate, a row each."""
    each = bitmaps.select(*by, "bucket", F.explode(_set_bits(F.col("bits"))).alias("bit"))
    at = numbers.select(F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").cast("int").alias("bit"), "EventID", "EventDate")
    return each.join(at, ["bucket", "bit"]).select(*by, "EventID", "EventDate")


def lists(bitmaps: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """EventIDs and EventDates of each group, sorted and joined by semicolons, for a table that is written out. A list is as
    long as its group has events."""
    rows = spelled_out(bitmaps, numbers, *by)
    ids = F.array_join(F.array_sort(F.collect_list("EventID")), ";")
    days = F.array_join(F.array_sort(F.collect_set(F.col("EventDate").cast("string"))), ";")
    return rows.groupBy(*by).agg(ids.alias("EventIDs"), days.alias("EventDates"))
