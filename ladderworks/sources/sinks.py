"""Writers. Tables are written whole or by partition, so that a failed job leaves what was there before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket, on average, where the number of buckets is made to fit.
BUCKET_ROWS = 400_000


def write_csv(rows: DataFrame, path: str, *, one_file: bool = False) -> None:
    """CSV with a header and plain line ends. `one_file` is for small tables."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("header", True).option("lineSep", "\n").option("emptyValue", "").csv(path)


def statistics_sheets(status: DataFrame, tiers: list[str], decks: DataFrame, archetypes: DataFrame, all_decks: DataFrame, all_archetypes: DataFrame, pilots: DataFrame) -> dict[str, DataFrame]:
    """The sheets of a run in order: STATUS, of each tier its decks and archetypes, ALL_Decks, ALL_Archetypes, BestPilots.

    Presence tables go down by event frequency, then by the number of events, then by name; pilots by their rank.
    """
    down = lambda rows, key: rows.orderBy(F.desc("Top32EventFreqPct"), F.desc("Top32EventCount"), key)
    sheets = {"STATUS": status}
    for tier in tiers:
        of = F.col("Tier") == tier
        sheets |= {f"C{tier}_Decks": down(decks.where(of), "Deck"), f"C{tier}_Archetypes": down(archetypes.where(of), "Archetype")}
    return sheets | {"ALL_Decks": down(all_decks, "Deck"), "ALL_Archetypes": down(all_archetypes, "Archetype"), "BestPilots": pilots.orderBy("Rank")}


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One folder per sheet, numbered in their order, each one file in the order of its rows."""
    for i, (name, rows) in enumerate(sheets.items(), 1):
        write_csv(rows, f"{path}/{i:02d}_{name}", one_file=True)


def write_by(rows: DataFrame, path: str, *keys: str) -> None:
    """Replaces the partitions of the keys that are in `rows` and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_by_event(rows: DataFrame, path: str) -> None:
    """Replaces the partitions of the events in `rows` and leaves those of others."""
    write_by(rows, path, "EventID")


def buckets_of(rows: DataFrame, least: int = 8) -> int:
    """Buckets for a table whose rows are cheap to count (such as files): at least `least`, and so many that one holds
    BUCKET_ROWS rows on average, so that a task of a join has no more to sort however large the table is."""
    return max(least, -(-rows.count() // BUCKET_ROWS))


def write_bucketed(rows: DataFrame, table: str, path: str, key: str = "EventID", buckets: int = 64) -> DataFrame:
    """A table of the catalogue, bucketed and sorted by a key: tables with as many buckets join on it without a shuffle.

    So do joins on the key and more columns, for which the session must let a part of a join's columns say where rows lie; that
    is set here.
    """
    rows.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    rows.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return rows.sparkSession.table(table)


def write_version(rows: DataFrame, path: str, version: str, keep: int = 20) -> str:
    """Writes beside older versions, which are the backup; of all versions, by name, the last `keep` stay."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    target = f"{path}/version={version}"
    rows.write.mode("errorifexists").parquet(target)
    context = rows.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
    versions = {f.getPath().getName(): f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("version=")}
    for name in sorted(versions)[:-keep]:
        fs.delete(versions[name], True)
    return target


def write_xml(rows: DataFrame, path: str, *, root: str = "Metagame", row: str = "Archetype") -> None:
    """Nested XML; fields that begin with an underscore are attributes."""
    rows.coalesce(1).write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", row).save(path)


def archetype_tree(decks: DataFrame) -> DataFrame:
    """Archetypes with their sums as attributes and their decks as children, for the XML file."""
    deck = F.struct(F.col("Deck").alias("_name"), F.col("Meta").alias("_meta"))
    return decks.groupBy("Archetype").agg(F.sum("Meta").alias("_meta"), F.count("*").alias("_decks"), F.sort_array(F.collect_list(deck)).alias("Deck")).withColumnRenamed("Archetype", "_name")


def write_documents(rows: DataFrame, path: str, name: Column, document: Column) -> None:
    """JSON documents by name. Each file has a range of the names, in order, so that reading one name opens one file, and
    there are no more files than the rows need."""
    rows.select(name.alias("name"), document.alias("value")).repartitionByRange("name").sortWithinPartitions("name").write.mode("overwrite").parquet(path)


def status_row(**fields: Column) -> list[Column]:
    """Columns of a status document with its keys in order."""
    return [fields[k].alias(k) for k in sorted(fields)]


def top_eight(history: DataFrame) -> DataFrame:
    """`place:deck (pilot); ...` of the first eight of each event."""
    line = F.transform(F.array_sort(F.collect_list(F.struct("Place", "Deck", "Pilot"))), lambda s: F.concat(s["Place"].cast("string"), F.lit(":"), s["Deck"], F.lit(" ("), s["Pilot"], F.lit(")")))
    return history.where("Place <= 8").groupBy("EventID").agg(F.array_join(line, "; ").alias("top8_decks"))


def manifest(history: DataFrame) -> DataFrame:
    """Events with their entries, winner and first eight."""
    at = lambda c: F.max(F.when(F.col("Place") == 1, F.col(c)))
    rows = history.groupBy("EventID", "EventDate", "Tier").agg(F.count("*").alias("n_decklists"), at("Deck").alias("winner_deck"), at("Pilot").alias("winner_pilot"))
    return rows.join(top_eight(history), "EventID", "left")


def uptime(pings: DataFrame) -> DataFrame:
    """By endpoint: share of good calls in percent, and how many have failed since the last good one (endpoint, ts, ok)."""
    last = pings.groupBy("endpoint").agg(F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_ok"))
    rows = pings.join(last, "endpoint")
    return rows.groupBy("endpoint").agg((100.0 * F.count_if("ok") / F.count("*")).alias("uptime_pct"), F.count_if(~F.col("ok") & (F.col("last_ok").isNull() | (F.col("ts") > F.col("last_ok")))).alias("failing"))
