"""Stored tables: CSV files whose columns are all text, rule and mapping files, weekly run folders, cached API answers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ladderworks.functions import text as T
from ladderworks.functions.scoring import week_of_path

#: Columns of the event history, of league results and of bracket matches.
HISTORY = ("EventDate", "Format", "Tier", "PlayerCount", "EventSlug", "EventID", "Place", "Deck", "Archetype", "Pilot", "LoginID")
RESULTS = ("EventID", "EventDate", "Tier", "EventClass", "Pilot", "LoginID", "Place", "Deck", "LeaguePoints", "SwissRank", "SwissPoints", "OMWP", "GWP", "OGWP")
MATCHES = ("EventID", "EventDate", "Tier", "EventClass", "Round", "WinnerPilot", "WinnerLoginID", "LoserPilot", "LoserLoginID", "WinnerGames", "LoserGames", "WinnerDeck", "LoserDeck")


def with_columns(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly the given columns as text: missing ones are added, and null is empty."""
    return rows.select(*(T.text_of(F.col(f"`{c}`")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def _headers(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> dict[str, list[str]]:
    """The files of a path by their header lines."""
    rows = spark.read.options(**options).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    first = rows.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    found: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():  # a row for each file
        found.setdefault(r["header"].removeprefix("\ufeff").strip(), []).append(r["file"])
    return found


def read_csv(spark: SparkSession, path: str | list[str], columns: Iterable[str], **options: str) -> DataFrame:
    """A CSV file, folder or pattern with headers, by name: files may differ in columns and their order.

    Missing columns are empty. A path that isn't there, and files without a line, are an empty table.
    """
    columns = list(columns)
    out = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    try:
        whole = reader.csv(path)
        if len(whole.inputFiles()) < 2:
            return with_columns(_plain(whole), columns)
        groups = _headers(spark, path, options)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return out
    for files in groups.values():  # files with one header are read together
        out = out.unionByName(with_columns(_plain(reader.csv(files)), columns))
    return out


def _plain(rows: DataFrame) -> DataFrame:
    """Without a byte order mark before the first name."""
    return rows.toDF(*(c.removeprefix("\ufeff").strip() for c in rows.columns))


def typed_history(rows: DataFrame) -> DataFrame:
    """History with its types: date, integer place and player count, ids without a trailing `.0`."""
    return rows.withColumns({"EventDate": F.try_to_date("EventDate"), "Place": F.col("Place").try_cast("double").try_cast("int"), "PlayerCount": F.col("PlayerCount").try_cast("int"), "EventID": T.event_id("EventID"), "LoginID": T.event_id("LoginID")})


def typed_results(rows: DataFrame) -> DataFrame:
    """League results with their types; EventClass is Challenge where it is empty."""
    return rows.withColumns({"EventDate": F.try_to_date("EventDate"), "Place": F.col("Place").try_cast("double").try_cast("int"), "LeaguePoints": F.col("LeaguePoints").try_cast("int"), "EventID": T.event_id("EventID"), "LoginID": T.event_id("LoginID"), "EventClass": F.when(T.trimmed("EventClass") == "", "Challenge").otherwise(F.col("EventClass"))})


def bracket_matches(spark: SparkSession, folder: str, start: str, end: str) -> DataFrame:
    """Matches of a range of dates from one file per event; the list of events without a bracket is left out."""
    rows = read_csv(spark, folder, MATCHES, pathGlobFilter="[!_]*.csv").withColumn("EventDate", F.try_to_date("EventDate"))
    return rows.where(F.col("EventDate").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def run_share(rows: DataFrame) -> DataFrame:
    """Market share as numbers; rows without a deck, a share or a win rate are left out."""
    typed = rows.select("Deck", F.col("Meta").try_cast("double").alias("Meta"), F.col("Winrate").try_cast("double").alias("Winrate"))
    return typed.where((T.trimmed("Deck") != "") & F.col("Meta").isNotNull() & F.col("Winrate").isNotNull())


def numbered(rows: DataFrame) -> DataFrame:
    """Adds `ordinal`, the place of each row in its file, for small tables read from one file."""
    return rows.withColumn("ordinal", F.monotonically_increasing_id())


def run_folders(paths: DataFrame) -> DataFrame:
    """Weekly runs (path, week_start, week_end) of a table of paths, in order; other paths are left out."""
    return paths.withColumn("w", week_of_path(F.col("path"))).where("w.week_start IS NOT NULL AND w.week_end IS NOT NULL").select("path", "w.*")


def latest_run(paths: DataFrame) -> DataFrame:
    """The path of the newest run, by start and path."""
    return run_folders(paths).agg(F.max_by("path", F.struct("week_start", "path")).alias("path"))


def first_name(rows: DataFrame, columns: tuple[str, ...] = ("Source Deck Names", "Raw Deck", "Deck")) -> DataFrame:
    """Adds raw_deck: the first of the columns that isn't blank."""
    return rows.withColumn("raw_deck", F.coalesce(*(F.nullif(T.trimmed(F.col(f"`{c}`")), F.lit("")) for c in columns), F.lit("")))


def labelled_union(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables as one, with the name of each row's source."""
    out = None
    for label, t in tables.items():
        t = t.withColumn("source_label", F.lit(label))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def distinct_names(rows: DataFrame, col: str, order: str) -> DataFrame:
    """Distinct names, of those that differ in case the first."""
    place = Window.partitionBy(F.lower(F.trim(col))).orderBy(order)
    return rows.where(T.trimmed(col) != "").withColumn("_n", F.row_number().over(place)).where("_n = 1").select(F.trim(col).alias(col))


def available_formats(candidates: DataFrame, entries: DataFrame) -> DataFrame:
    """Candidate formats that have an entry."""
    return candidates.join(entries.select(T.format_token("Format").alias("_f")).distinct(), T.format_token("Format") == F.col("_f"), "left_semi")


def cache_key(endpoint: Column, params: Column) -> Column:
    """The cache file's name of a call: the first 16 digits of the MD5 of endpoint and sorted parameters (a map)."""
    query = F.array_join(F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    return F.substring(F.md5(F.concat(endpoint, F.lit("?"), query)), 1, 16)


def first_answer(answers: DataFrame, order: tuple[str, ...] = ("primary", "backup", "cache")) -> DataFrame:
    """The answer to each key from the first source that has one (key, source, body)."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    return answers.where("body IS NOT NULL").groupBy("key").agg(F.min_by("body", rank).alias("body"), F.min_by("source", rank).alias("source"))
