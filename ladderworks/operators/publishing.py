"""Publishing a run's tables: the registry is compared with the history, checks are counted while they are written, and only
then do the tables come to light, all at once, in full or marked PARTIAL, or not at all. The status is always written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ladderworks.functions import text as T

#: Fixed value: what the status says about premier events where the registry wasn't read.
NOT_SCANNED = "Premier scan did not complete"


def registry_state(registry: DataFrame, history: DataFrame, format_name: str) -> DataFrame:
    """Each event of a registry (EventID, EventDate, size, kind) with its status: FETCHED or MISSING for a challenge, by the
    history of the format, PREMIER, IGNORED, and UNKNOWN for any other kind. Ids are compared without a trailing `.0`."""
    there = history.where(T.normalize_name("Format") == T.normalize_name(F.lit(format_name))).select(T.event_id("EventID").alias("_id")).distinct().withColumn("_there", F.lit(True))
    rows = registry.join(there, F.col("EventID") == F.col("_id"), "left")
    kind = F.col("kind")
    status = F.when(kind == "challenge", F.when(F.col("_there"), "FETCHED").otherwise("MISSING")).when(kind == "premier", "PREMIER").when(kind == "ignored", "IGNORED").otherwise("UNKNOWN")
    reason = F.when((kind == "challenge") & F.col("_there").isNull(), "not present in history_csv")
    return rows.withColumns({"Status": status, "Reason": reason}).drop("_id", "_there")


def premier_note(events: DataFrame, format_name: str, start: str, end: str) -> DataFrame:
    """One row: `date type (id)` of a window's premier events (date, event_type, event_id) by date, or that there is none.
    Its length is that of the window's list of events."""
    line = F.concat(F.col("date").cast("string"), F.lit(" "), F.col("event_type"), F.lit(" ("), F.col("event_id"), F.lit(")"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("date", line.alias("t")))), lambda s: s["t"]), "; ")
    none = f"No {format_name} premier events in window {start}..{end} (registry checked)"
    return events.agg(F.count("*").alias("n"), listed.alias("t")).select(F.when(F.col("n") == 0, none).otherwise(F.col("t")).alias("note"))


def _counts(size: Column, counted: Column) -> Column:
    """{size: number} of the rows that count, over rows that are grouped by size."""
    pairs = F.collect_list(F.when(counted > 0, F.struct(F.coalesce(size.cast("string"), F.lit("none")).alias("key"), counted.alias("value"))))
    return F.map_from_entries(F.array_sort(pairs))


def completeness(state: DataFrame, note: DataFrame) -> DataFrame:
    """One row from `registry_state`: counts, missing events, sizes, premier events, and whether every challenge was fetched.
    A registry without a challenge isn't complete."""
    of = lambda *s: F.col("Status").isin(*s)
    sizes = state.where(of("FETCHED", "MISSING")).groupBy("size").agg(F.count("*").alias("r"), F.count_if(of("FETCHED")).alias("f"))
    sizes = sizes.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("registry_count"), F.coalesce(F.sum("f"), F.lit(0)).alias("fetched_count"), _counts(F.col("size"), F.col("r")).alias("tier_counts_registry"), _counts(F.col("size"), F.col("f")).alias("tier_counts_fetched"))
    event = lambda *more: F.struct("EventID", F.col("EventDate").cast("string").alias("EventDate"), *more)
    lists = state.agg(
        F.array_sort(F.collect_list(F.when(of("MISSING"), event("Status", "Reason")))).alias("missing"), F.array_sort(F.collect_list(F.when(of("PREMIER"), event()))).alias("premier_events"),
        F.count_if(of("PREMIER")).alias("premier_count"),
    )
    one = sizes.join(lists, F.lit(True)).join(note.select(F.col("note").alias("premier_note")), F.lit(True))  # a row each
    whole = (F.col("registry_count") > 0) & (F.col("registry_count") == F.col("fetched_count"))
    return one.withColumns({"complete": whole, "premier_checked": F.lit(True)})


@dataclass(frozen=True)
class Published:
    """What a run has published: full, partial or withheld, why, the folder with the tables, and the violations by severity."""

    state: str
    reason: str
    folder: str | None
    counts: dict[str, int]


def publish(
    tables: dict[str, DataFrame], violations: DataFrame, summary: DataFrame | None, path: str, *, name: str = "statistics", window: tuple[str, str] | None = None, meta_window: tuple[str, str] | None = None,
    allow_partial: bool = False, shown: int = 20,
) -> Published:
    """Writes a run's tables below `path` if its checks and its completeness allow it.

    The violations are counted by an observation of the job that writes them. A hard one withholds the tables, a fatal one
    raises; both only after the status is written. `summary` is a row of `completeness`; None, or windows that differ from
    that of the market share, are incomplete, and the tables are withheld, or marked PARTIAL if that is allowed. Tables are
    written to a hidden folder, counted as they are, and appear by one rename. A run that ends early leaves nothing to see.
    """
    spark = violations.sparkSession
    store = _Folder(spark, path)
    hidden = f"_{name}-{uuid.uuid4().hex}"
    status: dict = {"complete": False, "partial": False, "registry_count": None, "fetched_count": None, "missing": [], "tier_counts_registry": {}, "tier_counts_fetched": {}, "premier_checked": False, "premier_count": None, "premier_events": [], "premier_note": NOT_SCANNED}
    status |= {"window_start": window and window[0], "window_end": window and window[1], "league_window_start": meta_window and meta_window[0], "league_window_end": meta_window and meta_window[1], "window_consistent": None}

    seen = Observation()
    counted = violations.observe(seen, *(F.count_if(F.col("severity") == s).alias(s) for s in ("fatal", "hard", "warn")))
    counted.write.parquet(f"{path}/{hidden}/violations")
    counts = {k: seen.get[k] for k in ("fatal", "hard", "warn")}
    if counts["fatal"] or counts["hard"]:
        bad = spark.read.schema(violations.schema).parquet(f"{path}/{hidden}/violations").where("severity <> 'warn'").orderBy("check_id", "key").limit(shown).collect()
        told = [f"{r.check_id} {r.key}: {r.detail}" for r in bad]
        store.put(f"{name}.status.json", status | {"invariant_problems": told, "invariant_problem_count": counts["fatal"] + counts["hard"]})
        store.drop(hidden)
        if counts["fatal"]:
            raise AssertionError("; ".join(told))
        return Published("withheld", "checks", None, counts)

    if summary is not None:
        status |= json.loads(summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first()["j"])
        if status["complete"] and not status["registry_count"]:
            store.drop(hidden)
            raise AssertionError("complete, but without a count of the registry")
        if status["premier_checked"] and status["premier_count"] is None:
            store.drop(hidden)
            raise AssertionError("premier events were checked, but not counted")
    reason = "" if status["complete"] else "incomplete"
    if window and meta_window:
        status["window_consistent"] = window == meta_window
        if window != meta_window:
            status["complete"], reason = False, "windows differ"
    if not status["complete"] and not allow_partial:
        store.put(f"{name}.status.json", status)
        store.drop(hidden)
        return Published("withheld", reason, None, counts)
    status["partial"] = not status["complete"]
    status["rows"] = {}
    for label, table in tables.items():
        rows = Observation()
        table.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{hidden}/{label}")
        status["rows"][label] = rows.get["n"]
    target = f"{name}_PARTIAL" if status["partial"] else name
    store.replace(hidden, target)
    store.put(f"{name}.status.json", status)
    return Published("partial" if status["partial"] else "full", reason, f"{path}/{target}", counts)


class _Folder:
    """Small files and renames in a folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.fs = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def _at(self, name: str):  # noqa: ANN202  a Java object
        return self._path(f"{self.path}/{name}")

    def put(self, name: str, document: dict) -> None:
        """A JSON document, in place of an older one by a rename."""
        part = self._at(f"_{name}.{uuid.uuid4().hex}")
        out = self.fs.create(part, True)
        out.write(bytearray(json.dumps(document, indent=2).encode()))
        out.close()
        self.fs.delete(self._at(name), False)
        self.fs.rename(part, self._at(name))

    def replace(self, hidden: str, name: str) -> None:
        """The hidden folder in place of an older one, which is moved away first and removed last."""
        old = self._at(f"_old-{uuid.uuid4().hex}")
        had = self.fs.exists(self._at(name)) and self.fs.rename(self._at(name), old)
        if not self.fs.rename(self._at(hidden), self._at(name)):
            if had:
                self.fs.rename(old, self._at(name))
            raise OSError(f"{name} can't be put in place")
        if had:
            self.fs.delete(old, True)

    def drop(self, name: str) -> None:
        self.fs.delete(self._at(name), True)
