"""Answers of a paged service as a table: a batch data source with a partition for each page, or each run of pages if there are many.

Answers are kept as JSON files `<folder>/<source>/<endpoint>_<key>.json`, where the key comes from the endpoint and all
parameters, offset and limit among them, and the source is the service itself, its backup, or the cache. A page is taken from
the first of these that has a readable answer. Folders are reached through pyarrow's file systems.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ladderworks.functions import text as T
from ladderworks.sources.scratch import cut

#: Where a page is looked for, in order.
SOURCES = ("primary", "backup", "cache")
#: Rows of a batch that a task hands over at once, and partitions among which more pages are shared out.
BATCH, PARTITIONS = 1000, 512
_SCHEMA = "page int, source string, n int, ordinal int, value string"


def file_name(endpoint: str, params: dict[str, object]) -> str:
    """The name of the file with the answer to a call, by its key (see `tables.cache_key`)."""
    query = "&".join(f"{k}={v}" for k, v in sorted(params.items()))
    return f"{endpoint.replace('/', '_')}_{hashlib.md5(f'{endpoint}?{query}'.encode()).hexdigest()[:16]}.json"


class _Part(InputPartition):
    def __init__(self, pages: list[int]) -> None:
        super().__init__(pages)
        self.pages = pages


class _Pages(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.endpoint, self.field = options["path"], options["endpoint"], options["field"]
        self.params, self.limit = json.loads(options.get("params", "{}")), int(options["limit"])
        self.limit_name, self.start_name = options.get("limitname", "c:limit"), options.get("startname", "c:start")
        self.low, self.high, self.among = 0, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  Spark's name
        """Comparisons of the page with numbers decide which pages are asked for; all other filters stay with Spark."""
        for f in filters:
            if getattr(f, "attribute", None) != ("page",):
                yield f
            elif isinstance(f, EqualTo):
                self.among = ({f.value} if self.among is None else self.among & {f.value})
            elif isinstance(f, In):
                self.among = (set(f.value) if self.among is None else self.among & set(f.value))
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, LessThan | LessThanOrEqual):
                last = f.value - isinstance(f, LessThan)
                self.high = last if self.high is None else min(self.high, last)
            else:
                yield f

    def _name(self, page: int) -> str:
        return file_name(self.endpoint, self.params | {self.limit_name: self.limit, self.start_name: page * self.limit})

    def partitions(self) -> Sequence[InputPartition]:
        """Pages from the first on, as long as some source has an answer, and the one after: whether it is due is told by the
        page before. Only names are listed here."""
        files, root = pafs.FileSystem.from_uri(self.folder)
        there = {i.base_name for s in SOURCES for i in files.get_file_info(pafs.FileSelector(f"{root}/{s}", allow_not_found=True))}
        end = 0
        while self._name(end) in there:
            end += 1
        asked = [p for p in range(end + 1) if p >= self.low and (self.high is None or p <= self.high) and (self.among is None or p in self.among)]
        each = max(1, -(-len(asked) // PARTITIONS))
        return [_Part(asked[at : at + each]) for at in range(0, len(asked), each)]

    def read(self, partition: _Part | None) -> Iterator[pa.RecordBatch]:
        """The rows of the pages; a row without a value for an empty page; a row without a source if nobody has an answer."""
        if partition is None:  # no page is asked for
            return
        files, root = pafs.FileSystem.from_uri(self.folder)
        for page in partition.pages:
            yield from self._read_page(files, root, page)

    def _read_page(self, files: pafs.FileSystem, root: str, page: int) -> Iterator[pa.RecordBatch]:
        rows, source = None, None
        for source in SOURCES:
            try:
                with files.open_input_stream(f"{root}/{source}/{self._name(page)}") as f:
                    rows = json.loads(f.read()).get(self.field)
                break
            except (FileNotFoundError, ValueError, AttributeError):  # not there, no JSON, no object
                source = None
        values = [json.dumps(r, ensure_ascii=False) for r in rows] if isinstance(rows, list) else []
        shown = values or [None]
        for at in range(0, len(shown), BATCH):
            part = shown[at : at + BATCH]
            columns = [pa.array([page] * len(part), pa.int32()), pa.array([source] * len(part), pa.string()), pa.array([len(values)] * len(part), pa.int32()), pa.array(range(at, at + len(part)), pa.int32()), pa.array(part, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page", "source", "n", "ordinal", "value"])


class PagedAnswers(DataSource):
    """Options: path, endpoint, field (of the list in an answer), limit, params (JSON), limitName, startName."""

    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Pages({k.lower(): v for k, v in self.options.items()})


def pages(spark: SparkSession, folder: str, endpoint: str, field: str, limit: int, params: dict[str, object] | None = None) -> DataFrame:
    """Pages as they are answered: page, source, n (rows of the page), ordinal and value (a row as JSON)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedAnswers)
    options = {"path": folder, "endpoint": endpoint, "field": field, "limit": str(limit), "params": json.dumps(params or {})}
    return spark.read.format("paged_answers").options(**options).load()


def all_rows(spark: SparkSession, folder: str, endpoint: str, field: str, limit: int, params: dict[str, object] | None = None) -> DataFrame:
    """The rows (page, source, ordinal, value) of all pages up to the first that isn't full, as paging by offset gives them.

    A page that is due, but that neither the service nor its backup nor the cache can answer, is an error. Rows beyond the
    last page don't count.
    """
    found = pages(spark, folder, endpoint, field, limit, params)
    last = found.where(F.col("source").isNotNull() & (F.col("n") < limit)).agg(F.min("page").alias("last"))
    lost = F.raise_error(F.concat(F.lit(f"no answer for {endpoint}, page "), F.col("page").cast("string"))).cast("boolean")
    due = F.when(F.col("page") > F.col("last"), False).when(F.col("source").isNull(), lost).otherwise(F.col("value").isNotNull())
    return found.join(F.broadcast(last), F.lit(True)).where(due).select("page", "source", "ordinal", "value")  # one row of the last page


def store_answers(answers: DataFrame, folder: str) -> None:
    """Writes answers (source, name, body) as files, each by a rename, from the executors."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        there: set[str] = set()
        for batch in batches:
            for r in batch.to_pylist():
                if r["source"] not in there:
                    files.create_dir(f"{root}/{r['source']}", recursive=True)
                    there.add(r["source"])
                part = f"{root}/{r['source']}/.{r['name']}.part"
                with files.open_output_stream(part) as f:
                    f.write((r["body"] or "").encode())
                files.move(part, f"{root}/{r['source']}/{r['name']}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    answers.select("source", "name", "body").mapInArrow(write, "n long").agg(F.sum("n")).collect()


#: Layout of a row of the calendar; numbers come as numbers or text.
CALENDAR = "description STRING, minimumplayers STRING, starttime STRING, tournamentid STRING"
_TITLE = r"(?i)^(.+?)\s+challenge(?:\s+(\d+))?$"


def calendar_events(rows: DataFrame, format_name: str, start: str, end: str, value: str = "value") -> DataFrame:
    """Challenges of a format in a closed range of dates, of calendar rows as JSON: EventDate, size, event_id, slug.

    The size stands in the description, else it is the fewest players. Rows that don't read as a challenge of the format, with
    a size above 0, a date and a number, are left out; equal ones count once.
    """
    c = rows.select(F.from_json(value, CALENDAR).alias("c")).select("c.*").withColumn("description", T.trimmed("description"))
    told = F.nullif(F.regexp_extract("description", _TITLE, 2), F.lit(""))
    size = F.coalesce(told, T.trimmed("minimumplayers")).try_cast("int")
    found = c.select(
        T.format_token(F.regexp_extract("description", _TITLE, 1)).alias("_f"), size.alias("size"), F.try_to_date(F.left(T.trimmed("starttime"), F.lit(10)), "yyyy-MM-dd").alias("EventDate"),
        T.trimmed("tournamentid").alias("id"), F.col("description").rlike(_TITLE).alias("_challenge"),
    )
    good = F.col("_challenge") & (F.col("_f") == T.format_token(F.lit(format_name))) & (F.col("size") > 0) & F.col("id").rlike(r"^\d+$") & F.col("EventDate").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    one = found.where(good).select("EventDate", "size", "id").distinct()
    number = F.regexp_replace("id", "^0+(?=.)", "")
    slug = F.concat(T.format_slug(F.lit(format_name)), F.lit("-challenge-"), F.col("size").cast("string"), F.lit("-"), F.col("EventDate").cast("string"), number)
    return one.select("EventDate", "size", number.alias("event_id"), slug.alias("slug"))


def found_events(calendar: DataFrame, index: DataFrame) -> DataFrame:
    """The calendar's events, or, if it has none, those of the index page (EventDate, size, event_id, slug): there, of events of
    one date and size the one with the largest number. `listed` says which it was."""
    calendar = cut(calendar)  # the pages are read once, not again to tell whether there is an event
    newest = index.groupBy("EventDate", "size").agg(F.max_by(F.struct("event_id", "slug"), F.col("event_id").cast("long")).alias("e")).select("EventDate", "size", "e.*")
    none = calendar.limit(1).agg((F.count("*") == 0).alias("_none"))
    fallback = newest.join(F.broadcast(none), F.col("_none")).drop("_none")  # one row
    return calendar.withColumn("listed", F.lit("calendar")).unionByName(fallback.withColumn("listed", F.lit("index")))
