"""What the corpus operators share: table reading, scratch tables, text chunks, a connected-components job."""

from __future__ import annotations

import sys
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the characters that separate words, as SQL text.
WHITE = " \t\n\x0b\x0c\r"
#: Texts that one Python step works on together have at most so many bytes, unless one text alone has more.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir; only a local session without it gets a temporary folder."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="ladderworks-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(df: DataFrame) -> DataFrame:
    """`df`, written once to the shared folder and read again: lineage ends here and a lost executor costs no recomputation.

    The folder is scratch space: `forget` removes it once nothing reads it any more; what results still need, whoever owns
    spark.checkpoint.dir clears when the application is over.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/ladderworks-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[id(table)] = path
    weakref.finalize(table, _written.pop, id(table), None)
    return table


#: Folders of the scratch tables, by the identity of their data frames.
_written: dict[int, str] = {}


def forget(table: DataFrame) -> None:
    """Removes the folder of a table that `scratch` gave; nothing may read it afterwards."""
    if path := _written.pop(id(table), None):
        sc = table.sparkSession.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def boxed(docs: DataFrame, **extra: Column) -> DataFrame:
    """All columns of `docs` in the struct `doc`, beside the given ones, whose names then can't clash with theirs."""
    return docs.select(F.struct("*").alias("doc"), *(c.alias(k) for k, c in extra.items()))


def stripped(text: Column) -> Column:
    """The text without its white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def chunks(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with the UTF-8 texts of each (null: empty), of CHUNK_BYTES or a single row at most."""
    sizes = batch.column(text_col).cast(pa.large_binary())
    lengths = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > CHUNK_BYTES:
            yield _slice(batch, sizes, start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield _slice(batch, sizes, start, len(lengths))


def _slice(batch: pa.RecordBatch, texts: pa.Array, start: int, end: int) -> tuple[pa.RecordBatch, list[bytes]]:
    return batch.slice(start, end - start), [t or b"" for t in texts.slice(start, end - start).to_pylist()]


def worker_state(name: str, make: Callable[[], object]) -> object:
    """What `make` returns, made once in a Python worker and kept for the tasks that it runs later."""
    held = sys.modules.setdefault("_ladderworks_worker_state", ModuleType("_ladderworks_worker_state")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the graph with the given links, as (node, root): root is the component's smallest node.

    `edges` has two columns of one orderable type; loops and repeated links are fine. Alternating large and small stars
    (Kiveris et al. 2014): each round turns the links towards the smallest known neighbour, and rounds end when nothing
    changes. Smallest neighbours are found by an aggregation that combines map-side and joined back, so that the links
    of a hub need not meet in one task.
    """
    a, b = edges.columns
    links = scratch(_oriented(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    state = _checksum(links)
    while state[0]:
        before, links = links, scratch(_star(_star(links, large=True), large=False))
        forget(before)
        new = _checksum(links)
        if new == state:
            break
        state = new
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def _oriented(links: DataFrame) -> DataFrame:
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _star(links: DataFrame, *, large: bool) -> DataFrame:
    """Large: each node's larger neighbours get its smallest neighbour; small: its smaller ones and itself do."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(own.unionByName(moved))


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
