"""The folder that the driver and all executors share, and tables written there to end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new path in spark.checkpoint.dir; only a local session without it gets a temporary folder."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="ladderworks-")
    return f"{root}/files-{uuid.uuid4().hex}"


def cut(rows: DataFrame) -> DataFrame:
    """`rows`, written once to the shared folder and read again, so that a loop's lineage doesn't grow and a lost executor
    costs no recomputation. Whoever owns the folder clears it when the application is over."""
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once a row, however often they are used later on.

    Spark writes a plain column's expression again into each filter that is moved below it, and so parses a document as often
    as a filter names it; it moves none below an explode. The columns can't use each other.
    """
    for name, value in columns.items():
        rows = rows.withColumn(name, F.explode(F.array(value)))
    return rows
