"""Event results as a stream: files that arrive are synchronised into the stored history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ladderworks.operators.state import replace_again
from ladderworks.sources.tables import HISTORY, read_csv, typed_history


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of CSV files as they arrive in a folder, once each. Only their names are read here, not their content."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(folder).select(F.col("path").alias("file"))


def sync_stream(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Keeps the history at `table`, by month: the events of a batch of files replace their rows.

    Files are read by the names of their columns. A deck that was resolved before stays with its event and pilot. Only
    months that an event comes to or leaves are written again; they are written beside the table first, so that a batch
    that fails changes nothing, and one that runs again gives the same table.
    """

    def batch(files: DataFrame, number: int) -> None:
        session = files.sparkSession
        paths = [r["file"] for r in files.distinct().collect()]  # the files of one batch
        if not paths:
            return
        month = F.coalesce(F.date_format("EventDate", "yyyy-MM"), F.lit("none"))
        fresh = typed_history(read_csv(session, paths, HISTORY)).withColumn("Month", month)
        fs = session.sparkContext._jvm.org.apache.hadoop.fs.Path(table).getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
        target = session.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
        if fs.exists(target):
            stored = session.read.schema(fresh.schema).parquet(table)
            touched = fresh.select("Month").unionByName(stored.join(fresh.select("EventID").distinct(), "EventID", "left_semi").select("Month")).distinct()
            months = [r["Month"] for r in touched.collect()]  # a month has many events
            fresh = replace_again(stored.where(F.col("Month").isin(months)), fresh)
            gone = set(months)
        else:
            gone = set()
        beside = f"{table.rstrip('/')}.batch-{uuid.uuid4().hex}"
        fresh.write.mode("overwrite").parquet(beside)
        done = session.read.parquet(beside)
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Month").parquet(table)
        for m in gone - {r["Month"] for r in done.select("Month").distinct().collect()}:  # months that all events left
            fs.delete(session.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/Month={m}"), True)
        fs.delete(session.sparkContext._jvm.org.apache.hadoop.fs.Path(beside), True)

    return arriving_files(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in windows of time; rows later than `late` are left out. Works on streams and tables."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
