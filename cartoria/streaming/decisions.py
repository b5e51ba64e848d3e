"""The decision log as a stream: keyed upserts batch by batch, and counts in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from cartoria.operators.decisions import upserted


def upsert_stream(decisions: DataFrame, store: str, key: str, order: str, keep: int = 2) -> DataStreamWriter:
    """Each micro-batch is merged into a store of numbered Parquet versions; a batch that is replayed rewrites its own version only.

    A version holds one row for each key. The newest ``keep`` versions before a batch's own stay, for a replay and for readers; older ones are removed.
    """
    if keep < 1:
        raise ValueError("a replay needs the version before")

    def merge(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        files = fs_path(store).getFileSystem(spark._jsc.hadoopConfiguration())
        earlier = sorted(n for n in (int(s.getPath().getName()[2:]) for s in (files.globStatus(fs_path(store, "v=*")) or [])) if n < number)
        before = earlier[-1] if earlier else None
        stored = batch.limit(0) if before is None else spark.read.parquet(f"{store}/v={before}")
        upserted(stored, batch, key, order).write.mode("overwrite").parquet(f"{store}/v={number}")
        for old in earlier[:-keep]:
            files.delete(fs_path(store, f"v={old}"), True)

    return decisions.writeStream.foreachBatch(merge)


def latest_store(spark: SparkSession, store: str) -> DataFrame:
    """The newest version of the store."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(store).getFileSystem(spark._jsc.hadoopConfiguration())
    newest = max(int(s.getPath().getName()[2:]) for s in files.globStatus(fs_path(store, "v=*")))
    return spark.read.parquet(f"{store}/v={newest}")


def windowed_counts(decisions: DataFrame, when: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Decisions by status and window of event time; rows later than ``late`` behind the newest are dropped."""
    return decisions.withWatermark(when, late).groupBy(F.window(when, window), "status_revisao").agg(F.count("*").alias("n"))
