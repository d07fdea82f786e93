"""Incremental ingestion of saved result pages into the snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import first_per_key
from ..session import scratch_path
from ..sources.snapshots import open_snapshots, replace_snapshot


def merge_pages(new: DataFrame, stored: DataFrame, id: str, date: str) -> DataFrame:
    """All rows of the dates in `new`: stored ones it does not mention, and one row per new (id, date)."""
    fresh = first_per_key(new, [id, date], [F.col(c).asc_nulls_last() for c in new.columns if c not in (id, date)])
    touched = stored.join(new.select(date).distinct(), date, "left_semi")
    kept = touched.join(fresh.select(id, date), [id, date], "left_anti")
    return kept.unionByName(fresh)


def ingest_pages(spark: SparkSession, source: str, schema: T.StructType, target: str, id: str = "id", date: str = "fetch_date",
                 progress: str | None = None, files_per_batch: int = 1000) -> None:
    """Read page files not seen yet and bring their dates up to date, then stop.

    Each micro-batch rewrites only its dates, from a stored copy of the merged rows, so a
    batch repeated after a failure leaves the same table.
    """
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stored = open_snapshots(session, target, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))
        merged = merge_pages(batch, stored, id, date)
        staged = scratch_path(session, "pages")  # the target cannot be read while it is overwritten
        merged.write.parquet(staged)
        replace_snapshot(session.read.schema(merged.schema).parquet(staged), target, date)

    query = (pages.writeStream.foreachBatch(load).trigger(availableNow=True)
             .option("checkpointLocation", progress or scratch_path(spark, "progress")).start())
    query.awaitTermination()
