"""Tables of dated snapshots, partitioned by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import path_exists

DATE = "fetch_date"


def list_snapshots(df: DataFrame, date: str = DATE) -> DataFrame:
    """The distinct dates in order."""
    return df.select(date).distinct().orderBy(date)


def resolve_snapshot(df: DataFrame, wanted: str | None = None, date: str = DATE) -> str:
    """The wanted date, or the latest; an absent date is an error."""
    condition = F.lit(True) if wanted is None else F.col(date).cast("string") == wanted
    found = df.filter(condition).agg(F.max(F.col(date).cast("string"))).first()[0]
    if found is None:
        raise ValueError(f"no snapshot {wanted or 'in the table'}")
    return found


def scan_snapshot(df: DataFrame, wanted: str | None = None, date: str = DATE) -> DataFrame:
    """The rows of one snapshot; only its partition is read."""
    return df.filter(F.col(date).cast("string") == resolve_snapshot(df, wanted, date))


def latest_rows(df: DataFrame, date: str = DATE, by: str | None = None) -> DataFrame:
    """Rows of the latest date, of the whole table or of each source."""
    if by is None:
        return df.filter(F.col(date) == df.agg(F.max(date)).scalar())
    latest = df.groupBy(by).agg(F.max(date).alias(date))
    return df.join(latest, [by, date], "left_semi")


def replace_snapshot(df: DataFrame, path: str, date: str = DATE) -> None:
    """Replace the partitions of the incoming dates; other dates stay, a rerun changes nothing.

    The rebalance hint groups rows by date for few files, and splits a date that is too large for one task.
    """
    (df.hint("rebalance", date)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path))


def open_snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The snapshot table, or an empty one when nothing was stored yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def migrate_key(old: DataFrame, columns: dict[str, str], date: str = DATE, default_date: str | None = None) -> DataFrame:
    """Bring an older one-snapshot table to the current columns; unknown columns are dropped, new ones NULL."""
    kept = [F.col(c).cast(t).alias(c) if c in old.columns else F.lit(None).cast(t).alias(c)
            for c, t in columns.items()]
    out = old.select(kept)
    return out if default_date is None else out.withColumn(date, F.coalesce(F.col(date), F.lit(default_date)))
