"""Date expressions (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ..scale import col


def epoch_ms_to_date(ms: Column | str) -> Column:
    """Epoch milliseconds as a date."""
    return F.to_date(F.timestamp_millis(col(ms)))


def date_prefix(text: Column | str) -> Column:
    """The first ten characters of an ISO timestamp."""
    return F.substring(col(text), 1, 10)


def date_key(day: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(col(day), "yyyyMMdd").cast("int")


def date_parts(day: Column | str) -> list[Column]:
    """The columns of a date dimension."""
    day = col(day)
    return [
        date_key(day).alias("time_id"), F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"), F.weekofyear(day).alias("week_of_year"),
    ]


def is_recent(published: Column | str, fetched: Column | str, days: int = K.RECENT_DAYS) -> Column:
    """Published at most `days` before the fetch; NULL counts as not recent."""
    return F.coalesce(col(published) >= F.date_sub(col(fetched), days), F.lit(False))


def same_year(published: Column | str, fetched: Column | str) -> Column:
    """Published in the year of the fetch; NULL counts as no."""
    return F.coalesce(F.year(col(published)) == F.year(col(fetched)), F.lit(False))


def snapshot_age(day: Column | str, today: Column | str) -> Column:
    """Whole days since the snapshot; NULL for an invalid or future date."""
    text = col(day).cast("string")
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
    age = F.datediff(col(today), parsed)
    return F.when(age >= 0, age)


def snapshot_label(day: Column | str, today: Column | str, stale_after: int = K.STALE_AFTER_DAYS) -> Column:
    """unknown, stale or fresh."""
    age = snapshot_age(day, today)
    return F.when(age.isNull(), "unknown").when(age > stale_after, "stale").otherwise("fresh")
