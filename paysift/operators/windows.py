"""De-duplication, caps, group transforms and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import share
from ..scale import first_per_key, grouped_quantiles, null_safe, ordinal, top_per_key, with_group_stats


def company_cap(df: DataFrame, cap: int | None, date: str = "fetch_date", company: str = "company_name",
                published: str = "publication_date", id: str = "id") -> DataFrame:
    """At most `cap` rows per date and company, latest publication first; no cap for None or 0.

    Missing companies are one group, missing dates come last, ids break ties as text.
    """
    if not cap:
        return df
    order = [F.col(published).desc_nulls_last(), F.col(id).cast("string").asc()]
    return top_per_key(df, [date, company], order, cap)


def impute_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    """Fill missing values by the group's median, else by the overall median; `imputed` marks filled rows."""
    medians = grouped_quantiles(df, value, [0.5], [group], ["__median"])
    overall = grouped_quantiles(df, value, [0.5], names=["m"]).scalar()
    joined = null_safe(df, medians, [group])
    return (joined.withColumn("imputed", F.col(value).isNull())
            .withColumn(value, F.coalesce(F.col(value), F.col("__median"), overall)).drop("__median"))


def share_of_group(df: DataFrame, group: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Each row's value as a share of its group's sum."""
    return with_group_stats(df, group, __total=F.sum(value)).withColumn(name, share(value, "__total")).drop("__total")


def group_zscore(df: DataFrame, value: Column, groups: Sequence[str], name: str = "z") -> DataFrame:
    """Standard score within a group (sample deviation); 0 for groups of one or without spread."""
    valued = df.withColumn("__x", value)
    stats = with_group_stats(valued, groups, __m=F.avg("__x"), __s=F.stddev_samp("__x"))
    z = F.coalesce(F.try_divide(F.col("__x") - F.col("__m"), F.col("__s")), F.lit(0.0))
    return stats.withColumn(name, z).drop("__x", "__m", "__s")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in source order."""
    return first_per_key(df, keys, order)


def merge_found_under(df: DataFrame, id: str, order: str, label: str, into: str) -> DataFrame:
    """One row per id (the first seen) with the distinct labels it was found under, in order."""
    firsts = df.groupBy(id, label).agg(F.min(order).alias("__o"))
    lists = firsts.groupBy(id).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", F.col(label).alias("l")))),
                                               lambda x: x["l"]).alias(into))
    return first_per_key(df, [id], [F.col(order)]).drop(label).join(lists, id)


def drop_reposts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], long_text: Sequence[str] = ()) -> DataFrame:
    """Keep the first of each group of equal postings; missing key parts are equal.

    Long texts are compared by hash, so the shuffle key stays short.
    """
    hashed = {f"__h_{c}": F.sha2(F.col(c), 256) for c in long_text}
    columns = [c for c in keys if c not in long_text] + list(hashed)
    return first_per_key(df.withColumns(hashed) if hashed else df, columns, order).drop(*hashed)


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "index", start: int = 0) -> DataFrame:
    """Gap-free index of a table's rows under a total order."""
    return ordinal(df, order, name, start)


def index_by_frequency(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Distinct values with their count and an index: most frequent first, NULL after equal counts."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return dense_index(counts, [F.col("n").desc(), F.col(column).asc_nulls_last()], name)


def best_candidate(df: DataFrame, score: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """The highest score, the earliest candidate on ties."""
    ranking = [F.col(score).desc(), F.col(order).asc()]
    return first_per_key(df, keys, ranking) if keys else df.orderBy(*ranking).limit(1)
