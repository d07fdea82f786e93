"""Aggregations, rankings, histograms, overlap reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import share, tier_between
from ..scale import col, grouped_quantiles, null_safe, one_row, value_positions


def value_shares(df: DataFrame, column: str, labels: Sequence | None = None) -> DataFrame:
    """Count and share per value (NULL ignored); with `labels`, exactly these in this order, absent ones 0."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    if labels is None:
        return counts.withColumn("share", share("n", total))
    fixed = df.sparkSession.createDataFrame(list(enumerate(labels)), f"position int, {column} string")
    joined = fixed.join(counts, column, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    return joined.withColumn("share", F.coalesce(share("n", total), F.lit(0.0)))


def crosstab(df: DataFrame, rows: str, columns: str, labels: Sequence[str], percent: bool = False) -> DataFrame:
    """Row-normalised cross table over a fixed label list."""
    factor = 100.0 if percent else 1.0
    counts = df.groupBy(rows).agg(F.count(F.col(columns)).alias("n"),
                                  *[F.count_if(F.col(columns) == label).alias(f"__{label}") for label in labels])
    return counts.select(rows, "n", *[(share(f"__{label}", "n") * factor).alias(label) for label in labels])


def group_summary(df: DataFrame, by: Sequence[str], value: str, min_rows: int = 1,
                  high: Column | None = None) -> DataFrame:
    """Rows, mean, exact median (and share of `high` rows) per group with at least `min_rows` rows."""
    stats = [F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean")]
    if high is not None:
        stats.append(F.avg(F.when(high, 1.0).otherwise(0.0)).alias("high_share"))
    kept = df.groupBy(*by).agg(*stats).filter(F.col("n") >= min_rows)
    medians = grouped_quantiles(df, value, [0.5], by, ["median"])
    return null_safe(kept, medians, list(by))


def item_salaries(df: DataFrame, items: str, salary: str, tier: str, min_rows: int = 1) -> DataFrame:
    """Median salary and High share per item: a posting counts once per distinct item."""
    exploded = df.select(F.explode(F.array_distinct(items)).alias("item"), salary, tier)
    return group_summary(exploded, ["item"], salary, min_rows, F.col(tier) == "High")


def item_counts(df: DataFrame, items: str, item: str = "item") -> DataFrame:
    """Postings per item."""
    return df.select(F.explode(F.array_distinct(items)).alias(item)).groupBy(item).agg(F.count(F.lit(1)).alias("n"))


def item_shares(df: DataFrame, items: str, item: str = "item") -> DataFrame:
    """Share of all postings (empty lists included) per item."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return item_counts(df, items, item).withColumn("share", share("n", total))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows under a total order."""
    return df.orderBy(*order).limit(n)


def both_ends(df: DataFrame, value: str, n: int, tie: str) -> DataFrame:
    """The `n` largest and the `n` smallest values, marked top and bottom."""
    top = df.orderBy(F.col(value).desc(), tie).limit(n).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(value).asc(), tie).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page of an ordered result."""
    return df.orderBy(*order).offset(number * size).limit(size)


def key_set_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on both sides, only left, only right."""
    a = left.select(key).distinct().withColumn("__l", F.lit(1))
    b = right.select(key).distinct().withColumn("__r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("shared"),
                    F.count_if(F.col("__r").isNull()).alias("only_left"),
                    F.count_if(F.col("__l").isNull()).alias("only_right"))


def histogram(df: DataFrame, value: str, bins: int, low: Column | float | None = None,
              high: Column | float | None = None) -> DataFrame:
    """Equal-width counts with an inclusive top edge, plus rows below and above the domain.

    Without a domain the data range is used; a single-valued range is padded.
    """
    if low is None:
        ends = one_row(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")), "lo", "hi")
        pad = F.when(ends["lo"] == ends["hi"], F.greatest(F.lit(1.0), F.abs(ends["lo"]) * 0.01)).otherwise(F.lit(0.0))
        low, high = ends["lo"] - pad, ends["hi"] + pad
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    v = F.col(value).cast("double")
    cell = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((v - low) / (high - low) * bins))).cast("int")
    binned = df.filter(v.isNotNull()).select(F.when(v < low, -1).when(v > high, bins).otherwise(cell).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(-1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: low * (1 - i / F.lit(float(bins))) + high * (i / F.lit(float(bins)))
    inside = (F.col("bin") >= 0) & (F.col("bin") < bins)
    return (frame.join(counts, "bin", "left")
            .select("bin", F.when(inside, edge(F.col("bin"))).alias("low"), F.when(inside, edge(F.col("bin") + 1)).alias("high"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def order_statistics(df: DataFrame, value: str, low_p: float, high_p: float) -> Column:
    """Struct (lo, hi): the values at floor((n-1)p) and ceil((n-1)p) of the sorted column."""
    positions = value_positions(df, value)
    first = F.floor((F.col("total") - 1) * low_p)
    last = F.ceil((F.col("total") - 1) * high_p)
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("w")), F.col("value")))
    return one_row(positions.agg(at(first).alias("lo"), at(last).alias("hi")), "lo", "hi")


def central_histogram(df: DataFrame, value: str, bins: int, low_p: float = 0.05, high_p: float = 0.95) -> DataFrame:
    """Histogram over the central range, bounded by actual values."""
    ends = order_statistics(df, value, low_p, high_p)
    return histogram(df, value, bins, ends["lo"], ends["hi"])


def box_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Minimum, exact quartiles and maximum per group."""
    ends = df.groupBy(*by).agg(F.min(value).alias("minimum"), F.max(value).alias("maximum"))
    quartiles = grouped_quantiles(df, value, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    return null_safe(quartiles, ends, list(by))


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Attach the average rank (ties share it) of a column; NULL stays NULL."""
    ranks = value_positions(df, value).select(
        F.col("value").alias("__v"), (F.col("before") + (F.col("w") + 1) / 2).alias(name))
    return df.join(ranks, F.col(value).cast("double") == F.col("__v"), "left").drop("__v")


def spearman(df: DataFrame, left: str, right: str) -> DataFrame:
    """Spearman rank correlation over rows where both values are present."""
    kept = df.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    ranked = average_rank(average_rank(kept, left, "__a"), right, "__b")
    return ranked.agg(F.corr("__a", "__b").alias("spearman"))


def salary_summary(df: DataFrame, id: str, salary: str) -> DataFrame:
    """Postings, minimum, maximum, mean and median; counts of repeated ids and missing amounts guard the grain."""
    keys = df.groupBy(id).agg(F.count(F.lit(1)).alias("c"))
    repeats = keys.agg(F.count_if(F.col("c") > 1)).scalar()
    median = grouped_quantiles(df, salary, [0.5], names=["median"]).scalar()
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(salary).isNull()).alias("missing"),
                  F.min(salary).alias("minimum"), F.max(salary).alias("maximum"), F.avg(salary).alias("mean")
                  ).withColumns({"median": median, "repeated_ids": repeats})


def overlap_report(df: DataFrame, key: Column | str, is_train: Column) -> DataFrame:
    """How far repeated keys cross a split; blank keys are ignored."""
    keyed = df.select(F.coalesce(col(key), F.lit("")).alias("k"), is_train.alias("train")).filter(F.col("k") != "")
    groups = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.count_if("train").alias("in_train"))
    crossing = (F.col("in_train") > 0) & (F.col("in_train") < F.col("c"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return groups.agg(
        zero(F.sum("c")).alias("nonempty_rows"), F.count_if(F.col("c") > 1).alias("repeated_groups"),
        zero(F.sum(F.when(F.col("c") > 1, F.col("c")))).alias("rows_in_repeated_groups"),
        zero(F.sum(F.col("c") - 1)).alias("excess_rows"), F.count_if(crossing).alias("cross_split_groups"),
        zero(F.sum(F.when(crossing, F.col("c") - F.col("in_train")))).alias("test_rows_with_train_group"),
        zero(F.max("c")).alias("largest_group"))


def benchmark_tiers(external: DataFrame, salary: str, low_max: Column, mid_max: Column) -> DataFrame:
    """Share of external rows in each internal tier."""
    return value_shares(external.select(tier_between(salary, low_max, mid_max).alias("tier")), "tier", K.TIER_LABELS)


def medians_side_by_side(left: DataFrame, right: DataFrame, group: str, left_value: str, right_value: str) -> DataFrame:
    """Group medians of two sources in one table, groups of either side kept."""
    a = grouped_quantiles(left, left_value, [0.5], [group], ["left_median"])
    b = grouped_quantiles(right, right_value, [0.5], [group], ["right_median"])
    return a.join(b, group, "full_outer")


def top_members(df: DataFrame, column: str, n: int, label: str | None = None) -> DataFrame:
    """Most frequent values of a cohort with their share; a missing value is 'Unrecorded'."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(F.coalesce(F.col(column), F.lit("Unrecorded")).alias(label or column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), label or column).limit(n).withColumn("share", share("n", total))


def salary_availability(df: DataFrame, low: str, high: str, predicted: str) -> DataFrame:
    """Postings with a lower bound, an upper bound, both, and estimated ones among these."""
    both = F.col(low).isNotNull() & F.col(high).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(low).isNotNull()).alias("with_min"),
                  F.count_if(F.col(high).isNotNull()).alias("with_max"), F.count_if(both).alias("with_both"),
                  F.count_if(both & F.coalesce(F.col(predicted).cast("int") == 1, F.lit(False))).alias("estimated"))


def cohort(df: DataFrame, items: str | None = None, item: str | None = None, **equal) -> DataFrame:
    """Rows matching every supplied value; None means no restriction."""
    for column, value in equal.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df if item is None else df.filter(F.array_contains(items, item))

