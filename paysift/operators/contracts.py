"""Data contracts, profiling and lineage: the checks a warehouse would enforce."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import values_hash
from ..functions.values import annualise, fixed_tier, present_mean, lookup
from ..scale import col, grouped_quantiles, md5_number, ordinal, with_row
from .. import constants as K


class ContractError(ValueError):
    """A data contract does not hold."""


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or have a NULL part, with their row count."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter((F.col("n_rows") > 1) | missing)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself; raises when a key repeats or is NULL."""
    bad = key_violations(df, keys).limit(3).collect()
    if bad:
        raise ContractError(f"key {list(keys)} is not unique and non-null, e.g. {bad}")
    return df


def foreign_key_violations(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key is absent from the dimension."""
    known = dim.select(F.col(dim_key or key).alias(key))
    return fact.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def domain_violations(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows with a non-NULL value outside the allowed set."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def repeated_items(df: DataFrame, items: str) -> DataFrame:
    """Rows whose list names an item twice."""
    return df.filter(F.size(items) != F.size(F.array_distinct(items)))


def unknown_items(df: DataFrame, items: str, vocabulary: DataFrame, item: str) -> DataFrame:
    """Items used in lists but absent from the vocabulary, with their use count."""
    used = df.select(F.explode(items).alias(item)).groupBy(item).agg(F.count(F.lit(1)).alias("uses"))
    return used.join(vocabulary.select(item), item, "left_anti")


def disagreements(left: DataFrame, right: DataFrame, key: str, numbers: Sequence[str] = (),
                  labels: Sequence[str] = (), tolerance: float = 1e-6) -> DataFrame:
    """Per column, how many shared keys differ (numbers beyond the tolerance)."""
    a = left.select(key, *[F.col(c).alias(f"l_{c}") for c in [*numbers, *labels]])
    b = right.select(key, *[F.col(c).alias(f"r_{c}") for c in [*numbers, *labels]])
    tests = {c: F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) > tolerance for c in numbers}
    tests |= {c: ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in labels}
    joined = a.join(b, key)
    return joined.agg(F.count(F.lit(1)).alias("compared"), *[F.count_if(t).alias(f"differ_{c}") for c, t in tests.items()])


def reconcile(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], values: Sequence[str],
              tolerance: float = 1e-9) -> DataFrame:
    """Full outer comparison of stored and recomputed aggregates: missing, extra and different keys."""
    s = stored.select(*keys, *[F.col(v).cast("double").alias(f"s_{v}") for v in values], F.lit(1).alias("__s"))
    r = recomputed.select(*keys, *[F.col(v).cast("double").alias(f"r_{v}") for v in values], F.lit(1).alias("__r"))
    both = s.join(r, list(keys), "full_outer")
    same = reduce(lambda a, b: a & b, [
        F.coalesce(F.abs(F.col(f"s_{v}") - F.col(f"r_{v}")) <= tolerance, F.col(f"s_{v}").isNull() & F.col(f"r_{v}").isNull())
        for v in values])
    paired = F.col("__s").isNotNull() & F.col("__r").isNotNull()
    return both.agg(F.count_if(paired & same).alias("equal"), F.count_if(paired & ~same).alias("different"),
                    F.count_if(F.col("__r").isNull()).alias("only_stored"),
                    F.count_if(F.col("__s").isNull()).alias("only_recomputed"))


def null_report(df: DataFrame) -> DataFrame:
    """Per column: type, NULL count and percentage, from one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                              F.col(f"`{f.name}`").alias("nulls")) for f in df.schema.fields])
    return (counts.select("__n", F.explode(rows).alias("r"))
            .select("r.column", "r.dtype", "r.nulls", (F.try_divide(F.col("r.nulls") * 100.0, F.col("__n"))).alias("null_pct")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in full."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return distinct.agg(F.coalesce(F.sum("__c"), F.lit(0)).alias("n_rows"),
                        F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_columns(tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Expected key columns that a table lacks."""
    return {name: [c for c in columns if name not in tables or c not in tables[name].columns]
            for name, columns in expected.items()
            if name not in tables or set(columns) - set(tables[name].columns)}


def describe_number(df: DataFrame, value: Column | str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    quartiles = grouped_quantiles(df, value, [0.25, 0.5, 0.75], names=["q25", "q50", "q75"])
    stats = df.agg(F.count(col(value)).alias("n"), F.avg(col(value)).alias("mean"), F.stddev_samp(col(value)).alias("std"),
                   F.min(col(value)).alias("minimum"), F.max(col(value)).alias("maximum"))
    return with_row(stats, quartiles)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """A reproducible sample of `n` rows without replacement: the smallest hashes of key and seed.

    Rows whose hash is far above the n-th smallest (by more than twenty standard deviations)
    are dropped where they lie, so the final ordering sees little more than `n` rows.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    bar = F.ceil(F.try_divide(F.lit((n + 20 * math.sqrt(n) + 20) * 4294967296.0), total))
    hashed = df.withColumn("__h", md5_number(key, F.lit(seed)))
    return hashed.filter(F.col("__h") <= bar).orderBy("__h", key).limit(n).drop("__h")


def annualisation_audit(raw: DataFrame, cleaned: DataFrame, id: str = "job_id", salary: str = "normalized_salary",
                        low: str = "min_salary", high: str = "max_salary", middle: str = "med_salary",
                        period: str = "pay_period", tier: str = "salary_tier", tolerance: float = 0.011) -> DataFrame:
    """Fills, vendor-versus-formula mismatches and saved-tier mismatches in one row."""
    formula = (F.coalesce(present_mean(low, high), F.col(middle)) * lookup(F.upper(F.col(period)), K.PAY_PERIOD_TO_ANNUAL))
    filled = annualise(salary, low, high, middle, period)
    comparable = F.col(salary).isNotNull() & formula.isNotNull()
    rawside = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col(salary).isNull()).alias("raw_missing"),
        F.count_if(F.col(salary).isNull() & filled.isNotNull()).alias("fills"),
        F.count_if(comparable).alias("comparable"),
        F.count_if(comparable & (F.abs(F.col(salary) - formula) > tolerance)).alias("formula_mismatches"))
    original = raw.groupBy(id).agg(F.min(salary).alias("__raw"))
    cleanside = (cleaned.join(original, id, "left")
                 .agg(F.count(F.lit(1)).alias("cleaned_rows"), F.count_if(F.col("__raw").isNull()).alias("cleaned_missing_raw"),
                      F.count_if(F.abs(F.col(salary) - F.col("__raw")) > tolerance).alias("salary_mismatches"),
                      F.count_if(~fixed_tier(salary).eqNullSafe(F.col(tier))).alias("tier_mismatches")))
    return with_row(cleanside, rawside)


def formula_mismatch_by_period(raw: DataFrame, salary: str = "normalized_salary", low: str = "min_salary",
                               high: str = "max_salary", middle: str = "med_salary", period: str = "pay_period",
                               tolerance: float = 0.011) -> DataFrame:
    """Rows and formula mismatches per pay period; a missing period is 'MISSING'."""
    formula = (F.coalesce(present_mean(low, high), F.col(middle)) * lookup(F.upper(F.col(period)), K.PAY_PERIOD_TO_ANNUAL))
    differs = F.coalesce(F.abs(F.col(salary) - formula) > tolerance, F.lit(False))
    return (raw.groupBy(F.coalesce(F.col(period), F.lit("MISSING")).alias("period"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("mismatches")))


def repost_stats(df: DataFrame, keys: Sequence[str], id: str, group: str = "repost_group") -> DataFrame:
    """Hash, size and smallest id of each row's repost group; no row is dropped."""
    hashed = df.withColumn(group, values_hash(*keys))
    stats = hashed.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"), F.min(id).alias("representative"))
    return hashed.join(stats, group)


def salary_lineage(retained: DataFrame, raw: DataFrame, id: str, repost_keys: Sequence[str], fields: Sequence[str],
                   salary: str, tier: str, order: str, tolerance: str = "0.0051") -> DataFrame:
    """Every retained row with its raw record, original texts, repost group and a tolerance check.

    `fields` are exact texts; amounts are compared as decimals.
    """
    numbered = ordinal(raw.select(*dict.fromkeys([id, order, *repost_keys, *fields])), [order, id], "source_record", 1)
    grouped = repost_stats(numbered, repost_keys, id)
    source = grouped.select(id, "source_record", "repost_group", "group_size", "representative",
                            *[F.col(f).cast("string").alias(f"source_{f}") for f in fields])
    joined = retained.select(id, F.col(salary).cast("string").alias("canonical_salary"), F.col(tier).alias("canonical_tier")
                             ).join(source, id, "left")
    linked = F.col("source_record").isNotNull()
    known = F.coalesce(F.col(f"source_{salary}"), F.lit("")) != ""
    gap = F.abs(F.col(f"source_{salary}").try_cast("decimal(20,6)") - F.col("canonical_salary").try_cast("decimal(20,6)"))
    return joined.withColumns({
        "source_status": F.when(linked, "linked").otherwise("unavailable"),
        "salary_origin": F.when(known, "source").otherwise("unavailable"),
        "salary_estimation_status": F.lit("unknown"),
        "within_tolerance": ~known | F.coalesce(gap <= F.lit(tolerance).cast("decimal(20,6)"), F.lit(False))})


def winner_conflicts(scores: DataFrame, stored: DataFrame, candidate: str, score: str, order: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Groups whose stored winner is not the best mean score (ties: earliest candidate)."""
    best = F.max_by(candidate, F.struct(F.col(score), -F.col(order)))
    computed = scores.groupBy(*keys).agg(best.alias("computed_winner"))
    if not keys:
        return stored.withColumn("computed_winner", computed.scalar()).filter(
            ~F.col("computed_winner").eqNullSafe(F.col("winner")))
    return stored.join(computed, list(keys), "full_outer").filter(~F.col("computed_winner").eqNullSafe(F.col("winner")))


def assignment_differences(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys missing on a side and mismatches per column of two assignment tables."""
    a = left.select(key, *[F.col(c).alias(f"l_{c}") for c in columns], F.lit(1).alias("__l"))
    b = right.select(key, *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(1).alias("__r"))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("__l").isNull() | F.col("__r").isNull()).alias("missing_or_extra"),
                    *[F.count_if(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(f"{c}_mismatches") for c in columns])


def rounding_discrepancies(saved: DataFrame, exact: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                           limit: float = 0.000050001) -> DataFrame:
    """Per metric: saved values off by more than their rounding, and the largest gap."""
    a = saved.select(*keys, *[F.col(m).alias(f"s_{m}") for m in metrics])
    joined = a.join(exact.select(*keys, *metrics), list(keys))
    stats = joined.agg(*[F.count_if(F.abs(F.col(f"s_{m}") - F.col(m)) > limit).alias(f"n_{m}") for m in metrics],
                       *[F.max(F.abs(F.col(f"s_{m}") - F.col(m))).alias(f"d_{m}") for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"n_{m}").alias("beyond_rounding"),
                              F.col(f"d_{m}").alias("max_delta")) for m in metrics])
    return stats.select(F.inline(rows))


def length_mismatches(df: DataFrame, items: str, stored: str) -> DataFrame:
    """Rows whose stored list length is wrong."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(stored) != F.size(items)).alias("mismatches"))

