"""Published tables: job facts, roles, skills, snapshots, profiles, key numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import is_recent
from ..functions.values import share, strict_bool, tier_code
from ..scale import grouped_quantiles, null_safe, top_per_key, with_row
from .aggregates import histogram, top_members
from .contracts import ContractError
from .graph import related_titles
from .windows import company_cap, dense_index, index_by_frequency


def item_fact(df: DataFrame, id: str, items: str) -> DataFrame:
    """Distinct (job, item) pairs."""
    return df.select(id, F.explode(F.array_distinct(items)).alias("item"))


def job_facts(df: DataFrame, items: str, salary: str, tier: str, vocabulary: DataFrame) -> DataFrame:
    """One row: jobs, vocabulary size, jobs without items, mean items, median and tier counts."""
    n = F.size(F.array_distinct(items))
    median = grouped_quantiles(df, salary, [0.5], names=["m"]).scalar()
    size = vocabulary.agg(F.count(F.lit(1))).scalar()
    return df.agg(F.count(F.lit(1)).alias("n_jobs"), F.count_if(n == 0).alias("zero_item_jobs"), F.avg(n).alias("mean_items"),
                  F.sum(n).cast("bigint").alias("distinct_pairs"), F.min(salary).alias("salary_min"), F.max(salary).alias("salary_max"),
                  F.avg(salary).alias("salary_mean"), *[F.count_if(F.col(tier) == t).alias(f"jobs_{t.lower()}") for t in K.TIER_LABELS]
                  ).withColumns({"salary_median": median, "vocabulary_size": size})


def item_mart(df: DataFrame, items: str, vocabulary: DataFrame, item: str, technical: DataFrame | None = None,
              flag: str = "is_technical") -> DataFrame:
    """Every vocabulary item in vocabulary order: count (0 included), share, and a three-valued technical flag."""
    counts = df.select(F.explode(F.array_distinct(items)).alias(item)).groupBy(item).agg(F.count(F.lit(1)).alias("c"))
    total = df.agg(F.count(F.lit(1))).scalar()
    joined = vocabulary.join(counts, item, "left").withColumn("n", F.coalesce("c", F.lit(0))).drop("c")
    joined = joined.withColumn("share", share("n", total))
    if technical is None:
        return joined.withColumn(flag, F.lit(None).cast("boolean"))
    known = technical.select(item, strict_bool(flag).alias(flag)).groupBy(item).agg(F.max(flag).alias(flag))
    return joined.join(known, item, "left")


def snapshot_mart(df: DataFrame, cap: int, date: str = "fetch_date", **columns: str) -> DataFrame:
    """Full and company-capped rows per snapshot."""
    full = df.groupBy(date).agg(F.count(F.lit(1)).alias("n_rows"))
    capped = company_cap(df, cap, date, **columns).groupBy(date).agg(F.count(F.lit(1)).alias("capped_rows"))
    return full.join(capped, date)


def assign_roles(jobs: DataFrame, labels: DataFrame, id: str, cluster: str, name: str, unknown_id: int = -1, unknown: str = "Unknown") -> DataFrame:
    """Role of every job from saved cluster labels; jobs without a label get the Unknown role.

    A cluster id with two names, or an unknown job id, is an error.
    """
    clash = labels.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.countDistinct(name).alias("n")).filter(F.col("n") > 1)
    if clash.limit(1).count():
        raise ContractError("a cluster id has conflicting names")
    if labels.join(jobs, id, "left_anti").limit(1).count():
        raise ContractError("a label refers to an unknown job")
    joined = jobs.join(labels.select(id, F.col(cluster).cast("int").alias("role_id"), F.col(name).alias("role_name")), id, "left")
    return joined.withColumn("role_name", F.when(F.col("role_id").isNull(), unknown).otherwise(F.col("role_name"))).withColumn(
        "role_id", F.coalesce("role_id", F.lit(unknown_id)))


def role_mart(jobs: DataFrame, role: str, salary: str, tier: str) -> DataFrame:
    """Jobs, exact median and High share per role."""
    stats = jobs.groupBy(role).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(tier) == "High").cast("int")).alias("high_share"))
    return null_safe(stats, grouped_quantiles(jobs, salary, [0.5], [role], ["median_salary"]), [role])


def role_items(jobs: DataFrame, role: str, items: str, top: int = 8) -> DataFrame:
    """Top items of each role with their share there and overall."""
    sizes = jobs.groupBy(role).agg(F.count(F.lit(1)).alias("size"))
    total = jobs.agg(F.count(F.lit(1))).scalar()
    counts = jobs.select(role, F.explode(F.array_distinct(items)).alias("item")).groupBy(role, "item").agg(F.count(F.lit(1)).alias("n"))
    overall = counts.groupBy("item").agg(F.sum("n").alias("o"))
    best = top_per_key(counts, [role], [F.col("n").desc(), F.col("item")], top, "rank")
    return best.join(sizes, role).join(overall, "item").select(role, "rank", "item", "n", share("n", "size").alias("share"),
                                                               share("o", total).alias("overall_share"))


def encode_rows(jobs: DataFrame, id: str, salary: str, role: str, location: str, items: str, tier: str, vocabulary: DataFrame,
                item: str, index: str) -> DataFrame:
    """Compact rows: salary, role index, location index (most frequent first), sorted item indices, tier index."""
    roles = dense_index(jobs.select(role).distinct(), [role], "role_index")
    places = index_by_frequency(jobs, location, "location_index").select(location, "location_index")
    codes = jobs.select(id, F.explode(F.array_distinct(items)).alias(item)).join(vocabulary.select(item, index), item).groupBy(id).agg(
        F.array_sort(F.collect_list(index)).alias("item_indices"))
    joined = null_safe(null_safe(jobs, roles, [role]), places, [location]).join(codes, id, "left")
    empty = F.array().cast(f"array<{vocabulary.schema[index].dataType.simpleString()}>")
    return joined.select(id, F.col(salary).alias("salary"), "role_index", "location_index",
                         F.coalesce("item_indices", empty).alias("item_indices"), tier_code(tier).alias("tier_index"))


def posting_mart(sources: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Postings of all sources in one table."""
    out = None
    for name, df in sources.items():
        part = df.select(F.lit(name).alias("source"), *columns)
        out = part if out is None else out.unionByName(part)
    return out


def audit_counts(df: DataFrame, items: str, date: str) -> DataFrame:
    """Rows, mean items, empty rows and dates of a postings table."""
    n = F.size(items)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(n).alias("mean_items"), F.count_if(n == 0).alias("zero_rows"),
                  F.countDistinct(date).alias("dates"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def rule_audit(validation: DataFrame, ceiling: float = 2.0, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Confirmed rules, failures blocked by the lift ceiling, and failures with little headroom."""
    confirmed, max_lift = F.col("validated"), F.col("max_lift")
    headroom = ~confirmed & (max_lift > min_lift) & (max_lift < ceiling)
    return validation.agg(F.count(F.lit(1)).alias("rules"), F.count_if(confirmed).alias("confirmed"),
                          F.count_if(~confirmed & F.col("lift_ceiling_blocks_threshold")).alias("blocked_by_ceiling"),
                          F.count_if(F.coalesce(headroom, F.lit(False))).alias("little_headroom"),
                          F.count_if(F.coalesce(headroom & (F.col("confidence") > F.col("training_confidence")), F.lit(False))).alias("headroom_higher_confidence"))


def career_profile(cohort: DataFrame, everyone: DataFrame, title: str, chosen: str, items: str, salary: str, location: str, company: str,
                   top: int = 8, bins: int = 24, min_jobs: int = 25) -> dict[str, DataFrame]:
    """Views of one title's cohort: size, items, places, employers, related titles, salary distribution."""
    n = cohort.agg(F.count(F.lit(1)).alias("n"))
    counts = cohort.select(F.explode(F.array_distinct(items)).alias("item"))
    return {"size": n, "items": top_members(counts, "item", top), "locations": top_members(cohort, location, top),
            "employers": top_members(cohort, company, top),
            "related": related_titles(everyone, title, items, min_jobs=min_jobs, of=chosen),
            "distribution": histogram(cohort, salary, bins)}


def key_numbers(postings: DataFrame, published: str, fetched: Column, company: str) -> DataFrame:
    """Postings, recent share, companies, and the largest employer with its share."""
    counts = postings.groupBy(company).agg(F.count(F.lit(1)).alias("c"))
    largest = counts.filter(F.col(company).isNotNull()).orderBy(F.col("c").desc(), company).limit(1).select(
        F.col(company).alias("top_company"), F.col("c").alias("__c"))
    stats = postings.agg(F.count(F.lit(1)).alias("postings"), F.avg(is_recent(published, fetched).cast("int")).alias("recent_share"),
                         F.countDistinct(company).alias("companies"), F.min(published).alias("first_published"),
                         F.max(published).alias("last_published"))
    return with_row(stats, largest).withColumn("top_company_share", share("__c", "postings")).drop("__c")


def source_reference(sources: Mapping[str, DataFrame], words: str, items: str) -> DataFrame:
    """Mean words and items per posting of each source, side by side."""
    out = None
    for name, df in sources.items():
        row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(words).alias("mean_words"), F.avg(F.size(items)).alias("mean_items"))
        row = row.select(F.lit(name).alias("source"), "*")
        out = row if out is None else out.unionByName(row)
    return out
