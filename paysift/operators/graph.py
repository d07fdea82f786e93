"""Co-occurrence and similarity graphs over items and titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import share
from ..scale import grouped_quantiles, materialise, top_per_key
from .rules import pair_metrics


def cooccurrence_edges(df: DataFrame, items: str, min_support: float = K.MIN_SUPPORT) -> DataFrame:
    """Item pairs in at least `min_support` of all postings, with count, support and lift.

    Only items that reach the support alone are paired, so a list forms few pairs.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.select(F.explode(F.array_distinct(items)).alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("c"))
    kept = counts.filter(F.col("c") >= total * min_support).agg(F.collect_list("i")).scalar()
    frequent = df.withColumn(items, F.array_intersect(F.coalesce(F.col(items), F.array().cast("array<string>")), kept))
    edges = pair_metrics(frequent, items)
    return edges.filter(F.col("support") >= min_support).select("a", "b", "jobs", "a_jobs", "b_jobs", "n", "support", "lift")


def endpoints(edges: DataFrame) -> DataFrame:
    """Each undirected edge seen from both ends: node, neighbour and the edge's columns."""
    rest = [c for c in edges.columns if c not in ("a", "b", "a_jobs", "b_jobs")]
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour")),
                             F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour"))))
    return edges.select(ends.alias("e"), *rest).select("e.*", *rest)


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Nodes of the graph with count, support and degree."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a_jobs").alias("jobs")),
                             F.struct(F.col("b").alias("node"), F.col("b_jobs").alias("jobs"))))
    return edges.select(ends.alias("e"), "n").groupBy("e.node").agg(
        F.max("e.jobs").alias("jobs"), F.max(share("e.jobs", "n")).alias("support"), F.count(F.lit(1)).alias("degree"))


def hubs(edges: DataFrame, n: int = 10) -> DataFrame:
    """Most connected nodes."""
    return graph_nodes(edges).orderBy(F.col("degree").desc(), F.col("jobs").desc(), "node").limit(n)


def strongest_edges(edges: DataFrame, n: int = 10, min_lift: float = 0.0) -> DataFrame:
    """Edges by lift."""
    return edges.filter(F.col("lift") >= min_lift).orderBy(F.col("lift").desc(), F.col("jobs").desc(), "a", "b").limit(n)


def top_items(df: DataFrame, items: str, n: int, within: Sequence[str] | None = None) -> DataFrame:
    """The `n` most frequent items (ties by name), optionally of a given set."""
    exploded = df.select(F.explode(F.array_distinct(items)).alias("item"))
    if within is not None:
        exploded = exploded.filter(F.col("item").isin(list(within)))
    return exploded.groupBy("item").agg(F.count(F.lit(1)).alias("jobs")).orderBy(F.col("jobs").desc(), "item").limit(n)


def jaccard_edges(df: DataFrame, items: str, n: int = 24, strongest: int = 2,
                  within: Sequence[str] | None = None) -> DataFrame:
    """Union of every top item's strongest positive Jaccard neighbours among the top items (a < b).

    Lists are cut to the chosen items first, so at most n(n-1)/2 pairs exist.
    """
    chosen = top_items(df, items, n, within).agg(F.collect_list("item")).scalar()
    reduced = df.withColumn(items, F.array_intersect(items, chosen))
    pairs = materialise(pair_metrics(reduced, items).select("a", "b", "jobs", "a_jobs", "b_jobs", "jaccard"))
    sides = endpoints(pairs).select("node", "neighbour", "jobs", "jaccard")
    best = top_per_key(sides, ["node"], [F.col("jaccard").desc(), F.col("jobs").desc(), F.col("neighbour")], strongest)
    kept = best.select(F.least("node", "neighbour").alias("a"), F.greatest("node", "neighbour").alias("b")).distinct()
    return pairs.join(kept, ["a", "b"], "left_semi")


def majority_group(df: DataFrame, items: str, group: str, nodes: DataFrame) -> DataFrame:
    """Each node's most frequent group (ties: smallest group)."""
    counts = (df.select(group, F.explode(F.array_distinct(items)).alias("item")).groupBy("item", group)
              .agg(F.count(F.lit(1)).alias("c")))
    best = counts.groupBy("item").agg(F.min_by(group, F.struct((-F.col("c")).alias("c"), F.col(group))).alias(group))
    return nodes.join(best, "item", "left")


def item_neighbours(df: DataFrame, items: str, n: int = 6, of: DataFrame | None = None) -> DataFrame:
    """The items most often listed together with each item, and their share of its postings."""
    pairs = pair_metrics(df, items)
    ends = F.explode(F.array(F.struct(F.col("a").alias("item"), F.col("b").alias("neighbour"), F.col("a_jobs").alias("c")),
                             F.struct(F.col("b").alias("item"), F.col("a").alias("neighbour"), F.col("b_jobs").alias("c"))))
    sides = pairs.select(ends.alias("e"), "jobs").select("e.item", "e.neighbour", "jobs", share("jobs", "e.c").alias("share_among_selected"))
    if of is not None:
        sides = sides.join(of.select("item"), "item", "left_semi")
    return top_per_key(sides, ["item"], [F.col("jobs").desc(), F.col("neighbour")], n)


def item_neighbourhood(df: DataFrame, items: str, item: str, n: int = 11) -> DataFrame:
    """Co-listed items of one item by Jaccard similarity."""
    holding = F.array_contains(items, item)
    counts = df.select(holding.alias("h"), F.explode(F.array_distinct(items)).alias("neighbour")).groupBy("neighbour").agg(
        F.count(F.lit(1)).alias("c"), F.count_if("h").alias("jobs"))
    selected = df.agg(F.count_if(holding)).scalar()
    near = counts.filter((F.col("neighbour") != item) & (F.col("jobs") > 0))
    return (near.select("neighbour", "jobs", share("jobs", selected + F.col("c") - F.col("jobs")).alias("jaccard"))
            .orderBy(F.col("jaccard").desc(), F.col("jobs").desc(), "neighbour").limit(n))


def edge_neighbours(edges: DataFrame, node: Column | str, weight: str = "jaccard") -> DataFrame:
    """Neighbours of one node in an edge list, strongest first."""
    return (endpoints(edges).filter(F.col("node") == node).select("neighbour", "jobs", weight)
            .orderBy(F.col(weight).desc(), F.col("jobs").desc(), "neighbour"))


def cohort_network(df: DataFrame, items: str, nodes: int = 12, edges: int = 18) -> DataFrame:
    """Most similar pairs among the top items of a cohort."""
    chosen = top_items(df, items, nodes).agg(F.collect_list("item")).scalar()
    pairs = pair_metrics(df.withColumn(items, F.array_intersect(items, chosen)), items)
    return pairs.select("a", "b", "jobs", "jaccard").orderBy(F.col("jaccard").desc(), "a", "b").limit(edges)


def title_groups(df: DataFrame, title: str, salary: str) -> DataFrame:
    """Postings and exact median salary per title."""
    medians = grouped_quantiles(df, salary, [0.5], [title], ["median_salary"])
    return df.groupBy(title).agg(F.count(F.lit(1)).alias("n")).join(medians, title, "left")


def default_title(groups: DataFrame, title: str, preferred: str = "software engineer", min_jobs: int = 25) -> DataFrame:
    """The title shown first: the preferred one if large enough, else the largest large one, else the largest."""
    large = F.col("n") >= min_jobs
    priority = F.when(large & (F.col(title) == preferred), 0).when(large, 1).otherwise(2)
    return groups.orderBy(priority, F.col("n").desc(), title).limit(1)


def featured_pool(groups: DataFrame, title: str, pool: Sequence[str] = tuple(K.FEATURED_TITLES), min_jobs: int = 25,
                  fallback: int = 8) -> DataFrame:
    """Large enough titles of the curated pool, or the largest large titles when none qualifies."""
    eligible = groups.filter(F.col("n") >= min_jobs)
    curated = eligible.filter(F.col(title).isin(list(pool)))
    none = curated.agg(F.count(F.lit(1))).scalar() == 0
    largest = eligible.orderBy(F.col("n").desc(), title).limit(fallback).filter(none)
    return curated.unionByName(largest)


def title_profiles(df: DataFrame, title: str, items: str, min_jobs: int = 25, prevalence: float = 0.2) -> DataFrame:
    """Items in at least `prevalence` of a title's postings, for titles with enough postings.

    A profile has at most mean list length / prevalence items.
    """
    sizes = df.groupBy(title).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_jobs)
    counts = df.select(title, F.explode(F.array_distinct(items)).alias("item")).groupBy(title, "item").agg(F.count(F.lit(1)).alias("c"))
    return counts.join(sizes, title).filter(F.col("c") >= F.col("n") * prevalence).select(title, "item", "n")


def related_titles(df: DataFrame, title: str, items: str, min_jobs: int = 25, prevalence: float = 0.2, min_shared: int = 2,
                   min_jaccard: float = 0.25, of: str | None = None) -> DataFrame:
    """Title pairs whose profiles share enough items, by Jaccard similarity of the profiles."""
    profiles = materialise(title_profiles(df, title, items, min_jobs, prevalence))
    sizes = profiles.groupBy(title).agg(F.count(F.lit(1)).alias("size"), F.max("n").alias("n"))
    left = profiles.select(F.col(title).alias("title"), "item")
    if of is not None:
        left = left.filter(F.col("title") == of)
    shared = (left.join(profiles.select(F.col(title).alias("related"), "item"), "item").filter(F.col("title") != F.col("related"))
              .groupBy("title", "related").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= min_shared))
    joined = (shared.join(sizes.select(F.col(title).alias("title"), F.col("size").alias("s")), "title")
              .join(sizes.select(F.col(title).alias("related"), F.col("size").alias("t"), F.col("n").alias("related_jobs")), "related"))
    jaccard = share("shared", F.col("s") + F.col("t") - F.col("shared"))
    return joined.withColumn("jaccard", jaccard).filter(F.col("jaccard") >= min_jaccard).select(
        "title", "related", "related_jobs", "shared", "jaccard")
