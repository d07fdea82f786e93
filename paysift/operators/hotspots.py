"""Comparing neighbourhoods across spaces, and regions dominated by High-tier rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import share
from ..scale import materialise, top_per_key
from .density import dbscan_points
from .neighbours import chance_purity, knn_join, knn_overlap, label_purity


def compare_spaces(spaces: Mapping[str, DataFrame], labels: DataFrame, id: str, vector: str, label_columns: Sequence[str], k: int = 15) -> DataFrame:
    """Per space: overlap of its neighbours with the first space's, and purity of each label; last row is chance.

    `spaces` hold one sample in different coordinates.
    """
    reference, out = None, None
    total = labels.agg(F.count(F.lit(1))).scalar()
    for name, frame in spaces.items():
        near = materialise(knn_join(frame, id, vector, k))
        reference = near if reference is None else reference
        row = knn_overlap(near, reference, id, k).select(F.lit(name).alias("space"), "knn_overlap")
        for label in label_columns:
            row = row.withColumn(f"{label}_purity", label_purity(near, labels, id, label).scalar())
        out = row if out is None else out.unionByName(row)
    chance = labels.agg(F.count(F.lit(1))).select(F.lit("chance").alias("space"), (F.lit(float(k)) / total).alias("knn_overlap"))
    for label in label_columns:
        chance = chance.withColumn(f"{label}_purity", chance_purity(labels, label).scalar())
    return out.unionByName(chance)


def high_share_around(neighbours: DataFrame, tiers: DataFrame, id: str, tier: str, high: str = "High") -> DataFrame:
    """Share of High rows among each row's neighbours."""
    flags = tiers.select(F.col(id).alias("neighbour"), (F.col(tier) == high).cast("int").alias("h"))
    return neighbours.join(flags, "neighbour").groupBy(id).agg(F.avg("h").alias("high_share_around"))


def high_tier_hotspots(points: DataFrame, id: str, coordinates: Sequence[str], tier: str, neighbours: int = 30, min_high: float = 0.7,
                       eps: float = 3.0, min_samples: int = 20, high: str = "High") -> DataFrame:
    """Hotspot number of every row that lies among mostly High neighbours and in a dense group of such rows (-1: none)."""
    vectors = points.select(id, F.array(*[F.col(c).cast("double") for c in coordinates]).alias("v"))
    around = high_share_around(knn_join(vectors, id, "v", neighbours), points, id, tier, high)
    hot = materialise(points.join(around.filter(F.col("high_share_around") >= min_high).select(id), id, "left_semi"))
    return dbscan_points(hot, id, coordinates, eps, min_samples).select(id, F.col("cluster").alias("hotspot"))


def describe_hotspots(points: DataFrame, hotspots: DataFrame, id: str, coordinates: Sequence[str], tier: str, cluster: str, items: str,
                      title: str, item_shares: DataFrame, min_share: float = 0.3, top: int = 5, high: str = "High") -> DataFrame:
    """Size, High share, majority cluster, top items by lift, top titles and centre of each hotspot, largest first."""
    members = materialise(points.join(hotspots.filter(F.col("hotspot") >= 0), id))
    stats = members.groupBy("hotspot").agg(F.count(F.lit(1)).alias("jobs"), F.avg((F.col(tier) == high).cast("int")).alias("high_share"),
                                           *[F.avg(c).alias(f"centre_{c}") for c in coordinates])
    mode = members.groupBy("hotspot", cluster).agg(F.count(F.lit(1)).alias("c"))
    majority = mode.groupBy("hotspot").agg(F.max_by(cluster, F.struct("c", -F.col(cluster))).alias("majority_cluster"), F.max("c").alias("majority_jobs"))
    counts = members.select("hotspot", F.explode(F.array_distinct(items)).alias("item")).groupBy("hotspot", "item").agg(F.count(F.lit(1)).alias("c"))
    lifts = counts.join(stats.select("hotspot", "jobs"), "hotspot").join(item_shares.select("item", F.col("share").alias("overall")), "item").withColumn(
        "s", share("c", "jobs")).filter(F.col("s") >= min_share).withColumn("lift", F.try_divide("s", "overall"))
    listed = lambda df, col: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", col))), lambda x: x[col]), ", ")
    best = top_per_key(lifts, ["hotspot"], [F.col("lift").desc(), F.col("item")], top, "rank").groupBy("hotspot").agg(listed(lifts, "item").alias("top_items"))
    titles = members.groupBy("hotspot", title).agg(F.count(F.lit(1)).alias("c"))
    named = top_per_key(titles, ["hotspot"], [F.col("c").desc(), F.col(title)], 3, "rank").groupBy("hotspot").agg(listed(titles, title).alias("top_titles"))
    return (stats.join(majority, "hotspot").withColumn("majority_share", share("majority_jobs", "jobs")).drop("majority_jobs")
            .join(best, "hotspot", "left").join(named, "hotspot", "left").orderBy(F.col("jobs").desc(), "hotspot"))
