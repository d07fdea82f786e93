"""Isolation forest and salary mismatches."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import share
from ..scale import grouped_quantiles, materialise
from .aggregates import spearman
from .clustering import experience_codes, svd_rows
from .windows import group_zscore

TREES = 300
SAMPLE = 256
POOL = 2.0


def outlier_features(df: DataFrame, items: str, vocabulary: Sequence[str], experience: str, salary: str, output: str = "x") -> DataFrame:
    """Item indicators, experience code and salary as one array.

    The vocabulary travels as an array, so a row's indicators are one membership test each.
    """
    flags = F.transform(F.array(*[F.lit(v) for v in vocabulary]), lambda v: F.array_contains(F.col(items), v).cast("double"))
    rest = F.array(experience_codes(experience).cast("double"), F.col(salary).cast("double"))
    return df.withColumn(output, F.concat(flags, rest))


def compact_features(df: DataFrame, id: str, items: str, experience: str, salary: str, components: int = 10, output: str = "x") -> DataFrame:
    """Few singular-vector coordinates, item count, experience code and salary as one array."""
    coordinates = svd_rows(df, id, items, components, tfidf=False, unit=False)
    empty = F.array_repeat(F.lit(0.0), components)
    rest = F.array(F.size(items).cast("double"), experience_codes(experience).cast("double"), F.col(salary).cast("double"))
    return df.join(coordinates, id, "left").withColumn(output, F.concat(F.coalesce("coordinates", empty), rest)).drop("coordinates")


def _path_bonus(n: float) -> float:
    """Expected remaining path length in a leaf of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, float]]:
    """One isolation tree as rows (feature, threshold, left, right, path length); feature -1 is a leaf."""
    nodes: list = []

    def build(rows: np.ndarray, depth: int) -> int:
        here = len(nodes)
        nodes.append(None)
        spread = np.flatnonzero(x[rows].max(0) > x[rows].min(0)) if len(rows) > 1 and depth < limit else []
        if not len(spread):
            nodes[here] = (-1, 0.0, -1, -1, depth + _path_bonus(len(rows)))
            return here
        feature = int(rng.choice(spread))
        values = x[rows, feature]
        threshold = float(rng.uniform(values.min(), values.max()))
        below = values <= threshold
        nodes[here] = (feature, threshold, build(rows[below], depth + 1), build(rows[~below], depth + 1), 0.0)
        return here

    build(np.arange(len(x)), 0)
    return nodes


def fit_forest(df: DataFrame, id: str, features: str, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> tuple[list, int]:
    """(trees, sample size): each tree is grown on its own seeded sample, one group per tree.

    A pool row joins a tree by hash with a probability a little above what its sample
    needs; the tree then takes the smallest hashes, so a group stays near the sample size.
    """
    whole = 0x100000000
    number = lambda *parts: F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(whole))
    # A seeded pool a few times the trees' needs; only its rows are hashed once per tree.
    total = df.count()
    share = min(1.0, POOL * trees * sample / max(total, 1))
    pool = materialise(df.filter(number(F.col(id), F.lit("pool")) < int(share * whole)).select(F.col(id).alias("id"), F.col(features).alias("x")))
    rows = pool.count()
    size = min(sample, rows)
    bar = int(min(1.0, (size + 6.0 * math.sqrt(size) + 6) / max(rows, 1)) * whole)
    hashes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), number(F.col("id"), t).alias("hash"))), lambda p: p["hash"] < bar)
    pools = pool.select("x", F.explode(hashes).alias("p")).select("p.tree", "p.hash", "x")
    limit = max(1, math.ceil(math.log2(max(size, 2))))

    def grow(pool: pd.DataFrame) -> pd.DataFrame:
        tree = int(pool["tree"].iloc[0])
        pool = pool.sort_values("hash", kind="stable").head(size)
        x = np.array(pool["x"].tolist(), dtype=float)
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame([(tree, i, *n) for i, n in enumerate(nodes)], columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    schema = "tree int, node int, feature int, threshold double, left int, right int, path double"
    grown = pools.groupBy("tree").applyInPandas(grow, schema).orderBy("tree", "node").toPandas()  # trees x 2 x sample rows at most
    forest = [tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path")) for _, g in grown.groupby("tree")]
    return forest, size


def _walkable(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, path: np.ndarray) -> tuple:
    """A tree to be walked by all rows for `depth` steps: a leaf leads to itself; children alternate, the one above the threshold first."""
    leaf, here = feature < 0, np.arange(len(feature))
    child = np.stack([np.where(leaf, here, right), np.where(leaf, here, left)], axis=1).ravel()
    depth, level = 0, here[:1]
    while len(level := level[~leaf[level]]):
        depth, level = depth + 1, np.concatenate([left[level], right[level]])
    return np.where(leaf, 0, feature), threshold, child, path, depth


def anomaly_scores(df: DataFrame, features: str, forest: list, size: int, output: str = "anomaly_score") -> DataFrame:
    """Score in (0, 1), higher is more anomalous: 2 to the minus (mean path over expected path)."""
    normal = max(_path_bonus(size), 1e-9)
    trees = [_walkable(*tree) for tree in forest]

    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        flat = values.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        base = np.arange(len(values)) * (len(flat) // max(len(values), 1))
        total = np.zeros(len(values))
        for feature, threshold, child, path, depth in trees:
            at = np.zeros(len(values), np.int64)
            for _ in range(depth):
                at = child[2 * at + (flat[base + feature[at]] <= threshold[at])]
            total += path[at]
        return pa.array(np.exp2(-total / len(trees) / normal))

    return df.withColumn(output, score(F.col(features)))


def isolation_forest(df: DataFrame, id: str, features: str, contamination: float = 0.01, trees: int = TREES, sample: int = SAMPLE,
                     seed: int = 42) -> DataFrame:
    """Adds `anomaly_score` and `flagged`: rows above the exact contamination quantile of the scores."""
    forest, size = fit_forest(df, id, features, trees, sample, seed)
    scored = materialise(anomaly_scores(df, features, forest, size))
    bar = grouped_quantiles(scored, "anomaly_score", [1.0 - contamination], names=["q"]).scalar()
    return scored.withColumn("flagged", F.col("anomaly_score") > bar)


def salary_mismatch(df: DataFrame, salary: str, groups: Sequence[str], name: str = "z") -> DataFrame:
    """Standard score of the log salary within skill cluster and experience."""
    return group_zscore(df, F.ln(F.col(salary)), groups, name)


def outlier_table(df: DataFrame, items: str, keep: Sequence[str]) -> DataFrame:
    """Flagged rows, most anomalous first, item lists as text."""
    return (df.filter("flagged").select(*keep, F.array_join(items, "; ").alias(items), F.bround("anomaly_score", 4).alias("anomaly_score"))
            .orderBy(F.col("anomaly_score").desc(), keep[0]))


def compare_flagged(df: DataFrame, items: str, salary: str, tier: str, z: str, flags: dict[str, Column], threshold: float = 2.0) -> DataFrame:
    """Size, mean items, median salary, tier mix and salary-mismatch shares of all rows and of each flagged group."""
    groups = F.explode(F.array(F.lit("all"), *[F.when(f, F.lit(n)) for n, f in flags.items()]))
    long = df.withColumn("group", groups).filter(F.col("group").isNotNull())
    part = lambda c: F.avg(c.cast("int"))
    stats = long.groupBy("group").agg(
        F.count(F.lit(1)).alias("jobs"), F.avg(F.size(items)).alias("mean_items"),
        *[part(F.col(tier) == t).alias(f"share_{t.lower()}") for t in K.TIER_LABELS],
        part(F.abs(z) > threshold).alias("mismatch_share"), part(F.col(z) > threshold).alias("high_for_profile"),
        part(F.col(z) < -threshold).alias("low_for_profile"))
    return stats.join(grouped_quantiles(long, salary, [0.5], ["group"], ["median_salary"]), "group")


def score_drivers(df: DataFrame, score: str, inputs: Sequence[str]) -> DataFrame:
    """Spearman correlation of the score with each input."""
    out = None
    for name in inputs:
        row = spearman(df, score, name).select(F.lit(name).alias("input"), "spearman")
        out = row if out is None else out.unionByName(row)
    return out


def flagged_items(df: DataFrame, items: str, flag: str, min_share: float = 0.25) -> DataFrame:
    """Items common among flagged rows and their lift over all rows."""
    totals = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("f"))).scalar()
    counts = df.select(flag, F.explode(F.array_distinct(items)).alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(flag).alias("f"))
    part = share("f", totals["f"])
    return counts.select("item", part.alias("share_flagged"), F.try_divide(part, share("c", totals["n"])).alias("lift")).filter(
        F.col("share_flagged") >= min_share)


def flagged_mix(df: DataFrame, column: str, flag: str) -> DataFrame:
    """Shares of a category among all and among flagged rows."""
    totals = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("f"))).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("c"), F.count_if(flag).alias("f"))
    return counts.select(column, share("c", totals["n"]).alias("share_all"), F.coalesce(share("f", totals["f"]), F.lit(0.0)).alias("share_flagged"))


def flag_overlap(df: DataFrame, first: str, second: str) -> DataFrame:
    """Share of rows flagged first that are also flagged second."""
    return df.agg(F.count_if(F.col(first)).alias("flagged_first"), F.count_if(F.col(second)).alias("flagged_second"),
                  F.try_divide(F.count_if(F.col(first) & F.col(second)).cast("double"), F.count_if(F.col(first))).alias("overlap"))

