"""k-means, cluster descriptions, low-rank views and stability."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import CountVectorizerModel, PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import lookup, share
from ..scale import discard, grouped_quantiles, materialise, null_safe, top_per_key, with_row
from .neighbours import as_matrix, blocked

# Vectors of a block beyond the wanted ones, which speed up the iteration.
EXTRA_COMPONENTS = 24
# Up to so many clusters a row meets all of them in one pass; more meet the distinct vectors in blocks.
FEW_CLUSTERS = 1_000


def multi_hot(df: DataFrame, items: str, vocabulary: Sequence[str], output: str = "features") -> DataFrame:
    """Indicator vector of the items over a fixed vocabulary."""
    model = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=items, outputCol=output, binary=True, minTF=1.0)
    return model.transform(df)


def vector_column(df: DataFrame, array: str, output: str = "features") -> DataFrame:
    """ML vector of a numeric array."""
    return df.withColumn(output, array_to_vector(F.col(array).cast("array<double>")))


def fit_kmeans(df: DataFrame, k: int, restarts: int = 10, seed: int = 42, max_iter: int = 100, features: str = "features"):
    """The k-means fit with the lowest cost over several seeds."""
    fits = [KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df) for i in range(restarts)]
    return min(fits, key=lambda m: m.summary.trainingCost)


def kmeans_sweep(df: DataFrame, id: str, ks: Sequence[int] = range(3, 11), restarts: int = 10, seed: int = 42,
                 features: str = "features") -> tuple[DataFrame, dict]:
    """Inertia, silhouette and Davies-Bouldin of all rows for each k, and the models."""
    rows, models = [], {}
    for k in ks:
        models[k] = fit_kmeans(df, k, restarts, seed, features=features)
        scores = clustering_scores(models[k].transform(df), id, features, "cluster")
        rows.append((k, float(models[k].summary.trainingCost), scores["silhouette"], scores["davies_bouldin"]))
    table = df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, davies_bouldin double")
    return table, models


def best_k(sweep: DataFrame) -> int:
    """The k with the highest silhouette (ties: smaller)."""
    return sweep.orderBy(F.col("silhouette").desc_nulls_last(), "k").first()["k"]


def clustering_scores(labelled: DataFrame, id: str, features: str, cluster: str) -> dict:
    """Squared-Euclidean silhouette and Davies-Bouldin on all clustered rows."""
    kept = labelled.filter(F.col(cluster) >= 0)
    arrays = kept.select(id, cluster, vector_to_array(F.col(features)).alias("__v"))
    return {"silhouette": fast_silhouette(kept, features, cluster),
            "davies_bouldin": davies_bouldin(arrays, "__v", cluster).first()[0]}


def fast_silhouette(labelled: DataFrame, features: str = "features", cluster: str = "cluster", cosine: bool = False) -> float | None:
    """Squared-Euclidean or cosine silhouette of all rows, in linear time for few clusters; None with fewer than two.

    With many clusters, equal rows of a cluster collapse and meet the other clusters in blocks.
    """
    clusters = labelled.select(cluster).distinct().limit(FEW_CLUSTERS + 1).count()
    if clusters < 2:
        return None
    labelled = labelled.select(features, F.col(cluster).cast("int").alias(cluster))
    if clusters > FEW_CLUSTERS:
        stacked = labelled.groupBy(vector_to_array(F.col(features)).alias("v"), F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
        return counted_silhouette(materialise(stacked), "v", cosine)
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, distanceMeasure="cosine" if cosine else "squaredEuclidean"
                               ).evaluate(labelled)


def counted_vectors(df: DataFrame, vector: str, id: str, profiles: tuple[DataFrame, DataFrame | None]) -> DataFrame:
    """Stored distinct vectors (as arrays) and the number `n` of their rows, where rows with equal lists (`list_profiles`) have one vector."""
    some = df.join(one_id_each(profiles, id), id).select(vector, "n").unionByName(df.filter(F.col(id).isNull()).select(vector, F.lit(1).cast("bigint").alias("n")))
    return materialise(some.select(vector_to_array(F.col(vector)).alias(vector), "n").groupBy(vector).agg(F.sum("n").alias("n")))


def label_counted(model, counted: DataFrame, vector: str = "features") -> DataFrame:
    """Stored `counted` vectors with their `cluster`."""
    labelled = model.transform(counted.withColumnRenamed(vector, "__v").withColumn(vector, array_to_vector("__v")))
    return materialise(labelled.select(F.col("__v").alias(vector), "n", "cluster"))


def counted_silhouette(labelled: DataFrame, vector: str, cosine: bool = False) -> float | None:
    """`fast_silhouette` of vectors (arrays) that stand for `n` rows each, each row a neighbour of the others; None with fewer than two clusters."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    rows = labelled.select(F.col("cluster").alias("c"), "n", F.col(vector).alias("v"))
    if cosine:  # half the squared distance of unit vectors; a vector without direction has no distance
        length = F.sqrt(dot("v", "v"))
        rows = rows.withColumn("v", F.transform("v", lambda x: F.coalesce(F.try_divide(x, length), F.lit(float("nan")))))
    rows = rows.withColumn("s", dot("v", "v"))
    sums = rows.groupBy("c").agg(F.sum("n").cast("double").alias("w"), F.sum(F.col("n") * F.col("s")).alias("q"))
    stats = sums.join(centroids(rows.select("c", "v", "n"), "v", "c", "n").select("c", "centroid"), "c")
    stats = materialise(stats)
    clusters = stats.count()
    if clusters < 2:
        return None
    mean = lambda o: F.col("s") + o["q"] / o["w"] - 2 * dot(F.col("v"), o["centroid"])
    inner = lambda o: (mean(o) * F.try_divide(o["w"], o["w"] - 1)).alias("a")
    if clusters > FEW_CLUSTERS:
        rows = materialise(rows.withColumn("at", F.monotonically_increasing_id()))
        own = stats.select("c", F.struct("w", "q", "centroid").alias("own"))
        apart = rows.join(own, "c").join(nearest_other(rows, stats), "at").select("n", F.col("own")["w"].alias("w"), inner(F.col("own")), "b")
    else:
        every = stats.agg(F.collect_list(F.struct("c", "w", "q", "centroid")).alias("every"))  # one entry per cluster
        own = F.get(F.filter("every", lambda o: o["c"] == F.col("c")), F.lit(0))
        apart = with_row(rows, every).select("n", own["w"].alias("w"), inner(own), F.array_min(F.transform(F.filter("every", lambda o: o["c"] != F.col("c")), mean)).alias("b"))
    ratio = lambda x, y: F.coalesce(F.try_divide(F.col(x), F.col(y)), F.lit(0.0))
    score = F.when(F.col("w") <= 1, 0.0).when(F.col("a") < F.col("b"), 1 - ratio("a", "b")).when(F.col("a") > F.col("b"), ratio("b", "a") - 1).otherwise(
        F.when(F.isnan("a"), F.col("a")).otherwise(0.0))
    return apart.agg(F.sum(F.col("n") * score) / F.sum("n")).first()[0]


def nearest_other(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """(at, b): the least mean squared distance of each of `rows` (at, c, v, s) to a cluster that is not its own, in blocks of both."""
    def nearest(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"at": [], "b": []})
        means = q["s"].to_numpy()[:, None] + (r["q"] / r["w"]).to_numpy()[None, :] - 2 * as_matrix(q["v"]) @ as_matrix(r["centroid"]).T
        means[q["c"].to_numpy()[:, None] == r["c"].to_numpy()[None, :]] = np.inf
        return pd.DataFrame({"at": q["at"], "b": means.min(1)})

    one = F.lit(0).alias("key")
    met = blocked(rows.select(one, "at", "c", "v", "s"), stats.select(one, "c", "w", "q", "centroid"), "key", "at", "c", nearest, "at bigint, b double")
    return met.groupBy("at").agg(F.min("b").alias("b"))


def centroids(df: DataFrame, vector: str, cluster: str, weight: str | None = None) -> DataFrame:
    """Mean vector and size of each cluster (array column); a row counts `weight` times."""
    mean, size = (F.avg("x"), F.count(F.lit(1))) if weight is None else (F.sum(F.col("x") * F.col(weight)) / F.sum(weight), F.sum(weight))
    long = df.select(cluster, *[c for c in [weight] if c], F.posexplode(vector).alias("i", "x")).groupBy(cluster, "i").agg(mean.alias("m"), size.alias("n"))
    return long.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("centroid"),
                                     F.max("n").alias("n"))


def _distance(a, b):
    squares = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: (p["a"] - p["b"]) * (p["a"] - p["b"]))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def davies_bouldin(df: DataFrame, vector: str, cluster: str, weight: str | None = None) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / centroid distance; rows below 0 are left out; a row counts `weight` times."""
    times = [F.col(weight).alias("w")] if weight else []
    kept = df.filter(F.col(cluster) >= 0).select(F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("v"), *times)
    centres = materialise(centroids(kept, "v", "c", "w" if weight else None))
    far = _distance(F.col("v"), F.col("centroid"))
    spread = kept.join(centres.select("c", "centroid"), "c").groupBy("c").agg((F.sum(far * F.col("w")) / F.sum("w") if weight else F.avg(far)).alias("s"))
    stats = centres.join(spread, "c").select("c", "centroid", "s")
    every = stats.agg(F.collect_list(F.struct("c", "centroid", "s")).alias("every"))  # one entry per cluster
    rival = lambda o: F.try_divide(F.col("s") + o["s"], _distance(F.col("centroid"), o["centroid"]))
    ratios = F.transform(F.filter("every", lambda o: o["c"] != F.col("c")), rival)
    worst = with_row(stats, every).select(F.array_max(ratios).alias("r"))
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def defining_items(df: DataFrame, items: str, cluster: str, top: int = 5, min_share: float = 0.15) -> DataFrame:
    """Top over-represented items per cluster by lift; a cluster without any gets its most frequent items."""
    sized = df.filter(F.col(cluster) >= 0).groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    total = df.agg(F.count(F.lit(1))).scalar()
    exploded = df.select(cluster, F.explode(F.array_distinct(items)).alias("item"))
    counts = exploded.groupBy(cluster, "item").agg(F.count(F.lit(1)).alias("c"))
    overall = counts.groupBy("item").agg(F.sum("c").alias("overall"))
    scored = counts.filter(F.col(cluster) >= 0).join(sized, cluster).join(overall, "item").select(
        cluster, "item", share("c", "size").alias("share_in_cluster"), share("overall", total).alias("share_overall"))
    scored = scored.withColumn("lift", F.try_divide("share_in_cluster", "share_overall"))
    scored = scored.withColumn("eligible", (F.col("share_in_cluster") >= min_share) & (F.col("lift") > 1))
    any_eligible = scored.groupBy(cluster).agg(F.max("eligible").alias("over_represented"))
    marked = scored.join(any_eligible, cluster).filter(F.col("eligible") | ~F.col("over_represented"))
    order = F.when(F.col("over_represented"), F.col("lift")).otherwise(F.col("share_in_cluster"))
    return top_per_key(marked.drop("eligible"), [cluster], [order.desc(), F.col("share_in_cluster").desc(), F.col("item")], top, "rank")


def theme_map(themes: Mapping[str, Sequence[str]] = K.THEMES, technical: Sequence[str] = tuple(K.TECHNICAL_SKILLS)) -> list[tuple[str, str, int]]:
    """(item, theme, theme position) of every theme word; technical items belong to the data theme."""
    rows = []
    for i, (theme, words) in enumerate(themes.items()):
        rows += [(w, theme, i) for w in dict.fromkeys([*words, *(technical if theme == K.TECHNICAL_THEME else [])])]
    return rows


def name_clusters(defining: DataFrame, cluster: str, themes: Sequence[tuple[str, str, int]] | None = None) -> DataFrame:
    """Theme with the largest sum of lift times share; repeated names get the cluster's first item."""
    spark = defining.sparkSession
    words = spark.createDataFrame(themes if themes is not None else theme_map(), "item string, theme string, position int")
    first = defining.filter(F.col("rank") == 1).select(cluster, F.col("item").alias("first_item"), "over_represented")
    scores = defining.join(words, "item").groupBy(cluster, "theme", "position").agg(F.sum(F.col("lift") * F.col("share_in_cluster")).alias("s"))
    best = scores.groupBy(cluster).agg(F.max_by("theme", F.struct(F.col("s"), -F.col("position"))).alias("theme"))
    named = first.join(best, cluster, "left").withColumn("name", F.when(~F.col("over_represented"), K.GENERALIST_NAME)
                                                         .otherwise(F.coalesce("theme", F.lit(K.PLAIN_NAME))))
    repeats = named.groupBy("name").agg(F.count(F.lit(1)).alias("uses"))
    unique = F.when(F.col("uses") > 1, F.concat("name", F.lit(" ("), "first_item", F.lit(")"))).otherwise(F.col("name"))
    return named.join(repeats, "name").select(cluster, unique.alias("cluster_name"))


def cluster_profiles(df: DataFrame, cluster: str, items: str, salary: str, tier: str) -> DataFrame:
    """Size, share, mean and median salary, tier mix and mean list length per cluster."""
    total = df.agg(F.count(F.lit(1))).scalar()
    known = F.count(tier)
    stats = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), F.avg(salary).alias("avg_salary"), F.avg(F.size(items)).alias("mean_items"),
        *[F.coalesce(F.try_divide(F.count_if(F.col(tier) == t).cast("double"), known), F.lit(0.0)).alias(f"share_{t.lower()}") for t in K.TIER_LABELS])
    medians = grouped_quantiles(df, salary, [0.5], [cluster], ["median_salary"])
    return null_safe(stats, medians, [cluster]).withColumn("share", share("size", total))


def top_titles(df: DataFrame, cluster: str, title: str, n: int = 5) -> DataFrame:
    """Most frequent titles per cluster."""
    counts = df.groupBy(cluster, title).agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counts, [cluster], [F.col("n").desc(), F.col(title)], n, "rank")


def cluster_heatmap(df: DataFrame, items: str, cluster: str, min_share: float = 0.15, top: int = 5) -> DataFrame:
    """Share in every cluster of the items that distinguish some cluster."""
    inside = df.filter(F.col(cluster) >= 0)
    chosen = defining_items(inside, items, cluster, top, min_share).filter("over_represented").select("item").distinct()
    sizes = inside.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    counts = inside.select(cluster, F.explode(F.array_distinct(items)).alias("item")).join(chosen, "item", "left_semi").groupBy(cluster, "item").agg(
        F.count(F.lit(1)).alias("c"))
    return counts.join(sizes, cluster).select(cluster, "item", share("c", "size").alias("share"))


def cluster_order(df: DataFrame, cluster: str, salary: str) -> DataFrame:
    """Clusters by falling median salary."""
    return grouped_quantiles(df.filter(F.col(cluster) >= 0), salary, [0.5], [cluster], ["median_salary"]).orderBy(
        F.col("median_salary").desc(), cluster)


def set_aside_empty(df: DataFrame, labels: DataFrame, id: str, cluster: str = "cluster") -> DataFrame:
    """Labels for every row: rows that were not clustered get -1."""
    return df.join(labels.select(id, cluster), id, "left").withColumn(cluster, F.coalesce(F.col(cluster), F.lit(K.NO_ITEMS_LABEL)))


# Low-rank views -----------------------------------------------------------------------------


def tfidf_weights(df: DataFrame, items: str) -> DataFrame:
    """Smooth idf of every item: `ln((1+n)/(1+df)) + 1`."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.select(F.explode(F.array_distinct(items)).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    return counts.withColumn("idf", F.log((1 + total) / (1 + F.col("df")).cast("double")) + 1)


def tfidf_rows(df: DataFrame, id: str, items: str) -> DataFrame:
    """L2-normalised tf-idf of every non-empty list, in long form: id, item, x."""
    weights = tfidf_weights(df, items).select("item", "idf")
    long = df.select(id, F.explode(F.array_distinct(items)).alias("item")).join(weights, "item")
    norms = long.groupBy(id).agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    return long.join(norms, id).select(id, "item", (F.col("idf") / F.col("norm")).alias("x"))


def column_gram(rows: DataFrame, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The small matrix of sums over rows of left_i * right_j; tasks add up their part, one row per cell and task is summed."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(left), len(right)))
        for batch in batches:
            total += batch[list(left)].to_numpy(float).T @ batch[list(right)].to_numpy(float)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})

    sums = rows.select(*dict.fromkeys([*left, *right])).mapInPandas(part, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((len(left), len(right)))
    for r in sums.collect():
        out[r["i"], r["j"]] = r["x"]
    return out


def combined(rows: DataFrame, key: str, columns: Sequence[str], weights: np.ndarray, prefix: str) -> DataFrame:
    """`key` and the columns times a small matrix."""
    names = [f"{prefix}{j}" for j in range(weights.shape[1])]

    def times(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame(batch[list(columns)].to_numpy(float) @ weights, columns=names)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    schema = ", ".join([f"`{key}` {rows.schema[key].dataType.simpleString()}", *(f"{n} double" for n in names)])
    return rows.select(key, *columns).mapInPandas(times, schema)


def alike_rows(long: DataFrame) -> DataFrame:
    """(row, n, item, x): rows of a sparse matrix, equal ones once with their number `n`; stored."""
    lists = long.filter("row IS NOT NULL AND item IS NOT NULL").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("item", "x"))).alias("cells"))
    alike = materialise(lists.groupBy("cells").agg(F.count(F.lit(1)).alias("n")).withColumn("row", F.monotonically_increasing_id()))
    return alike.select("row", "n", F.inline("cells"))


def list_profiles(df: DataFrame, id: str, items: str) -> tuple[DataFrame, DataFrame | None]:
    """(lists, repeated): distinct item lists of ids that occur once, with their number `n` and one of the ids; and the ids that repeat, or None.

    Rows without an id are in neither.
    """
    ids = materialise(df.filter(F.col(id).isNotNull()).groupBy(id).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(id))
    repeated = None if ids.isEmpty() else ids
    once = df.filter(F.col(id).isNotNull()) if repeated is None else df.filter(F.col(id).isNotNull()).join(repeated, id, "left_anti")
    lists = once.groupBy(F.array_sort(F.array_distinct(items)).alias("list")).agg(F.count(F.lit(1)).alias("n"), F.min(id).alias("some_id"))
    return materialise(lists.withColumn("row", F.monotonically_increasing_id())), repeated


def one_id_each(profiles: tuple[DataFrame, DataFrame | None], id: str) -> DataFrame:
    """One id of each distinct list with the number `n` of ids it stands for, and the ids that repeat, which stand for themselves."""
    lists, repeated = profiles
    chosen = lists.select(F.col("some_id").alias(id), "n")
    return chosen if repeated is None else chosen.unionByName(repeated.withColumn("n", F.lit(1).cast("bigint")))


def singular_basis(long: DataFrame, id: str, components: int, extra: int = EXTRA_COMPONENTS, tolerance: float = 1e-10, most: int = 100,
                   alike: DataFrame | None = None) -> tuple[DataFrame, float]:
    """(basis, explained): leading right singular vectors (item, b) of a sparse matrix (id, item, x), stored, and their share of squares.

    Block subspace iteration with Rayleigh-Ritz: a block of `components` + `extra` vectors over the items goes through the
    rows and back, two joins and sums an iteration, until the leading values settle.  The driver sees only products of the
    block with itself.  `alike` may give equal rows once (`alike_rows`).  Where there are no more items than the block is wide, the first round is exact.
    """
    long = long.select(F.col(id).alias("row"), "item", "x")
    width = components + extra
    block = [f"v{j}" for j in range(width)]
    start = [(F.xxhash64("item", F.lit(j)) / float(1 << 63)).alias(n) for j, n in enumerate(block)]
    vectors, settled = materialise(long.select("item").distinct().select("item", *start)), None
    total = long.agg(F.sum(F.col("x") * F.col("x"))).first()[0] or 0.0
    through = lambda frame, to, x, names: frame.groupBy(to).agg(*[F.sum(x * F.col(n)).alias(n) for n in names])
    alike = long.withColumn("n", F.lit(1)) if alike is None else alike
    for step in range(most):
        values, axes = np.linalg.eigh(column_gram(vectors, block, block))
        kept = values > max(values.max(initial=0.0), 1e-300) * 1e-13
        names = [f"q{j}" for j in range(int(kept.sum()))]
        orthonormal = materialise(combined(vectors, "item", block, axes[:, kept] / np.sqrt(values[kept]), "q"))
        rows = through(alike.join(orthonormal, "item"), "row", F.col("x"), names)
        image = materialise(through(alike.join(rows, "row"), "item", F.col("n") * F.col("x"), names))
        # Ritz values of the block, and the block turned to its Ritz vectors.
        pairs = orthonormal.join(image.select("item", *[F.col(n).alias(f"z{n}") for n in names]), "item")
        ritz, turn = np.linalg.eigh(column_gram(pairs, names, [f"z{n}" for n in names]))
        order = np.argsort(ritz)[::-1]
        ritz, turn = ritz[order], turn[:, order]
        leading = ritz[:components]
        done = step + 1 == most or len(names) < width or (settled is not None and np.abs(leading - settled).max(initial=0.0) <= tolerance * max(leading.max(initial=0.0), 1e-300))
        if done:
            break
        settled = leading
        before, vectors = vectors, materialise(combined(image, "item", names, turn, "v"))
        discard(before, orthonormal, image)
    chosen = turn[:, :components]
    final = materialise(combined(orthonormal, "item", names, chosen, "b"))
    columns = [f"b{j}" for j in range(chosen.shape[1])]
    # Fixed signs: the entry of the largest size is positive.
    signs = [1.0 if (x or 0.0) >= 0 else -1.0 for x in final.agg(*[F.max_by(c, F.struct(F.round(F.abs(c), 9), "item")) for c in columns]).first()]
    basis = materialise(final.select("item", F.array(*[F.col(c) * sign for c, sign in zip(columns, signs)]).alias("b")))
    return basis, float(leading.sum() / max(total, 1e-300))


def project(long: DataFrame, id: str, basis: DataFrame, output: str = "coordinates", unit: bool = False) -> DataFrame:
    """Coordinates of every row in a basis (item, b), optionally scaled to length one."""
    size = basis.agg(F.max(F.size("b"))).first()[0] or 0
    rows = long.join(basis, "item").groupBy(id).agg(F.array(*[F.sum(F.col("x") * F.get("b", F.lit(j))) for j in range(size)]).alias(output))
    if not unit:
        return rows
    norm = F.sqrt(F.aggregate(output, F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("__n", norm).withColumn(output, F.transform(output, lambda x: F.coalesce(F.try_divide(x, F.col("__n")), F.lit(0.0)))).drop("__n")


def svd_rows(df: DataFrame, id: str, items: str, components: int = 10, tfidf: bool = True, unit: bool = True,
             profiles: tuple[DataFrame, DataFrame | None] | None = None) -> DataFrame:
    """TF-IDF (or indicator) rows projected on the leading singular vectors.

    Indicator rows of equal lists go into the basis once, with their number; `profiles` may give them (`list_profiles`).
    TF-IDF rows go in one by one: k-means breaks ties between such rows by the last bits of these sums.
    """
    if tfidf:
        long, alike = materialise(tfidf_rows(df, id, items)), None
    else:
        sparse = lambda frame, list, *keys: frame.select(*keys, F.explode(F.array_distinct(list)).alias("item"), F.lit(1.0).alias("x"))
        long = materialise(sparse(df, items, id))
        lists, repeated = profiles or list_profiles(df, id, items)
        alike = sparse(lists, "list", "row", "n")
        if repeated is not None:
            more = alike_rows(long.join(repeated, id, "left_semi").select(F.col(id).alias("row"), "item", "x"))
            alike = alike.unionByName(more.withColumn("row", -1 - F.col("row")))
        alike = materialise(alike)
    basis, _ = singular_basis(long, id, components, alike=alike)
    return project(long, id, basis, unit=unit)


def compare_representations(df: DataFrame, id: str, items: str, vocabulary: Sequence[str], k: int, restarts: int = 3, seed: int = 42) -> DataFrame:
    """k-means on indicators and on TF-IDF, SVD and unit length, scored alike.

    All rows fit a model; equal vectors get their label and score once.
    """
    rows = []
    hot = materialise(multi_hot(df, items, vocabulary))
    profiles = list_profiles(df, id, items)
    dense = materialise(vector_column(svd_rows(df, id, items), "coordinates"))
    for name, frame in (("multi-hot", hot), ("tf-idf, svd, unit length", dense)):
        labelled = label_counted(fit_kmeans(frame, k, restarts, seed), counted_vectors(frame, "features", id, profiles))
        rows.append((name, k, counted_silhouette(labelled, "features"), davies_bouldin(labelled, "features", "cluster", "n").first()[0]))
    return df.sparkSession.createDataFrame(rows, "representation string, k int, silhouette double, davies_bouldin double")


def pca_coordinates(df: DataFrame, features: str = "features", k: int = 2, output: str = "coordinates") -> tuple[DataFrame, float]:
    """Centred principal coordinates (array column) and the share of variance they explain."""
    model = PCA(k=k, inputCol=features, outputCol="__pc").fit(df)
    raw = model.transform(df).withColumn("__a", vector_to_array("__pc"))
    means = raw.agg(F.array(*[F.avg(F.get("__a", F.lit(i))) for i in range(k)]).alias("__means"))
    centred = with_row(raw, means).withColumn(output, F.transform("__a", lambda x, i: x - F.get("__means", i))).drop("__pc", "__a", "__means")
    return centred, float(sum(model.explainedVariance))


def adjusted_rand_index(df: DataFrame, left: str, right: str, weight: str | None = None) -> DataFrame:
    """Adjusted Rand index of two labellings, from their contingency table; a row counts `weight` times."""
    pairs = lambda n: n * (n - 1) / 2
    n = F.col("n").cast("double")
    table = df.groupBy(left, right).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    both = table.agg(F.sum(pairs(n))).scalar()
    side = lambda c: table.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(pairs(n))).scalar()
    out = table.agg(F.sum("n").cast("double").alias("t")).select(
        both.alias("both"), side(left).alias("a"), side(right).alias("b"), pairs(F.col("t")).alias("all"))
    expected = F.try_divide(F.col("a") * F.col("b"), F.col("all"))
    span = (F.col("a") + F.col("b")) / 2 - expected
    return out.select(F.coalesce(F.try_divide(F.col("both") - expected, span), F.lit(1.0)).alias("adjusted_rand_index"))


def robustness_grid(df: DataFrame, id: str, items: str, vocabulary: Sequence[str], ks: Sequence[int] = (3, 5, 7), seeds: Sequence[int] = (42, 43, 44),
                    components: int = 32, max_iter: int = 100) -> tuple[DataFrame, DataFrame]:
    """(runs, summary): both representations, each k and seed, on all non-empty rows.

    All rows fit a model.  Labels and scores depend on vectors alone, so rows are joined by id once, and equal vectors are
    labelled and scored once with the number of their rows.
    """
    spark = df.sparkSession
    drawn = materialise(df.filter(F.size(items) > 0).select(id, items))
    binary = materialise(multi_hot(drawn, items, vocabulary))
    width = max(1, min(components, len(vocabulary) - 1))
    profiles = list_profiles(drawn, id, items)
    dense = materialise(vector_column(svd_rows(drawn, id, items, width, tfidf=False, profiles=profiles), "coordinates"))
    # An id's indicator vectors (one, where ids are unique) and its dense vector, with the number of such ids.
    chosen = one_id_each(profiles, id)
    originals = binary.join(chosen, id).groupBy(id).agg(F.array_sort(F.collect_list(vector_to_array("features"))).alias("originals"), F.first("n").alias("n"))
    turned = dense.join(chosen.select(id), id).select(id, vector_to_array("features").alias("v"))
    counted = materialise(originals.join(turned, id, "left").select("originals", "v", "n"))
    plain = counted.select("n", "originals", F.explode("originals").alias("features")).select("n", "features", F.explode("originals").alias("original"))
    turned = counted.filter(F.col("v").isNotNull()).select("n", F.col("v").alias("features"), "originals")
    runs, agreement = [], []
    for name, frame, met, twins in (("binary", binary, plain, plain.withColumnRenamed("original", "other")),
                                    ("svd_l2", dense, turned.select("n", "features", F.explode("originals").alias("original")), turned.select("n", "features", F.col("features").alias("other")))):
        vectors = counted_vectors(frame, "features", id, profiles)
        for k in ks:
            labels = {}
            for seed in seeds:
                model = KMeans(k=k, seed=seed, maxIter=max_iter, predictionCol="cluster").fit(frame)
                labels[seed] = label_counted(model, vectors)
                sizes = [r["n"] for r in labels[seed].groupBy("cluster").agg(F.sum("n").alias("n")).collect()]
                part = materialise(met.join(labels[seed].drop("n"), "features"))
                scores = [counted_silhouette(part, v, cosine) for v, cosine in (("original", True), ("features", True), ("features", False))]
                runs.append((name, k, seed, *scores, min(sizes) / sum(sizes), max(sizes) / sum(sizes), model.summary.numIter))
            for s, t in combinations(seeds, 2):
                joined = (twins.join(labels[s].select("features", F.col("cluster").alias("x")), "features")
                          .join(labels[t].select(F.col("features").alias("other"), F.col("cluster").alias("y")), "other"))
                agreement.append((name, k, adjusted_rand_index(joined, "x", "y", "n").first()[0]))
    table = spark.createDataFrame(runs, "representation string, k int, seed int, cosine_original double, cosine double, euclidean double, "
                                        "min_share double, max_share double, iterations int")
    pairs = spark.createDataFrame(agreement, "representation string, k int, ari double") if agreement else None
    summary = table.groupBy("representation", "k").agg(F.avg("cosine_original").alias("mean_cosine_original"), F.avg("cosine").alias("mean_cosine"),
                                                       F.avg("euclidean").alias("mean_euclidean"), F.min("min_share").alias("min_share"),
                                                       F.max("max_share").alias("max_share"))
    if pairs is not None:
        summary = summary.join(pairs.groupBy("representation", "k").agg(F.avg("ari").alias("mean_ari"), F.min("ari").alias("min_ari")), ["representation", "k"])
    return table, summary


def experience_codes(column: str):
    """Ordinal experience code, -1 when unknown."""
    return lookup(column, K.EXPERIENCE_TO_CODE, -1)

