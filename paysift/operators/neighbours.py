"""Exact neighbour joins in bounded blocks.

Queries and references meet through a shared key (a cell of space, a group of items).
A key's rows are cut into blocks, and one task handles one pair of blocks, so a key may
hold any share of the data.  Kernels return reduced results, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import discard, materialise, md5_number, top_per_key

BLOCK = 2_000
# A side of many rows is cut into about this many blocks in all, so rows are sent as often whatever their number, until a block has LARGEST rows.
BLOCKS = 24
LARGEST = 16_000
CELL = 16_000
# In so few dimensions few cells are in reach of a row, so cells are small and a row meets few others.
FLAT, FLAT_CELL = 3, 1_000
PIVOTS = 64
VISITS = 64
ROUNDING = 1e-9


def blocked(queries: DataFrame, refs: DataFrame, key: str, query_id: str, ref_id: str,
            kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, block: int = BLOCK) -> DataFrame:
    """Apply `kernel(query block, reference block)` to every pair of blocks that share a key.

    Every row is sent once for each block of the other side, so blocks grow from `block` rows to LARGEST where a side has more
    than BLOCKS of them: what is sent grows with the rows.  The kernel meets a large query block in slices, so its matrices
    have the size of a pair of small blocks.
    """
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    counts = materialise(count(queries, "__nq").join(count(refs, "__nr"), key))
    totals = counts.agg(F.sum("__nq"), F.sum("__nr")).first()
    size = [min(max(block, LARGEST), max(block, -(-(n or 0) // BLOCKS))) for n in totals]
    sizes = counts.select(key, *[F.ceil(F.col(c) / n).cast("int").alias(c) for c, n in zip(("__nq", "__nr"), size)])
    cut = lambda df, id, n: F.pmod(F.xxhash64(id), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = queries.join(sizes, key).withColumn("__q", cut(queries, query_id, "__nq")).withColumn("__r", every("__nr")).drop("__nq", "__nr")
    r = refs.join(sizes, key).withColumn("__r", cut(refs, ref_id, "__nr")).withColumn("__q", every("__nq")).drop("__nq", "__nr")
    groups = [key, "__q", "__r"]
    # Fresh column identities: both sides may come from the same frame.
    r = r.select([F.col(c).alias(c) for c in r.columns])
    return q.groupBy(*groups).cogroup(r.groupBy(*groups)).applyInPandas(sliced(kernel, block), schema)


def sliced(kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], block: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """`kernel` for queries in slices, so that a slice and the references span no more pairs than two blocks of `block` rows."""
    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        step = max(1, block * block // max(len(r), 1))
        if len(q) <= step:
            return kernel(q, r)
        return pd.concat([kernel(q.iloc[i:i + step], r) for i in range(0, len(q), step)], ignore_index=True)
    return run


def as_matrix(vectors: pd.Series) -> np.ndarray:
    """Array column as a float matrix."""
    return np.array(vectors.tolist(), dtype=float).reshape(len(vectors), -1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, clipped at 0."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.maximum(d, 0.0)


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from differences: no cancellation, one column of the result at a time."""
    return np.stack([np.sqrt(((a - row) ** 2).sum(1)) for row in b], axis=1)


def pivot_tree(rows: DataFrame, pivots: int = PIVOTS, cell: int = CELL, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """Cells of at most `cell` rows from distinct `rows` (id, v), and the nodes above them, one table per level.

    Every cell with more rows is split among pivots of its own, as many as its size asks for and at most `pivots`, until none
    is left: the number of cells grows with the rows, their size does not.  A cell's rows meet its pivots in blocks.  Returns
    rows (id, v, cell) and nodes (parent, node, centre, n, radius, leaf); with fewer than two pivots there is one cell.
    """
    fan = min(pivots, block)
    id_type = rows.schema["id"].dataType.simpleString()

    def assign(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"id": [], "v": [], "parent": [], "cell": [], "to_centre": []})
        r = r.sort_values("place").reset_index(drop=True)
        d = exact_distances(as_matrix(q["v"]), as_matrix(r["v"]))
        names = r["cell"] + "." + r["place"].astype(str)
        return pd.DataFrame({"id": q["id"], "v": q["v"], "parent": q["cell"], "cell": names.to_numpy()[d.argmin(1)], "to_centre": d.min(1)})

    current, settled, levels = rows.withColumn("cell", F.lit("")), [], []
    while True:
        sizes = materialise(current.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
        large = sizes.filter((F.col("n") > cell) & F.lit(fan >= 2))
        settled.append(current.join(large, "cell", "left_anti").select("id", "v", "cell"))
        if large.isEmpty():
            break
        chosen = top_per_key(current.join(large, "cell"), ["cell"], [md5_number("id", F.lit("pivot")), F.col("id")], fan, "place")
        chosen = materialise(chosen.filter(F.col("place") <= F.greatest(F.lit(2), F.ceil(2 * F.col("n") / cell))))
        placed = blocked(current.join(large, "cell", "left_semi").select("id", "v", "cell"), chosen.select("id", "v", "cell", "place"),
                         "cell", "id", "id", assign, f"id {id_type}, v array<double>, parent string, cell string, to_centre double", block)
        placed = materialise(placed)
        extent = placed.groupBy("parent", F.col("cell").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.max("to_centre").alias("radius"))
        centres = chosen.select(F.concat_ws(".", "cell", "place").alias("node"), F.col("v").alias("centre"))
        levels.append(materialise(extent.join(centres, "node").withColumn("leaf", F.col("n") <= cell)))
        current = placed.select("id", "v", "cell")
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return materialise(out), levels


def cells_in_reach(queries: DataFrame, levels: Sequence[DataFrame], wanted: int, block: int = BLOCK) -> DataFrame:
    """The cells that may hold one of the `wanted` nearest rows of queries (id, v, own, bound): columns id, cell, lower.

    The tree is walked level by level.  A node is left out where its centre is farther than the bound and its radius; the bound
    falls to the distance within which the children of one node already hold enough rows.  A query's own cell is left out.
    """
    id_type = queries.schema["id"].dataType.simpleString()
    columns = ["id", "v", "own", "bound", "cell", "lower", "leaf"]

    def descend(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({c: [] for c in columns})
        r = r.sort_values("node").reset_index(drop=True)
        d = exact_distances(as_matrix(q["v"]), as_matrix(r["centre"]))
        radius, sizes = r["radius"].to_numpy(), r["n"].to_numpy()
        upper = d + radius
        order = np.argsort(upper, axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1) >= wanted
        reach = np.where(held.any(1), np.take_along_axis(upper, order, 1)[np.arange(len(q)), held.argmax(1)], np.inf)
        bound = np.minimum(q["bound"].to_numpy(), reach)
        lower = np.maximum(d - radius, 0.0)
        near, which = np.nonzero(lower <= (bound * (1 + ROUNDING))[:, None])
        found = {c: q[c].to_numpy()[near] for c in ("id", "v", "own")}
        return pd.DataFrame(found | {"bound": bound[near], "cell": r["node"].to_numpy()[which], "lower": lower[near, which],
                                     "leaf": r["leaf"].to_numpy()[which]})[columns]

    schema = f"id {id_type}, v array<double>, own string, bound double, cell string, lower double, leaf boolean"
    at, reached = queries.withColumn("cell", F.lit("")), []
    for nodes in levels:
        children = nodes.select(F.col("parent").alias("cell"), "node", "centre", "radius", "n", "leaf")
        step = materialise(blocked(at, children, "cell", "id", "cell", descend, schema, block))
        reached.append(step.filter(F.col("leaf") & (F.col("cell") != F.col("own"))).select("id", "cell", "lower"))
        at = step.filter(~F.col("leaf")).select("id", "v", "own", "bound", "cell")
    out = reached[0]
    for part in reached[1:]:
        out = out.unionByName(part)
    return out


def knn_join(df: DataFrame, id: str, vector: str, k: int, pivots: int = PIVOTS, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """The k nearest other rows of every row (Euclidean; ties by id): columns id, neighbour, distance, rank.

    Distinct vectors form a pivot tree.  A row first meets its own cell, which bounds its k-th distance; the bound prunes the
    tree level by level, and the cells left are met nearest first, `VISITS` a turn, with the bound of the turn before.  Among
    equal vectors only the k+1 smallest ids can be neighbours, so copies do not multiply the work.  Cells of points in few
    dimensions are small.  The driver sees counts only.
    """
    base = materialise(df.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
                       .withColumn("h", F.sha2(F.to_json("v"), 256)))
    id_type = base.schema["id"].dataType.simpleString()
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    widest, odd = base.agg(F.max(F.size("v")), F.count_if(~finite)).first()
    if not odd and (widest or 0) <= FLAT:  # a pivot without a place would draw all rows
        cell = min(cell, max(FLAT_CELL, 8 * (k + 1)))

    def nearest(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        r = r.sort_values("id", kind="stable").reset_index(drop=True)
        a, b = as_matrix(q["v"]), as_matrix(r["v"])
        take = min(k + 1, len(r))
        approximate = squared_distances(a, b)
        # Rows within rounding of the cut are all kept; the final ranking uses exact distances.
        cut = np.partition(approximate, take - 1, axis=1)[:, take - 1]
        slack = 1e-12 * ((a * a).sum(1) + (b * b).sum(1).max())
        rows, cols = np.nonzero(approximate <= (cut + slack)[:, None])
        distance = np.sqrt(((a[rows] - b[cols]) ** 2).sum(1))
        if "bound" in q:  # rows farther than the k+1 found before cannot be neighbours
            near = distance <= q["bound"].to_numpy()[rows] * (1 + ROUNDING)
            rows, cols, distance = rows[near], cols[near], distance[near]
        return pd.DataFrame({"id": q["id"].to_numpy()[rows], "neighbour": r["id"].to_numpy()[cols], "distance": distance})

    schema = f"id {id_type}, neighbour {id_type}, distance double"
    order = [F.col("distance"), F.col("neighbour")]
    single = materialise(top_per_key(base, ["h"], [F.col("id")], 1).select("id", "v"))
    placed, levels = pivot_tree(single, pivots, cell, block)
    best = top_per_key(blocked(placed, placed, "cell", "id", "id", nearest, schema, block), ["id"], order, k + 1)
    if levels:
        best = materialise(best)
        bounds = lambda found: found.groupBy("id").agg(F.when(F.count(F.lit(1)) > k, F.max("distance")).otherwise(float("inf")).alias("bound"))
        queries = placed.withColumnRenamed("cell", "own").join(bounds(best), "id")
        ranked = Window.partitionBy("id").orderBy("lower", "cell")
        waiting = materialise(cells_in_reach(queries, levels, k + 1, block)
                              .withColumn("turn", F.floor((F.row_number().over(ranked) - 1) / VISITS)))
        turn = 0
        while True:  # lower bounds rise with the turn, so a query without a cell in reach is done
            reach = F.col("lower") <= F.col("bound") * (1 + ROUNDING)
            live = materialise(waiting.filter(F.col("turn") == turn).join(bounds(best), "id").filter(reach).select("id", "cell", "bound"))
            if live.isEmpty():
                discard(live, waiting)
                break
            met = blocked(live.join(placed.select("id", "v"), "id"), placed, "cell", "id", "id", nearest, schema, block)
            better = materialise(top_per_key(best.unionByName(met), ["id"], order, k + 1))
            discard(best, live)
            best, turn = better, turn + 1
    smallest = base.groupBy("h").agg(F.min("id").alias("rep"))
    members = materialise(base.select("id", "h").join(smallest, "h").select("id", "rep"))
    copies = top_per_key(members, ["rep"], [F.col("id")], k + 1).select(F.col("rep").alias("neighbour"), F.col("id").alias("copy"))
    found = best.join(copies, "neighbour").select(F.col("id").alias("rep"), F.col("copy").alias("neighbour"), "distance")
    spread = members.join(top_per_key(found, ["rep"], order, k + 1), "rep").filter(F.col("id") != F.col("neighbour"))
    return (top_per_key(spread.drop("rep"), ["id"], order, k, "rank")
            .select(F.col("id").alias(id), "neighbour", "distance", F.col("rank").cast("int").alias("rank")))


def knn_overlap(left: DataFrame, right: DataFrame, id: str, k: int) -> DataFrame:
    """Mean share of neighbours that two neighbour tables have in common."""
    shared = left.select(id, "neighbour").join(right.select(id, "neighbour"), [id, "neighbour"], "left_semi").agg(F.count(F.lit(1))).scalar()
    rows = left.agg(F.countDistinct(id).alias("n"))
    return rows.select((shared / (F.col("n") * k)).alias("knn_overlap"))


def label_purity(neighbours: DataFrame, labels: DataFrame, id: str, label: str) -> DataFrame:
    """Mean share of neighbours with the row's own label."""
    own = labels.select(F.col(id), F.col(label).alias("__own"))
    other = labels.select(F.col(id).alias("neighbour"), F.col(label).alias("__other"))
    joined = neighbours.join(own, id).join(other, "neighbour")
    return joined.agg(F.avg((F.col("__own") == F.col("__other")).cast("int")).alias("purity"))


def chance_purity(labels: DataFrame, label: str) -> DataFrame:
    """Purity of random neighbours: the sum of squared label shares."""
    counts = labels.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counts.agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("chance_purity"))


def pairwise_cluster_sums(df: DataFrame, id: str, vector: str, label: str, metric: str = "euclidean", block: int = BLOCK) -> DataFrame:
    """Per row and cluster: summed distance to the cluster's rows and their number.

    Euclidean distances are quadratic work in blocks; cosine distances are summed in linear time.
    """
    if metric == "cosine":
        return cosine_cluster_sums(df, id, vector, label)
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label")).withColumn("key", F.lit(0))
    rows = materialise(rows)

    def sums(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        a, b = as_matrix(q["v"]), as_matrix(r["v"])
        d = np.sqrt(squared_distances(a, b))
        d[q["id"].to_numpy()[:, None] == r["id"].to_numpy()[None, :]] = 0.0
        out = []
        for c in r["label"].unique():
            inside = (r["label"] == c).to_numpy()
            out.append(pd.DataFrame({"id": q["id"], "label": q["label"], "other": c, "total": d[:, inside].sum(1), "n": int(inside.sum())}))
        return pd.concat(out)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("label", rows.schema["label"].dataType),
                           T.StructField("other", rows.schema["label"].dataType), T.StructField("total", T.DoubleType()),
                           T.StructField("n", T.LongType())])
    parts = blocked(rows, rows, "key", "id", "id", sums, schema, block)
    return parts.groupBy("id", "label", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def cosine_cluster_sums(df: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """Cosine distances summed as in `pairwise_cluster_sums`: a row's are the cluster's size less its product with the sum of unit vectors.

    Rows of one id are at no distance from each other, so their part is taken off again.
    """
    rows = materialise(df.select(F.col(id).alias("id"), F.col(label).alias("label"),
                                 F.transform(F.col(vector).cast("array<double>"), lambda x: F.coalesce(x, F.lit(float("nan")))).alias("v")))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    whole = F.when(F.size("v") == size, F.col("v")).otherwise(F.raise_error(F.lit("vectors differ in length")))
    summed = lambda c: F.array(*[F.sum(F.get(c, F.lit(j))) for j in range(size)])
    units = rows.withColumn("v", whole).withColumn("l", F.greatest(F.sqrt(dot("v", "v")), F.lit(1e-300))).withColumn("u", F.transform("v", lambda x: x / F.col("l")))
    own = materialise(units.groupBy("id", "label").agg(F.count(F.lit(1)).alias("m"), summed("u").alias("u")))
    clusters = materialise(own.groupBy(F.col("label").alias("other")).agg(F.sum("m").alias("size"), summed("u").alias("s")))
    every = own.crossJoin(clusters).select("id", "label", "other", (F.col("m") * F.col("size") - dot("u", "s")).alias("total"), (F.col("m") * F.col("size")).alias("n"))
    alike = own.select("id", F.col("label").alias("other"), F.col("m").alias("size"), F.col("u").alias("s"))
    alike = own.join(alike, "id").select("id", "label", "other", (dot("u", "s") - F.col("m") * F.col("size")).alias("total"), F.lit(0).cast("bigint").alias("n"))
    return every.unionByName(alike).groupBy("id", "label", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def silhouette_samples(df: DataFrame, id: str, vector: str, label: str, metric: str = "euclidean") -> DataFrame:
    """Silhouette of each row; rows labelled below 0 are left out, clusters of one score 0."""
    sums = pairwise_cluster_sums(df.filter(F.col(label) >= 0), id, vector, label, metric)
    own = F.col("label") == F.col("other")
    per_row = sums.groupBy("id", "label").agg(
        F.max(F.when(own, F.col("n"))).alias("own_n"), F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    s = F.when(F.col("own_n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per_row.select(F.col("id").alias(id), F.col("label").alias(label), F.when(F.col("b").isNotNull(), s).alias("silhouette"))


def silhouette(df: DataFrame, id: str, vector: str, label: str, metric: str = "euclidean") -> DataFrame:
    """Mean silhouette; NULL with fewer than two clusters."""
    return silhouette_samples(df, id, vector, label, metric).agg(F.avg("silhouette").alias("silhouette"))

