"""Density clustering (DBSCAN) of item sets and of points, exact and in bounded blocks.

Item sets: equal sets collapse into one weighted row, items are ranked by rarity.  Two sets that overlap have a rarest
common item; the items before it, i in one and j in the other, all differ, so at a radius of h differing items i + j <= h
and the rests after it differ in at most r = h - i - j.  Small radii meet through keys of item, i, j and a part of the rest
(`set_links`), larger ones in blocks of the lists of an inverted index on the h+1 rarest items.  Pairs without overlap are
counted from set sizes alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scale import discard, grouped_quantiles, materialise, null_safe, ordinal, with_row
from .neighbours import as_matrix, blocked
from .splits import star_components

# Up to this radius (in differing items) sets meet through keys and links are listed; beyond it neighbourhoods are dense.
LISTED_RADIUS = 3
MASK_BITS = 64


def distinct_sets(df: DataFrame, id: str, items: str) -> tuple[DataFrame, DataFrame]:
    """(sets, members): each distinct non-empty set with its smallest row id, its items as
    rarity ranks (0 = rarest), size, number of rows and a 64-bit mask of its ranks; and the set of every row."""
    rows = materialise(df.select(F.col(id).alias("row"), F.array_sort(F.array_distinct(items)).alias("s")).filter(F.size("s") > 0)
                       .withColumn("h", F.sha2(F.to_json("s"), 256)))
    grouped = materialise(rows.groupBy("h").agg(F.min("row").alias("sid"), F.count(F.lit(1)).alias("w"), F.first("s").alias("s")))
    exploded = grouped.select("sid", "w", F.explode("s").alias("item"))
    # Stored, so that Spark knows it for the small side and leaves the exploded sets where they lie.
    ranks = materialise(ordinal(exploded.groupBy("item").agg(F.sum("w").alias("n")), ["n", "item"], "rank").select("item", F.col("rank").cast("int").alias("rank")))
    bit = F.expr(f"shiftleft(1L, pmod(rank, {MASK_BITS}))")
    ranked = exploded.join(ranks, "item").groupBy("sid").agg(F.array_sort(F.collect_list("rank")).alias("r"), F.first("w").alias("w"), F.bit_or(bit).alias("mask"))
    sets = materialise(ranked.withColumn("size", F.size("r")))
    return sets, rows.select("row", "h").join(grouped.select("h", "sid"), "h").select("row", "sid")


def spread_bits(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    values = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _keys_of(ranks: list[np.ndarray], h: int, left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, key, shortened): the keys through which sets within h meet, for the left or the right side of a pair.

    The rest after the common item is dealt into r // 2 + 1 parts; one of them differs in at most one item, so either both
    parts are equal or one is the other without an item.  A key names item, i, j, part and the part's content; `shortened`
    tells that an item was left out, and two shortened keys need not meet.
    """
    sizes = np.array([len(x) for x in ranks])
    flat, row = np.concatenate(ranks).astype(np.int64), np.repeat(np.arange(len(ranks)), sizes)
    position = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    code, first = spread_bits(flat + 1), np.cumsum(sizes) - sizes
    out = []
    for own in range(h + 1):
        held = np.nonzero(sizes > own)[0]
        if not len(held):
            break
        item = np.zeros(len(ranks), np.int64)
        item[held] = flat[first[held] + own]
        rest = (position > own) & (sizes[row] > own)
        for other in range(h - own + 1):
            r = h - own - other
            i, j = (own, other) if left else (other, own)
            parts = r // 2 + 1
            part = (spread_bits(flat + 7) >> np.uint64(40)).astype(np.int64) % parts
            for q in range(parts):
                inside = np.nonzero(rest & (part == q))[0]
                total = np.zeros(len(ranks), np.uint64)
                np.add.at(total, row[inside], code[inside])
                name = spread_bits(item * 4096 + i * 256 + j * 16 + q)
                out.append((held, spread_bits(total[held] + name[held]), np.zeros(len(held), bool)))
                if r:
                    out.append((row[inside], spread_bits(total[row[inside]] - code[inside] + name[row[inside]]), np.ones(len(inside), bool)))
    return tuple(np.concatenate(c) for c in zip(*out))


def set_links(queries: DataFrame, sets: DataFrame, h: int) -> DataFrame:
    """(sid, other, ref_size, weight, distance): overlapping sets at most h items apart, each pair once, every set with itself.

    Keys are hashes, so a pair that meets is verified: by the masks, which tell the distance where no two ranks share a bit,
    else by the items themselves.
    """
    def keyed(left: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    at, key, shortened = _keys_of([np.asarray(r) for r in batch["r"]], h, left)
                    yield pd.DataFrame({"key": key.view(np.int64), "shortened": shortened, **{c: batch[c].to_numpy()[at] for c in ("sid", "mask", "size", "w")}})
        return run

    sid = sets.schema["sid"].dataType.simpleString()
    schema = f"key bigint, shortened boolean, sid {sid}, mask bigint, size int, w bigint"
    columns = ["sid", "r", "mask", "size", "w"]
    a = queries.select(*columns).mapInPandas(keyed(True), schema).alias("a")
    b = sets.select(*columns).mapInPandas(keyed(False), schema).alias("b")
    apart = F.bit_count(F.col("a.mask").bitwiseXOR(F.col("b.mask")))
    overlap = F.col("a.mask").bitwiseAND(F.col("b.mask")) != 0
    # Spark judges a side by the size of the sets, not of their keys, so it is told not to broadcast them.
    met = a.hint("merge").join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & ~(F.col("a.shortened") & F.col("b.shortened")) & overlap & (apart <= h) & (F.abs(F.col("a.size") - F.col("b.size")) <= h))
    pairs = met.select(F.col("a.sid").alias("sid"), F.col("b.sid").alias("other"), F.col("b.size").alias("ref_size"), F.col("b.w").alias("weight"), apart.alias("distance")).distinct()
    if (sets.agg(F.max(F.element_at("r", -1))).first()[0] or 0) < MASK_BITS:
        return pairs
    items = lambda side, name: side.select(F.col("sid").alias(name), F.col("r").alias(f"r_{name}"))
    common = F.size(F.array_intersect("r_sid", "r_other"))
    told = pairs.drop("distance").join(items(queries, "sid"), "sid").join(items(sets, "other"), "other").withColumn("distance", F.size("r_sid") + F.size("r_other") - 2 * common)
    return told.filter((F.col("distance") <= h) & (common > 0)).select("sid", "other", "ref_size", "weight", "distance")


def _posted(sets: DataFrame, h: int) -> DataFrame:
    """The inverted index: one row per set and each of its h+1 rarest items."""
    return sets.select("*", F.explode(F.slice("r", 1, h + 1)).alias("item"))


def _overlaps(q: pd.DataFrame, r: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(distance, ours): symmetric-difference sizes, and whether the list's item is the rarest common one."""
    item = int(q["item"].iloc[0])
    flat = [np.concatenate(list(side["r"])).astype(np.int64) for side in (q, r)]
    used = np.unique(np.concatenate(flat))

    def hot(side: pd.DataFrame, items: np.ndarray) -> np.ndarray:
        m = np.zeros((len(side), len(used)), dtype=np.float32)
        m[np.repeat(np.arange(len(side)), side["size"].to_numpy()), np.searchsorted(used, items)] = 1.0
        return m

    a, b = hot(q, flat[0]), hot(r, flat[1])
    low = np.searchsorted(used, item)
    common = a @ b.T
    earlier = a[:, :low] @ b[:, :low].T if low else np.zeros_like(common)
    distance = q["size"].to_numpy()[:, None] + r["size"].to_numpy()[None, :] - 2 * common
    return distance.round().astype(int), earlier < 0.5


def set_distance_counts(queries: DataFrame, sets: DataFrame, h: int) -> DataFrame:
    """Rows at each distance 0..h (in differing items) of every query set: sid, distance, weight (itself included)."""
    def kernel(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"sid": [], "ref_size": [], "distance": [], "weight": []})
        if q.empty or r.empty:
            return empty
        distance, ours = _overlaps(q, r)
        rows, cols = np.nonzero(ours & (distance <= h))
        pairs = pd.DataFrame({"sid": q["sid"].to_numpy()[rows], "ref_size": r["size"].to_numpy()[cols],
                              "distance": distance[rows, cols], "weight": r["w"].to_numpy()[cols]})
        return pairs.groupby(["sid", "ref_size", "distance"], as_index=False)["weight"].sum()

    if h <= LISTED_RADIUS:
        overlap = set_links(queries, sets, h)
    else:
        sid = sets.schema["sid"].dataType.simpleString()
        overlap = blocked(_posted(queries, h), _posted(sets, h), "item", "sid", "sid", kernel, f"sid {sid}, ref_size int, distance int, weight bigint")
    return _with_apart(overlap, queries, sets, h)


def _with_apart(overlap: DataFrame, queries: DataFrame, sets: DataFrame, h: int) -> DataFrame:
    """Weight per query set and distance: overlapping sets as listed, and sets of small size without overlap."""
    overlap = materialise(overlap.groupBy("sid", "ref_size", "distance").agg(F.sum("weight").alias("weight")))
    met = overlap.groupBy("sid", "ref_size").agg(F.sum("weight").alias("met"))
    by_size = sets.filter(F.col("size") < h).groupBy(F.col("size").alias("ref_size")).agg(F.sum("w").alias("all"))
    apart = (queries.filter(F.col("size") < h).select("sid", "size", F.explode(F.sequence(F.lit(1), F.lit(h) - F.col("size"))).alias("ref_size"))
             .join(by_size, "ref_size").join(met, ["sid", "ref_size"], "left")
             .select("sid", (F.col("size") + F.col("ref_size")).alias("distance"), (F.col("all") - F.coalesce("met", F.lit(0))).alias("weight"))
             .filter(F.col("weight") > 0))
    return overlap.select("sid", "distance", "weight").unionByName(apart).groupBy("sid", "distance").agg(F.sum("weight").alias("weight"))


def set_k_distances(df: DataFrame, id: str, items: str, k: int = 20, start: int = 2) -> DataFrame:
    """Squared distance of every row to its k-th nearest row (itself included); NULL when there are fewer rows.

    The search radius doubles, and only unfinished sets go on.
    """
    sets, members = distinct_sets(df, id, items)
    pending, done, h = sets, None, start
    longest = 2 * (sets.agg(F.max("size")).first()[0] or 0)
    while True:
        counts = set_distance_counts(pending, sets, h)
        running = F.sum("weight").over(Window.partitionBy("sid").orderBy("distance"))  # at most h+1 rows per set
        reached = materialise(counts.withColumn("c", running).filter(F.col("c") >= k).groupBy("sid").agg(F.min("distance").alias("k_distance_sq")))
        done = reached if done is None else done.unionByName(reached)
        pending = materialise(pending.join(reached, "sid", "left_anti"))
        if h >= longest or pending.isEmpty():
            break
        h = min(2 * h, longest)
    return members.join(done, "sid", "left").select(F.col("row").alias(id), "k_distance_sq")


def eps_candidates(k_distances: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Distinct k-distances between two percentiles, as radii with a small tolerance."""
    d = F.sqrt("k_distance_sq")
    ends = grouped_quantiles(k_distances, d, [low, high], names=["lo", "hi"]).select(F.struct("lo", "hi")).scalar()
    steps = k_distances.filter(F.col("k_distance_sq").isNotNull()).select("k_distance_sq").distinct()
    return (steps.filter((d >= ends["lo"] - 1e-6) & (d <= ends["hi"] + 1e-6))
            .select("k_distance_sq", (d + 1e-6).alias("eps")).orderBy("k_distance_sq"))


def _local_links(near: np.ndarray, q_ids: np.ndarray, r_ids: np.ndarray, q_core: np.ndarray) -> pd.DataFrame:
    """Links of one block: core rows of a local component all point at its smallest id, and a
    border row points at each local component it touches."""
    rows, cols = np.nonzero(near & q_core[:, None])
    labels_q, labels_r = np.full(len(q_ids), np.iinfo(np.int64).max), np.array(r_ids, dtype=np.int64)
    while True:
        np.minimum.at(labels_q, rows, labels_r[cols])
        updated = labels_r.copy()
        np.minimum.at(updated, cols, labels_q[rows])
        if (updated == labels_r).all():
            break
        labels_r = updated
    touched = np.unique(rows)
    moved = labels_r != r_ids  # a row that is its own smallest id needs no link
    frames = [pd.DataFrame({"u": q_ids[touched], "v": labels_q[touched], "border": False}),
              pd.DataFrame({"u": r_ids[moved], "v": labels_r[moved], "border": False})]
    rows, cols = np.nonzero(near & ~q_core[:, None])
    if len(rows):
        frames.append(pd.DataFrame({"u": q_ids[rows], "v": labels_r[cols], "border": True}).drop_duplicates())
    return pd.concat(frames)


def _number_clusters(core: DataFrame, links: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """(labels of core rows, root of every core row): clusters numbered by their smallest core row."""
    roots = star_components(links.filter(~F.col("border")).select("u", "v"))
    rooted = core.select(id).join(roots.withColumnRenamed("u", id), id, "left").withColumn("root", F.coalesce("root", F.col(id)))
    rooted = materialise(rooted)
    numbers = ordinal(rooted.select("root").distinct(), ["root"], "cluster")
    return rooted.join(numbers, "root").select(id, "root", F.col("cluster").cast("int").alias("cluster")), numbers


def dbscan_sets(df: DataFrame, id: str, items: str, eps: float, min_samples: int = 20) -> DataFrame:
    """DBSCAN of item sets under Euclidean distance of their indicator vectors.

    Every row gets `cluster` (-1 noise, and -1 for empty sets) and `core`.
    """
    sets, members = distinct_sets(df, id, items)
    labels = cluster_sets(sets, eps, min_samples)
    rows = members.join(labels, "sid").select(F.col("row").alias(id), "cluster", "core")
    return df.select(id).join(rows, id, "left").withColumns({
        "cluster": F.coalesce("cluster", F.lit(-1)), "core": F.coalesce("core", F.lit(False))})


def radius_of(eps: float) -> int:
    """Differing items that a Euclidean distance between indicator vectors allows."""
    return int(np.floor(eps * eps + 1e-9))


def cluster_sets(sets: DataFrame, eps: float, min_samples: int, near: DataFrame | None = None) -> DataFrame:
    """(sid, cluster, core) of distinct sets.  `near` may give their links up to this radius or a larger one.

    At small radii the links are found and verified once, and serve both the degrees and the clusters.
    """
    h = radius_of(eps)
    if near is None and h <= LISTED_RADIUS:
        near = materialise(set_links(sets, sets, h))
    counts = _with_apart(near.filter(F.col("distance") <= h), sets, sets, h) if near is not None else set_distance_counts(sets, sets, h)
    degree = counts.groupBy("sid").agg(F.sum("weight").alias("degree"))
    marked = materialise(sets.join(degree, "sid").withColumn("core", F.col("degree") >= min_samples).drop("degree"))
    core = marked.filter("core")
    if near is not None:
        ids = core.select("sid")
        to_core = near.filter((F.col("distance") <= h) & (F.col("sid") != F.col("other"))).join(ids.withColumnRenamed("sid", "other"), "other").select("sid", "other")
        flagged = to_core.join(ids.withColumn("inner", F.lit(True)), "sid", "left")
        links = materialise(flagged.select(F.col("sid").alias("u"), F.col("other").alias("v"), F.col("inner").isNull().alias("border"))
                            .filter(F.col("border") | (F.col("u") > F.col("v"))))
    else:
        def kernel(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            if q.empty or r.empty:
                return pd.DataFrame({"u": [], "v": [], "border": []})
            distance, _ = _overlaps(q, r)
            return _local_links(distance <= h, q["sid"].to_numpy(), r["sid"].to_numpy(), q["core"].to_numpy(dtype=bool))

        links = materialise(blocked(_posted(marked, h), _posted(core, h), "item", "sid", "sid", kernel,
                                    "u bigint, v bigint, border boolean").distinct())
    # Sets with sizes adding up to at most h are near each other without overlap: all such core
    # sets join the smallest core set.
    smallest = core.agg(F.min(F.struct("size", "sid"))).scalar()
    stars = core.filter(F.col("size") <= h - smallest["size"]).select(
        F.col("sid").alias("u"), smallest["sid"].alias("v"), F.lit(False).alias("border"))
    labels, _ = _number_clusters(core, links.unionByName(stars), "sid")
    labelled_core = materialise(labels.join(core.select("sid", "size"), "sid"))
    border = links.filter("border").select(F.col("u").alias("sid"), F.col("v").alias("t")).join(
        labelled_core.select(F.col("sid").alias("t"), "cluster"), "t").groupBy("sid").agg(F.min("cluster").alias("border_cluster"))
    by_size = labelled_core.filter(F.col("size") < h).groupBy("size").agg(F.min("cluster").alias("c")).agg(
        F.collect_list(F.struct("size", "c")).alias("by_size"))  # fewer than h entries
    small = F.array_min(F.transform(F.filter("by_size", lambda x: x["size"] <= F.lit(h) - F.col("size")), lambda x: x["c"]))
    return (with_row(marked, by_size).join(labelled_core.select("sid", "cluster"), "sid", "left").join(border, "sid", "left")
            .withColumn("cluster", F.coalesce("cluster", F.least("border_cluster", small), F.lit(-1))).select("sid", "cluster", "core"))


def dbscan_points(df: DataFrame, id: str, coordinates: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """DBSCAN of points in few dimensions, by cells so small that their points are all within `eps` of each other.

    A cell with `min_samples` rows holds core points only and needs no distances; of other cells fewer than `min_samples` rows
    meet the points around, so work grows with the rows.  Core points of a cell are one component.  Two cells are linked by
    their boxes or their outermost points, and only where those leave it open by the points near the other's box.
    """
    axes = range(len(coordinates))
    point = F.array(*[F.col(c).cast("double") for c in coordinates])
    rows = df.select(F.col(id).cast("bigint").alias("row"), point.alias("v"))
    side, wide = eps / np.sqrt(len(axes)) * (1 - 1e-6), eps * (1 + 1 / np.sqrt(len(axes)))
    reach = eps * eps * (1 + 1e-12)
    named = lambda xs: F.concat_ws("_", *[x.cast("string") for x in xs])
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cell = F.when(finite, named([F.floor(F.get("v", F.lit(i)) / side) for i in axes])).otherwise(F.concat(F.lit("none "), F.col("at")))
    stacked = rows.groupBy("v").agg(F.min("row").alias("pid"), F.count(F.lit(1)).alias("w")).withColumn("at", F.monotonically_increasing_id())
    stacked = materialise(stacked.withColumns({"cell": cell, "finite": finite}))
    box = [f(F.get("v", F.lit(i))).alias(f"{name}{i}") for i in axes for name, f in (("lo", F.min), ("hi", F.max))]
    gap = lambda a, b: sum(F.pow(F.greatest(F.lit(0.0), b(f"lo{i}") - a(f"hi{i}"), a(f"lo{i}") - b(f"hi{i}")), F.lit(2)) for i in axes)
    span = lambda a, b: sum(F.pow(F.greatest(b(f"hi{i}") - a(f"lo{i}"), a(f"hi{i}") - b(f"lo{i}")), F.lit(2)) for i in axes)
    one, two = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    at_point = lambda c: F.get("v", F.lit(int(c[2:])))

    cells = materialise(stacked.filter("finite").groupBy("cell").agg(F.sum("w").alias("held"), *box))
    around = np.array(np.meshgrid(*[[-1, 0, 1]] * len(axes))).T.reshape(-1, len(axes)).tolist()
    corner = lambda shift: named([F.floor(F.col(f"lo{i}") / wide) + s for i, s in enumerate(shift)])
    met = cells.withColumn("corner", F.explode(F.array(*[corner(s) for s in around]))).alias("a").join(
        cells.withColumn("corner", corner([0] * len(axes))).alias("b"), "corner").filter(gap(one, two) <= reach * (1 + 1e-9))
    near = materialise(met.select(F.col("a.cell").alias("cell"), F.col("b.cell").alias("other"), F.col("a.held").alias("held")))

    def within(q: pd.DataFrame, r: pd.DataFrame) -> np.ndarray:
        a, b = as_matrix(q["v"]), as_matrix(r["v"])
        return sum((a[:, i, None] - b[None, :, i]) ** 2 for i in range(a.shape[1])) <= reach

    def count(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"at": [], "weight": []})
        return pd.DataFrame({"at": q["at"], "weight": (within(q, r) * r["w"].to_numpy()[None, :]).sum(1)})

    def any_near(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"at": [], "cell": []})
        return pd.DataFrame({"at": q["at"].to_numpy()[within(q, r).any(1)], "cell": r["cell"].iloc[0]})

    def any_pair(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        linked = not q.empty and not r.empty and within(q, r).any()
        return pd.DataFrame({"u": q["u"].iloc[:1], "v": q["to"].iloc[:1]} if linked else {"u": [], "v": []})

    meeting = lambda points, pairs: points.join(pairs, "cell").select("at", "v", F.col("other").alias("cell"))
    few = near.filter(F.col("held") < min_samples).select("cell", "other")
    degree = blocked(meeting(stacked.select("at", "v", "cell"), few), stacked.select("at", "v", "cell", "w"), "cell", "at", "at", count, "at bigint, weight bigint")
    degree = degree.groupBy("at").agg(F.sum("weight").alias("degree"))
    full = cells.filter(F.col("held") >= min_samples).select("cell", F.lit(True).alias("full"))
    marked = stacked.filter(F.col("pid").isNotNull()).join(full, "cell", "left").join(degree, "at", "left")
    marked = materialise(marked.withColumn("core", F.coalesce("full", F.lit(False)) | (F.coalesce("degree", F.lit(0)) >= min_samples)).drop("full", "degree"))
    core = marked.filter("core")

    # Core cells, numbered by their smallest row; with the outermost points along axes and, in few dimensions, diagonals.
    ways = np.concatenate([np.eye(len(axes)), -np.eye(len(axes)), *([np.array(np.meshgrid(*[[-1, 1]] * len(axes))).T.reshape(-1, len(axes))] if 1 < len(axes) <= 3 else [])])
    along = lambda way: sum((F.get("v", F.lit(i)) * float(x) for i, x in enumerate(way) if x), F.lit(0.0))
    ends = F.array_distinct(F.array(*[F.max_by("v", along(way)) for way in ways]))
    kernels = core.groupBy("cell").agg(F.min("pid").alias("pid"), ends.alias("ends"), *box)
    kernels = materialise(ordinal(kernels, ["pid", "cell"], "node"))
    apart = lambda p, q: sum(F.pow(F.get(p, F.lit(i)) - F.get(q, F.lit(i)), F.lit(2)) for i in axes)
    touching = F.exists("a.ends", lambda p: F.exists("b.ends", lambda q: apart(p, q) <= reach))
    pairs = (near.select("cell", "other").join(kernels.alias("a"), "cell")
             .join(kernels.withColumnRenamed("cell", "other").alias("b"), "other").filter((one("node") > two("node")) & (gap(one, two) <= reach * (1 + 1e-9))))
    boxed = [side_(f"{name}{i}").alias(f"{to}{name}{i}") for to, side_ in (("a", one), ("b", two)) for i in axes for name in ("lo", "hi")]
    pairs = materialise(pairs.select("cell", "other", one("node").alias("u"), two("node").alias("to"), ((span(one, two) <= reach) | touching).alias("sure"), *boxed))
    sure, unsure = pairs.filter("sure").select("u", F.col("to").alias("v")), pairs.filter("NOT sure").withColumn("pair", F.concat_ws(" ", "cell", "other"))
    facing = lambda own, to: (core.select("at", "v", F.col("cell").alias(own)).join(unsure, own)
                              .filter(gap(at_point, lambda c: F.col(f"{to}{c}")) <= reach * (1 + 1e-9)).select("at", "v", "pair", "u", "to"))
    found = blocked(facing("cell", "b"), facing("other", "a"), "pair", "at", "at", any_pair, "u bigint, v bigint")
    links = materialise(sure.unionByName(found).distinct().withColumn("border", F.lit(False)))
    labels, _ = _number_clusters(kernels, links, "node")
    labelled = materialise(kernels.select("cell", "node").join(labels, "node").select("cell", "cluster"))
    edge = meeting(marked.filter(~F.col("core")).select("at", "v", "cell"), near.select("cell", "other"))
    border = blocked(edge, core.select("at", "v", "cell"), "cell", "at", "at", any_near, "at bigint, cell string")
    border = border.join(labelled, "cell").groupBy("at").agg(F.min("cluster").alias("b"))
    joined = (marked.join(labelled.withColumn("core", F.lit(True)), ["cell", "core"], "left").join(border, "at", "left")
              .select("v", F.coalesce("cluster", "b", F.lit(-1)).alias("cluster"), "core"))
    return null_safe(rows, joined, ["v"]).select(F.col("row").alias(id), "cluster", "core")


def density_summary(labels: DataFrame, eps: float, cluster: str = "cluster") -> DataFrame:
    """Clusters, noise share and share of the largest cluster among clustered rows."""
    counts = labels.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col(cluster) >= 0
    return counts.agg(F.count_if(inside).alias("n_clusters"),
                      (F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise_share"),
                      F.coalesce(F.try_divide(F.max(F.when(inside, F.col("n"))).cast("double"), F.sum(F.when(inside, F.col("n")))), F.lit(0.0)).alias("largest_cluster_share")
                      ).withColumn("eps", F.lit(float(eps)))


def pick_density_run(table: DataFrame, max_noise: float = 0.5) -> DataFrame:
    """Best silhouette with >= 2 clusters and little noise; else the least noise with >= 2 clusters; else the first radius."""
    multi = F.col("n_clusters") >= 2
    good = multi & (F.col("noise_share") <= max_noise)
    stage = F.when(good, 0).when(multi, 1).otherwise(2)
    score = F.when(good, -F.coalesce("silhouette", F.lit(-1.0))).when(multi, F.col("noise_share")).otherwise(F.col("eps"))
    return table.orderBy(stage, score, "eps").limit(1)


def tune_dbscan(df: DataFrame, id: str, items: str, radii: Sequence[float] | None = None, min_samples: int = 20,
                silhouette_of=None) -> DataFrame:
    """One summary row per radius; `silhouette_of(labels)` scores a labelling (a one-row frame).

    Without `radii` they are the candidates from the distances to the `min_samples`-th nearest row.  Sets are collapsed once,
    and links up to the largest listed radius are found once and filtered for the smaller ones.
    """
    if radii is None:
        radii = [r["eps"] for r in eps_candidates(set_k_distances(df, id, items, min_samples)).collect()]  # few: distances are whole numbers
    sets, members = distinct_sets(df, id, items)
    listed = max((h for h in map(radius_of, radii) if h <= LISTED_RADIUS), default=-1)
    near = materialise(set_links(sets, sets, listed)) if listed >= 0 else None
    out = None
    for eps in radii:
        found = cluster_sets(sets, eps, min_samples, near if radius_of(eps) <= LISTED_RADIUS else None)
        labels = materialise(members.join(found, "sid").select(F.col("row").alias(id), "cluster", "core"))
        row = density_summary(labels, eps)
        score: Column = silhouette_of(labels).scalar() if silhouette_of else F.lit(None).cast("double")
        row = materialise(row.withColumn("silhouette", score))
        discard(labels)
        out = row if out is None else out.unionByName(row)
    return out
