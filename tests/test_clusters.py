"""Neighbours, density clusters, k-means views and outliers against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysift.operators import clustering as c
from paysift.operators import density as d
from paysift.operators import hotspots as h
from paysift.operators import neighbours as n
from paysift.operators import outliers as o


def points(spark, array):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(array)], "id long, v array<double>")


@pytest.fixture(scope="module")
def cloud():
    """Clumps, and one vector that makes up a third of all rows."""
    rng = np.random.default_rng(5)
    clumps = np.concatenate([rng.normal(m, 0.3, (60, 3)) for m in (0.0, 4.0, 9.0)])
    return np.concatenate([clumps, np.repeat([[1.0, 1.0, 1.0]], 90, axis=0)]).round(3)


@pytest.mark.parametrize("pivots, block", [(1, 10_000), (9, 17)])
def test_knn_matches_brute_force_with_copies(spark, cloud, pivots, block):
    k = 5
    got = {}
    for r in n.knn_join(points(spark, cloud), "id", "v", k, pivots=pivots, block=block).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"], r["distance"]))
    distance = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(2))
    for i in range(len(cloud)):
        order = sorted((distance[i, j], j) for j in range(len(cloud)) if j != i)[:k]
        assert [(rank, j) for rank, j, _ in sorted(got[i])] == [(r + 1, j) for r, (_, j) in enumerate(order)]


@pytest.mark.parametrize("cell, pivots, block, visits", [(16, 5, 11, 2)])
def test_knn_over_a_deep_pivot_tree(spark, cloud, monkeypatch, cell, pivots, block, visits):
    """Small cells, many levels and turns; rows far from zero, ties on a grid, and copies."""
    monkeypatch.setattr(n, "VISITS", visits)
    grid = np.array([[i, j, 0.0] for i in range(6) for j in range(6)]) + 1e5
    rows = np.concatenate([cloud[::2], grid, grid[:5], [[1e5, 0.0, 0.0]]])
    k = 4
    got = {}
    for r in n.knn_join(points(spark, rows), "id", "v", k, pivots=pivots, cell=cell, block=block).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    distance = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(2))
    for i in range(len(rows)):
        order = sorted((distance[i, j], j) for j in range(len(rows)) if j != i)[:k]
        assert sorted(got[i]) == [(r + 1, j) for r, (_, j) in enumerate(order)]


def test_pivot_tree_cells_are_bounded_and_whole(spark, cloud):
    rows = points(spark, np.unique(cloud, axis=0))
    placed, levels = n.pivot_tree(rows, pivots=3, cell=15, block=50)
    assert len(levels) > 1
    assert sorted(r["id"] for r in placed.collect()) == sorted(r["id"] for r in rows.collect())
    assert max(r["count"] for r in placed.groupBy("cell").count().collect()) <= 15
    centres = {r["node"]: r for level in levels for r in level.collect()}
    for r in placed.collect():
        names = r["cell"].split(".")
        for depth in range(2, len(names) + 1):
            node = centres[".".join(names[:depth])]
            assert np.linalg.norm(np.array(r["v"]) - node["centre"]) <= node["radius"]


def test_knn_of_few_rows(spark):
    assert n.knn_join(spark.createDataFrame([], "id long, v array<double>"), "id", "v", 3).count() == 0
    assert n.knn_join(points(spark, [[1.0, 2.0]]), "id", "v", 3).count() == 0
    assert [tuple(r) for r in n.knn_join(points(spark, [[0.0], [3.0]]), "id", "v", 3, cell=1, pivots=2).orderBy("id").collect()] == [(0, 1, 3.0, 1), (1, 0, 3.0, 1)]


def brute_dbscan(near, weights_core, min_samples):
    """Labels by the textbook procedure, clusters numbered by their smallest core row."""
    core = near.sum(1) >= min_samples
    labels = np.full(len(near), -1)
    number = 0
    for i in range(len(near)):
        if not core[i] or labels[i] >= 0:
            continue
        stack = [i]
        labels[i] = number
        while stack:
            for q in np.flatnonzero(near[stack.pop()]):
                if labels[q] < 0:
                    labels[q] = number
                    if core[q]:
                        stack.append(q)
        number += 1
    return labels, core


def random_sets(seed, rows, items, p):
    rng = np.random.default_rng(seed)
    return [[f"i{x}" for x in range(items) if rng.random() < p[x % len(p)]] for _ in range(rows)]


@pytest.mark.parametrize("h, items", [(0, 10), (1, 12), (2, 90), (3, 14), (3, 200)])
def test_set_links_match_brute_force(spark, h, items):
    """Few items (masks tell distances) and more than 64 (items do), equal rests, nested sets and one item in every set."""
    sets = {tuple(sorted(x)) for x in random_sets(h + items, 120, items, [6 / items, 2 / items]) if x}
    sets |= {tuple(sorted({*x[:-1], "i0"})) for x in sets} | {(*x, "i999") for x in list(sets)[:30]}
    rows = list(enumerate(sorted(sets)))
    df, _ = d.distinct_sets(spark.createDataFrame([(i, list(x)) for i, x in rows], "id long, items array<string>"), "id", "items")
    got = sorted((r["sid"], r["other"], r["distance"], r["ref_size"]) for r in d.set_links(df, df, h).collect())
    sizes = {i: len(set(x)) for i, x in rows}
    want = sorted((i, j, len(set(x) ^ set(y)), sizes[j]) for i, x in rows for j, y in rows if set(x) & set(y) and len(set(x) ^ set(y)) <= h)
    assert got == want


@pytest.mark.parametrize("eps, min_samples", [(1.0, 4), (1.5, 6), (2.0, 12), (2.3, 25)])
def test_dbscan_of_sets_matches_brute_force(spark, eps, min_samples):
    sets = random_sets(int(eps * 10), 260, 12, [0.5, 0.05, 0.1]) + [["i0", "i1"]] * 90 + [["z1"]] * 5 + [["z2", "z3"]] * 5 + [[]] * 3
    df = spark.createDataFrame([(i, x) for i, x in enumerate(sets)], "id long, items array<string>")
    got = {r["id"]: (r["cluster"], r["core"]) for r in d.dbscan_sets(df, "id", "items", eps, min_samples).collect()}
    filled = [i for i, x in enumerate(sets) if x]
    near = np.array([[len(set(sets[a]) ^ set(sets[b])) <= int(eps * eps + 1e-9) for b in filled] for a in filled])
    labels, core = brute_dbscan(near, None, min_samples)
    assert [got[i] for i in filled] == list(zip(labels.tolist(), core.tolist()))
    assert all(got[i] == (-1, False) for i, x in enumerate(sets) if not x)


def test_set_k_distances_match_brute_force(spark):
    sets = random_sets(3, 150, 14, [0.4, 0.03]) + [["i0"]] * 60 + [["far1", "far2", "far3", "far4", "far5", "far6", "far7"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(sets)], "id long, items array<string>")
    got = {r["id"]: r["k_distance_sq"] for r in d.set_k_distances(df, "id", "items", 20).collect()}
    filled = [i for i, x in enumerate(sets) if x]
    assert set(got) == set(filled)
    for i in filled:
        assert got[i] == sorted(len(set(sets[i]) ^ set(sets[j])) for j in filled)[19]


def test_dbscan_of_points_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    xy = np.concatenate([rng.normal((0, 0), 0.4, (80, 2)), rng.normal((3, 3), 0.4, (80, 2)), rng.uniform(-5, 8, (60, 2)), np.repeat([[0.5, 0.5]], 70, axis=0)]).round(4)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, x double, y double")
    got = {r["id"]: (r["cluster"], r["core"]) for r in d.dbscan_points(df, "id", ["x", "y"], 0.5, 8).collect()}
    near = ((xy[:, None] - xy[None]) ** 2).sum(2) <= 0.25 * (1 + 1e-12)
    labels, core = brute_dbscan(near, None, 8)
    assert [got[i] for i in range(len(xy))] == list(zip(labels.tolist(), core.tolist()))


def test_density_pick_prefers_silhouette_then_noise(spark):
    schema = "eps double, n_clusters long, noise_share double, silhouette double"
    pick = lambda rows: d.pick_density_run(spark.createDataFrame(rows, schema)).first()["eps"]
    assert pick([(1.0, 3, 0.6, 0.9), (2.0, 2, 0.4, 0.1), (3.0, 2, 0.2, 0.3)]) == 3.0
    assert pick([(1.0, 3, 0.9, 0.9), (2.0, 2, 0.7, 0.1), (3.0, 1, 0.0, None)]) == 2.0
    assert pick([(1.0, 1, 0.9, None), (2.0, 0, 1.0, None)]) == 1.0


def test_silhouette_and_davies_bouldin_on_two_clumps(spark):
    array = np.array([[0.0, 0.0], [0.0, 1.0], [5.0, 0.0], [5.0, 1.0], [9.0, 9.0]])
    df = points(spark, array).withColumn("c", F.when(F.col("id") < 2, 0).when(F.col("id") < 4, 1).otherwise(-1))
    b0 = (5 + np.sqrt(26)) / 2
    assert n.silhouette(df, "id", "v", "c").first()[0] == pytest.approx((b0 - 1) / b0)
    assert c.davies_bouldin(df, "v", "c").first()[0] == pytest.approx(0.2)
    assert n.silhouette(df.filter("c = 0"), "id", "v", "c").first()[0] is None


def test_block_size_does_not_change_silhouette(spark, cloud):
    df = points(spark, cloud).withColumn("c", (F.col("id") / 60).cast("int"))
    whole = n.pairwise_cluster_sums(df, "id", "v", "c").groupBy().agg(F.sum("total")).first()[0]
    cut = n.pairwise_cluster_sums(df, "id", "v", "c", block=23).groupBy().agg(F.sum("total")).first()[0]
    assert cut == pytest.approx(whole)


def test_kmeans_finds_planted_groups_and_names_them(spark):
    rows = [(i, ["python", "sql"] if i % 3 == 0 else ["nursing", "bls"] if i % 3 == 1 else ["sales"]) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    vocabulary = ["python", "sql", "nursing", "bls", "sales"]
    hot = c.multi_hot(df, "items", vocabulary)
    labelled = c.fit_kmeans(hot, 3, restarts=3).transform(hot).cache()
    truth = labelled.withColumn("truth", F.col("id") % 3)
    assert c.adjusted_rand_index(truth, "cluster", "truth").first()[0] == pytest.approx(1.0)
    names = {r["cluster_name"] for r in c.name_clusters(c.defining_items(labelled, "items", "cluster"), "cluster").collect()}
    assert names == {"Data, Tech & Engineering", "Healthcare & Clinical", "Sales, Retail & Customer Service"}


def test_generalist_clusters_list_their_most_frequent_items(spark):
    rows = [(0, ["a"]), (0, ["a"]), (1, ["a", "b"]), (1, ["a", "b"]), (-1, ["b"])]
    df = spark.createDataFrame(rows, "cluster int, items array<string>")
    got = {(r["cluster"], r["item"]): r["over_represented"] for r in c.defining_items(df, "items", "cluster").collect()}
    assert got == {(0, "a"): True, (1, "a"): True, (1, "b"): True} or (0, "a") in got


def test_singular_vectors_match_numpy(spark):
    sets = random_sets(2, 60, 8, [0.5, 0.3])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(sets)], "id long, items array<string>")
    matrix = np.array([[float(f"i{j}" in x) for j in range(8)] for x in sets])
    got = {r["id"]: r["coordinates"] for r in c.svd_rows(df, "id", "items", 3, tfidf=False, unit=False).collect()}
    _, singular, _ = np.linalg.svd(matrix, full_matrices=False)
    norms = np.sqrt((np.array([got.get(i, [0, 0, 0]) for i in range(60)]) ** 2).sum(0))
    assert norms == pytest.approx(singular[:3])


@pytest.mark.parametrize("extra", [2, 24])
def test_block_iteration_finds_the_leading_singular_vectors(spark, extra):
    """A block narrower than the items has to iterate; a wider one is exact at once."""
    rng = np.random.default_rng(5)
    matrix = np.maximum(0, rng.normal(0, 1, (80, 3)) @ (rng.normal(0, 1, (3, 14)) * [[4], [2], [1]])).round(3)
    long = [(i, f"i{j:02d}", float(matrix[i, j])) for i in range(80) for j in range(14) if matrix[i, j]]
    df = spark.createDataFrame(long, "id long, item string, x double")
    basis, explained = c.singular_basis(df, "id", 2, extra=extra)
    got = np.array([r["b"] for r in basis.orderBy("item").collect()])
    _, singular, vectors = np.linalg.svd(matrix, full_matrices=False)
    want = vectors[:2].T * np.sign(vectors[:2].T[np.abs(vectors[:2]).argmax(1), [0, 1]])
    assert got == pytest.approx(want, abs=1e-4) and explained == pytest.approx((singular[:2] ** 2).sum() / (singular ** 2).sum())


@pytest.mark.parametrize("cosine", [False, True])
def test_counted_vectors_score_as_their_rows_do(spark, cosine):
    vectors = [([1.0, 0.0], 0, 4), ([0.0, 1.0], 1, 1), ([1.0, 1.0], 0, 2), ([2.0, 5.0], 2, 3), ([3.0, 1.0], 2, 1)]
    counted = spark.createDataFrame([(v, k, n) for v, k, n in vectors], "v array<double>, cluster int, n long")
    rows = c.vector_column(counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))), "v").select("features", "v", "cluster")
    assert c.counted_silhouette(counted, "v", cosine) == pytest.approx(c.fast_silhouette(rows, cosine=cosine))
    assert c.davies_bouldin(counted, "v", "cluster", "n").first()[0] == pytest.approx(c.davies_bouldin(rows, "v", "cluster").first()[0])
    assert c.counted_silhouette(counted.filter("cluster = 0"), "v", cosine) is None


def test_equal_lists_go_into_the_basis_once(spark, monkeypatch):
    lists = [["a"], ["a", "b"], ["b", "c"]]
    rows = [(i, lists[i % 3]) for i in range(60)] + [(100, ["a"]), (100, ["a", "c"]), (None, ["c"])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    plain = {r["id"]: r["coordinates"] for r in c.project(*(lambda long: (long, "id", c.singular_basis(long, "id", 2)[0]))(
        df.select("id", F.explode("items").alias("item"), F.lit(1.0).alias("x")))).collect()}
    seen, basis = [], c.singular_basis
    monkeypatch.setattr(c, "singular_basis", lambda *a, alike=None, **k: seen.append(alike.select("row").distinct().count()) or basis(*a, alike=alike, **k))
    got = {r["id"]: r["coordinates"] for r in c.svd_rows(df, "id", "items", 2, tfidf=False, unit=False).collect()}
    assert seen == [4]  # three lists, and the id that repeats
    assert got.keys() == plain.keys() and all(got[i] == pytest.approx(plain[i]) for i in got)


def test_pca_coordinates_are_centred(spark):
    rng = np.random.default_rng(1)
    df = c.vector_column(points(spark, rng.normal(3, 1, (200, 5)) * [5, 1, 1, 1, 1]), "v")
    flat, explained = c.pca_coordinates(df)
    means = flat.agg(F.avg(F.get("coordinates", F.lit(0))), F.avg(F.get("coordinates", F.lit(1)))).first()
    assert abs(means[0]) < 1e-9 and abs(means[1]) < 1e-9 and 0.8 < explained < 1


def test_isolation_forest_flags_the_planted_outlier(spark):
    rng = np.random.default_rng(4)
    data = np.concatenate([rng.normal(0, 1, (500, 2)), [[30.0, -30.0]] * 5])
    scored = o.isolation_forest(points(spark, data), "id", "v", contamination=0.01, trees=40, sample=128)
    flagged = {r["id"] for r in scored.filter("flagged").select("id").collect()}
    assert {500, 501, 502, 503, 504} <= flagged and len(flagged) <= 6
    again = o.isolation_forest(points(spark, data), "id", "v", contamination=0.01, trees=40, sample=128)
    assert scored.select("id", "anomaly_score").exceptAll(again.select("id", "anomaly_score")).count() == 0


def test_a_walked_tree_ends_where_its_branches_lead():
    x = np.random.default_rng(8).normal(0, 1, (300, 3))
    feature, threshold, left, right, path = (np.array(p) for p in zip(*o._grow(x, np.random.default_rng(1), 8)))
    x = np.concatenate([x, [[np.nan, np.inf, -np.inf]]])
    *_, child, ends, depth = (walk := o._walkable(feature, threshold, left, right, path))
    at = np.zeros(len(x), int)
    for _ in range(depth):
        at = child[2 * at + (x[np.arange(len(x)), walk[0][at]] <= walk[1][at])]
    for row, got in zip(x, ends[at]):
        node = 0
        while feature[node] >= 0:
            node = left[node] if row[feature[node]] <= threshold[node] else right[node]
        assert path[node] == got


def test_hotspots_are_found_where_high_rows_gather(spark):
    rng = np.random.default_rng(6)
    xy = np.concatenate([rng.normal((0, 0), 0.5, (80, 2)), rng.normal((20, 20), 0.5, (80, 2))])
    rows = [(i, float(a), float(b), "High" if i < 80 else "Low", i // 80, ["x"], "t") for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id long, x double, y double, tier string, k int, items array<string>, title string")
    spots = h.high_tier_hotspots(df, "id", ["x", "y"], "tier", 10, 0.7, 1.5, 5).cache()
    inside = {r["id"] for r in spots.filter("hotspot = 0").collect()}
    assert inside <= set(range(80)) and len(inside) > 60
    shares = spark.createDataFrame([("x", 1.0)], "item string, share double")
    row = h.describe_hotspots(df, spots, "id", ["x", "y"], "tier", "k", "items", "title", shares).first()
    assert row["high_share"] == 1.0 and row["majority_cluster"] == 0 and row["top_items"] == "x" and row["top_titles"] == "t"


@pytest.mark.parametrize("cosine", [False, True])
def test_many_clusters_meet_vectors_in_blocks_with_the_same_silhouette(spark, monkeypatch, cosine):
    rng = np.random.default_rng(7)
    vectors = rng.integers(0, 2, (60, 6)) + np.eye(6)[rng.integers(0, 6, 60)]
    rows = spark.createDataFrame([([float(x) for x in v], int(k)) for v, k in zip(vectors, rng.integers(0, 9, 60))] + [([9.0] * 6, 9)], "v array<double>, cluster int")
    rows = c.vector_column(rows.unionByName(rows.limit(25)), "v").select("features", "cluster")
    few = c.fast_silhouette(rows, cosine=cosine)
    monkeypatch.setattr(c, "FEW_CLUSTERS", 3)
    monkeypatch.setattr(c, "ClusteringEvaluator", None)
    assert c.fast_silhouette(rows, cosine=cosine) == pytest.approx(few)
