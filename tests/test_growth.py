"""Plans and steps that must not grow faster than their input."""

import contextlib
import hashlib
import io

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import functions as F

from paysift.operators import bootstrap, density, models, neighbours
from paysift.plans import load_all
from paysift.scale import distinct_rows
from paysift.sources.sinks import file_fingerprints


def plan_of(df) -> str:
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_set_keys_are_never_broadcast(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b", "c"]), (3, ["d"])], "id long, items array<string>")
    sets, _ = density.distinct_sets(rows, "id", "items")
    links = density.set_links(sets, sets, 2)
    assert "BroadcastHashJoin" not in plan_of(links)
    assert sorted((r["sid"], r["other"], r["distance"]) for r in links.collect()) == [(1, 1, 0), (1, 2, 1), (2, 1, 1), (2, 2, 0), (3, 3, 0)]


def test_rows_are_sent_to_a_bounded_number_of_blocks(spark):
    rows = spark.range(60_000).withColumn("key", F.lit(0))
    kernel = lambda q, r: pd.DataFrame({"q": [len(q)], "r": [len(r)], "most": [len(q) * len(r)]})
    met = neighbours.blocked(rows, rows, "key", "id", "id", kernel, "q long, r long, most long")
    sent = met.agg(F.sum("q"), F.sum(F.col("q") * F.col("r")), F.max("most")).first()
    assert sent[0] <= 60_000 * (neighbours.BLOCKS + 1) and sent[1] == 60_000 ** 2 and sent[2] <= neighbours.BLOCK ** 2


def test_cosine_sums_are_linear_and_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    data = [(i % 37, rng.normal(size=4).tolist(), i % 3) for i in range(60)] + [(100, [0.0] * 4, 1)]  # repeated ids, a zero vector
    sums = neighbours.pairwise_cluster_sums(spark.createDataFrame(data, "id long, v array<double>, label int"), "id", "v", "label", "cosine")
    assert "CoGroup" not in plan_of(sums)
    unit = {}
    for at, (_, v, _) in enumerate(data):
        unit[at] = np.array(v) / max(np.linalg.norm(v), 1e-300)
    expected = {}
    for a, (i, _, own) in enumerate(data):
        for b, (j, _, other) in enumerate(data):
            total, n = expected.get((i, own, other), (0.0, 0))
            expected[i, own, other] = (total + (0.0 if i == j else 1 - unit[a] @ unit[b]), n + 1)
    got = {(r["id"], r["label"], r["other"]): (r["total"], r["n"]) for r in sums.collect()}
    assert got.keys() == expected.keys()
    for k, (total, n) in expected.items():
        assert got[k][1] == n and abs(got[k][0] - total) < 1e-9


def test_streamed_files_are_not_loaded_by_spark(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    prints = file_fingerprints(spark, str(tmp_path))
    assert "content" not in plan_of(prints)
    assert [(r["file"], r["bytes"], r["sha256"]) for r in prints.collect()] == [("a.bin", 3000, hashlib.sha256(b"abc" * 1000).hexdigest())]


def test_distinct_rows_are_dealt_before_they_are_reduced(spark):
    rows = spark.range(1000).select((F.col("id") % 300).alias("a"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"))
    found = distinct_rows(rows, ["a", "b"], held=10)
    plan = plan_of(found)
    assert plan.count("Exchange") == 1 and "Exchange" not in plan.split("HashAggregate")[1]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, rows.distinct().collect()), key=str)


def test_pay_needs_no_item_lists(spark):
    assert "lineitem" not in plan_of(load_all()["olap_by_experience"](spark, "/root/testdata/sf0.001"))


def test_auc_bootstrap_agrees_by_both_ways_of_weights(spark, monkeypatch):
    rng = np.random.default_rng(8)
    tiers = ["Low", "Mid", "High"]
    data = [(f"g{i % 7}", tiers[rng.integers(3)], *(float(x) for x in rng.integers(0, 9, 3))) for i in range(300)]
    df = spark.createDataFrame(data, "g string, t string, a double, b double, c double")
    scores = {"Low": "a", "Mid": "b", "High": "c"}
    run = lambda: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in bootstrap.auc_bootstrap(df, "g", "t", scores, 20, 3).collect()]
    sent = run()
    monkeypatch.setattr(bootstrap, "SENT_WEIGHTS", 0)
    assert sent == run() and sent[0][3] == 20


class Spy(Estimator):
    """Notes what it is fitted on and adds nothing."""

    seen: list = []

    def _fit(self, dataset):
        Spy.seen.append((dataset.columns, dataset.storageLevel.useDisk))
        return PipelineModel([])


def test_features_are_kept_while_a_model_is_fitted(spark):
    jobs = spark.createDataFrame([(["a"], "Unknown", 5, "TX", "X", "t", "c", 0.0), (["b"], "Unknown", 7, None, "Y", "u", "d", 1.0)],
                                 "matched_skills array<string>, experience_level string, employee_count long, state string, industry string, job_title string, company_name string, label double")
    fitted = models.with_features([Spy()], ["a", "b"]).fit(jobs)
    assert Spy.seen == [(["label", "features"], True)]
    assert models.feature_stage(fitted).feature_names[2:4] == ["skill_a", "skill_b"] and fitted.transform(jobs).count() == 2


def test_points_of_full_cells_need_no_distances(spark, monkeypatch):
    rng = np.random.default_rng(11)
    centres = [(0.0, 0.0), (0.9, 0.2), (6.0, 6.0)]
    points = [(x + dx, y + dy) for x, y in centres for dx, dy in rng.uniform(0, 0.3, (400, 2))] + [(1.9, 0.3), (2.95, 0.3), (30.0, 1.0)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)] + [(9000, None, 1.0)], "id long, x double, y double")
    met = []
    blocked = density.blocked

    def spy(queries, refs, *rest):
        met.append(queries.count())
        return blocked(queries, refs, *rest)

    monkeypatch.setattr(density, "blocked", spy)
    found = {r["id"]: (r["cluster"], r["core"]) for r in density.dbscan_points(df, "id", ["x", "y"], 1.0, 20).collect()}
    assert sum(met) < 200  # the lonely points, once for each cell around
    v = np.array(points)
    near = ((v[:, None] - v[None]) ** 2).sum(2) <= 1.0
    assert [found[i][1] for i in range(len(points))] == (near.sum(1) >= 20).tolist()
    assert [found[i][0] for i in (0, 400, 800, 1200, 1201, 1202, 9000)] == [0, 0, 1, 0, -1, -1, -1] and {c for c, _ in found.values()} == {-1, 0, 1}


def test_points_in_few_dimensions_meet_few_others(spark, monkeypatch):
    most = []
    tree = neighbours.pivot_tree

    def spy(*args):
        placed, levels = tree(*args)
        most.append(placed.groupBy("cell").count().agg(F.max("count")).first()[0])
        return placed, levels

    monkeypatch.setattr(neighbours, "pivot_tree", spy)
    monkeypatch.setattr(neighbours, "FLAT_CELL", 100)
    flat = np.random.default_rng(12).uniform(0, 9, (600, 2)).round(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "id long, v array<double>")
    found = {(r["id"], r["rank"]): r["neighbour"] for r in neighbours.knn_join(df, "id", "v", 5).collect()}
    assert most[0] <= 100
    for i in range(0, 600, 37):
        d = np.sqrt(((flat - flat[i]) ** 2).sum(1))
        assert [found[i, r + 1] for r in range(5)] == [n for _, n in sorted((x, n) for n, x in enumerate(d) if n != i)][:5]
