"""Splits, leakage, metrics and bootstraps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysift.operators import bootstrap as b
from paysift.operators import metrics as m
from paysift.operators import splits as s

LABELS = ["Low", "Mid", "High"]


@pytest.fixture(scope="module")
def grouped(spark):
    """600 rows; one group holds a third of them, the others are small."""
    rows = [(i, "hot" if i < 200 else f"g{i % 90}", LABELS[(i * 7 + i // 5) % 3]) for i in range(600)]
    return spark.createDataFrame(rows, "id long, grp string, tier string").cache()


def test_group_folds_keep_groups_whole_and_balanced(grouped):
    folded = s.stratified_group_folds(grouped, "grp", "tier", 5, 2026)
    assert folded.count() == 600
    per_group = folded.groupBy("grp").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert per_group == 1
    sizes = {r["fold"]: r["count"] for r in folded.filter("grp <> 'hot'").groupBy("fold").count().collect()}
    assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 60
    again = s.stratified_group_folds(grouped, "grp", "tier", 5, 2026)
    assert folded.select("id", "fold").exceptAll(again.select("id", "fold")).count() == 0


def test_grouped_design_separates_outer_and_inner_groups(grouped):
    design = s.grouped_design(grouped, "grp", "tier").collect()
    test = {r["grp"] for r in design if r["outer_role"] == "test"}
    train = {r["grp"] for r in design if r["outer_role"] == "train"}
    assert test and train and not test & train
    assert {r["inner_fold"] for r in design if r["outer_role"] == "test"} == {-1}
    folds = {}
    for r in design:
        if r["outer_role"] == "train":
            folds.setdefault(r["grp"], set()).add(r["inner_fold"])
    assert all(len(f) == 1 for f in folds.values()) and set.union(*folds.values()) == {0, 1, 2}


def test_stratified_split_is_exact_per_class(grouped):
    split = s.stratified_split(grouped, "id", "tier", 42)
    for r in split.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "test").alias("t")).collect():
        assert r["t"] == round(r["n"] * 0.2)


def test_employer_groups_keep_missing_apart(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " Example  Corp "), (4, "example corp")], "id int, c string")
    got = [r[0] for r in df.select(s.employer_group("c", "id")).collect()]
    assert len(set(got)) == 3 and got[2] == got[3]


def test_connected_groups_follow_chains_and_hot_keys(spark):
    n = 300
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(n)] + [(1000 + i, "hot", None) for i in range(400)] + [(5000, None, None), (5001, None, "b0")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    got = {r["id"]: r["component"] for r in s.connected_groups(df, "id", ["x", "y"]).collect()}
    assert {got[i] for i in range(n)} == {0} and {got[1000 + i] for i in range(400)} == {1000}
    assert got[5000] == 5000 and got[5001] == 0


def test_components_with_hubs_joined_where_they_lie(spark):
    """Stars above `least` edges, a path between them, loops and repeated edges."""
    edges = [(0, i) for i in range(1, 200)] + [(i, 900) for i in range(300, 500)] + [(i, i + 1) for i in range(600, 640)] + [(199, 300), (7, 7), (2000, 2000), (1, 0)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["u"]: r["root"] for r in s.star_components(df, least=20).collect()}
    assert got == {r["u"]: r["root"] for r in s.star_components(df).collect()}
    assert {got[i] for i in [*range(200), *range(300, 500), 900]} == {0} and {got[i] for i in range(600, 641)} == {600} and got[2000] == 2000
    assert len(got) == 200 + 201 + 41 + 1


def test_stars_are_told_before_a_round(spark, monkeypatch):
    """Links that are stars already need no round, and a path ends without a round that moves nothing; empty lists and loops stay."""
    stored = []
    keep = s.materialise
    monkeypatch.setattr(s, "materialise", lambda df: stored.append(1) or keep(df))

    def labelled(edges):
        stored.clear()
        return sorted([tuple(r) for r in s.star_components(spark.createDataFrame(edges, "u long, v long")).collect()], key=repr), len(stored)

    assert labelled([(1, 5), (6, 1), (1, 6), (3, 3), (9, 8), (None, 2), (None, None)]) == ([(1, 1), (2, 2), (3, 3), (5, 1), (6, 1), (8, 8), (9, 8), (None, None)], 3)
    assert labelled([]) == ([], 3)
    assert labelled([(1, 2), (2, 3)]) == ([(1, 1), (2, 1), (3, 1)], 4)


def test_confusion_metrics_on_literal_rows(spark):
    df = spark.createDataFrame([("Low", "Low"), ("Low", "Mid"), ("High", "Mid")], "a string, p string")
    row = m.classification_metrics(df, "a", "p").first()
    assert (row["accuracy"], row["f1_low"], row["f1_mid"], row["f1_high"], row["recall_low"]) == pytest.approx((1 / 3, 2 / 3, 0, 0, 0.5))
    normal = {(r["actual"], r["predicted"]): r["share"] for r in m.normalised_confusion(m.confusion(df, "a", "p")).collect()}
    assert normal["Low", "Mid"] == 0.5 and normal["Mid", "Low"] == 0.0 and len(normal) == 9


def test_macro_metrics_on_six_rows(spark):
    names = lambda s_: [LABELS[int(x)] for x in s_]
    df = spark.createDataFrame(list(zip(names("001122"), names("011120"))), "a string, p string")
    row = m.classification_metrics(df, "a", "p").first()
    assert row["accuracy"] == pytest.approx(4 / 6) and row["macro_f1"] == pytest.approx(np.mean([0.5, 0.8, 2 / 3]))


def test_auc_matches_pair_counting(spark):
    rng = np.random.default_rng(0)
    score, label = rng.integers(0, 12, 200) / 12, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(("High" if y else "Low"), float(x)) for x, y in zip(score, label)], "a string, s double")
    pos, neg = score[label == 1], score[label == 0]
    expected = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    got = m.auc_ovr(df, "a", {"High": "s"}).first()["auc"]
    assert got == pytest.approx(expected)


def test_majority_prefers_the_earlier_label_on_ties(spark):
    df = spark.createDataFrame([("High",), ("Low",), ("High",), ("Low",)], "a string")
    assert df.limit(1).select(m.majority_label(df, "a")).first()[0] == "Low"


def test_bootstrap_resamples_groups_not_rows(spark):
    rows = [("one", "Low", "Low")] * 4 + [("two", "High", "Low")] * 4
    df = spark.createDataFrame(rows, "g string, a string, p string")
    got = {r["metric"]: (r["low"], r["high"], r["defined_replicates"]) for r in b.prediction_bootstrap(df, "g", "a", "p", 200, 1).collect()}
    assert got["accuracy"] == (0.0, 1.0, 200)


def test_draws_add_up_to_the_group_count(spark):
    weights = b.draw_weights(spark.range(1), 7, 30, 3)
    assert {r["s"] for r in weights.groupBy("replicate").agg(F.sum("__w").alias("s")).collect()} == {7}
    assert weights.select("__g").distinct().count() == 7


def test_rule_bootstrap_counts_undefined_replicates(spark):
    df = spark.createDataFrame([("x", ["a", "b"]), ("y", ["b"]), ("z", [])], "g string, items array<string>")
    rule = spark.createDataFrame([("a", "b")], "antecedents string, consequents string")
    got = {r["metric"]: r["defined_replicates"] for r in b.rule_bootstrap(df, "items", "g", rule, 100, 2).collect()}
    assert got["support"] == 100 and got["confidence"] < 100
    fraction = b.rule_pass_fraction(b.rule_replicates(df, "items", "g", rule, 100, 2), {"p": 0.1}).first()["pass_fraction_p"]
    assert 0 < fraction < got["confidence"] / 100 + 1e-9


def test_leakage_report_levels(spark):
    rows = [(1, "A <b>job</b> 10", "c", "t", True), (2, "a job 10", "c", "t", False), (3, "a job 11", "d", "u", False), (4, None, None, "t", True)]
    df = spark.createDataFrame(rows, "id int, d string, c string, t string, train boolean")
    got = {r["key"]: (r["cross_split_groups"], r["largest_group"]) for r in s.leakage_report(df, "d", "c", "t", F.col("train")).collect()}
    assert got == {"exact_description": (0, 1), "normalized_description": (1, 2), "masked_template": (1, 3), "company_title": (1, 2)}
