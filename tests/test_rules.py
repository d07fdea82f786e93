"""Itemsets, rules and graphs on literal cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from paysift.operators import graph as g
from paysift.operators import rules as r


def lists(spark, rows):
    return spark.createDataFrame([(i, list(x)) for i, x in enumerate(rows)], "id long, items array<string>")


def test_empty_baskets_stay_in_the_denominator(spark):
    found = r.frequent_itemsets(lists(spark, [["a", "b"]] * 10 + [[]] * 190), "items", 0.05).collect()
    assert len(found) == 3 and all(x["support"] == 0.05 for x in found)


def test_strict_thresholds(spark):
    def kept(a_only, b_only, both, n):
        rows = [["a"]] * a_only + [["b"]] * b_only + [["a", "b"]] * both
        df = lists(spark, rows + [[]] * (n - len(rows)))
        return {(x["antecedents"], x["consequents"]) for x in r.mine_rules(df, "items", 0.05).collect()}
    assert ("a", "b") not in kept(8, 0, 8, 40)      # confidence exactly .5
    assert ("a", "b") not in kept(5, 5, 15, 40)     # lift exactly 1.5
    assert ("a", "b") in kept(6, 2, 10, 40)


def test_all_splits_match_enumeration(spark):
    rng = random.Random(3)
    rows = [[x for x in "abcde" if rng.random() < 0.55] for _ in range(120)]
    got = {(x["antecedents"], x["consequents"]): (x["itemset_count"], round(x["confidence"], 9), round(x["lift"], 9)) for x in r.mine_rules(lists(spark, rows), "items", 0.1, 0.4, 1.0).collect()}
    count = lambda s: sum(set(s) <= set(x) for x in rows)
    expected = {}
    for size in range(2, 6):
        for whole in itertools.combinations("abcde", size):
            if count(whole) / 120 < 0.1:
                continue
            for k in range(1, size):
                for left in itertools.combinations(whole, k):
                    right = tuple(x for x in whole if x not in left)
                    confidence, lift = count(whole) / count(left), count(whole) * 120 / (count(left) * count(right))
                    if confidence > 0.4 and lift > 1.0:
                        expected[", ".join(left), ", ".join(right)] = (count(whole), round(confidence, 9), round(lift, 9))
    assert got == expected


def test_rules_of_thirty_items_end(spark):
    """All splits of one itemset would be a billion; only those with one confident consequent are looked at."""
    items = [f"i{x:02d}" for x in range(30)]
    rows = [(items, 10), *[([x for x in items if x != y], 10 if y == "i00" else 100) for y in items], *[([x], 1000) for x in items]]
    df = spark.createDataFrame([(x, f, 2000, f / 2000, len(x)) for x, f in rows], "itemset array<string>, freq long, n long, support double, length int")
    got = [(x["consequents"], x["confidence"]) for x in r.generate_rules(df, 0.5, 0.0).collect()]
    assert got == [("i00", 1.0)]


def test_score_rules_with_tiers(spark):
    df = lists(spark, [["a", "b"]] * 2 + [["a"]] + [[]] * 7).withColumn("high", F.col("id").isin(0, *range(3, 10)))
    rule = spark.createDataFrame([("a", "b"), ("a", "zzz")], "antecedents string, consequents string")
    scored = {x["consequents"]: x for x in r.score_rules(rule, df, "items", F.col("high")).collect()}
    b = scored["b"]
    assert (b["support"], b["confidence"], b["lift"], b["high_tier_rate"]) == pytest.approx((0.2, 2 / 3, 10 / 3, 0.5)) and b["high_tier_lift"] == pytest.approx(0.625)
    assert scored["zzz"]["lift"] is None and scored["zzz"]["itemset_count"] == 0


def test_strict_technical_mining_keeps_all_rows(spark):
    rules = r.strict_technical_rules(lists(spark, [["python", "sql", "x"]] * 2 + [["x"]] * 98), "items", ["python", "sql"]).collect()
    assert {(x["antecedents"], x["consequents"]) for x in rules} == {("python", "sql"), ("sql", "python")}
    assert all(x["support"] == 0.02 and x["lift"] == pytest.approx(50) for x in rules)


def test_validation_reports_failures_and_ceiling(spark):
    rows = [["a", "b"], ["a", "b"], ["a", "b"], ["a"], ["a"], ["b"], ["b"], ["b"], [], []]
    train = spark.createDataFrame([("a", "b", 0.1, 0.6, 2.0), ("a", "q", 0.1, 0.6, 2.0)], "antecedents string, consequents string, support double, confidence double, lift double")
    got = {x["consequents"]: x for x in r.validate_rules(train, lists(spark, rows), "items", 0, 0.4).collect()}
    assert got["b"]["failure_reasons"] == "support, lift" and got["b"]["lift_ceiling_blocks_threshold"] is False and got["b"]["confidence_holds"]
    assert got["q"]["failure_reasons"] == "not measurable" and not got["q"]["validated"]
    more = rows[:8] + [["b"], ["b"]]
    assert r.validate_rules(train, lists(spark, more), "items", 0, 0.3).filter("consequents = 'b'").first()["lift_ceiling_blocks_threshold"]


def test_eligibility_before_denominator(spark):
    df = lists(spark, [["a", "b"], ["a", "b"], ["c", "d"], ["e", "f"], ["a"], []])
    row = r.evaluate_fixed_rules(spark.createDataFrame([("a", "b")], "antecedents string, consequents string"), df, "items").first()
    assert (row["n"], row["support"], row["confidence"], row["lift"]) == (4, 0.5, 1.0, 2.0)


def test_compare_rules_scores_the_disappeared(spark):
    schema = "antecedents string, consequents string, support double, confidence double, lift double"
    train = spark.createDataFrame([("a", "b", 0.1, 0.6, 2.0), ("a", "c", 0.1, 0.6, 2.0)], schema)
    live = spark.createDataFrame([("a", "b", 0.2, 0.7, 3.0), ("b", "c", 0.2, 0.7, 3.0)], schema)
    got = {(x["antecedents"], x["consequents"]): (x["status"], x["support_live"]) for x in r.compare_rules(train, live, lists(spark, [["a", "c"], ["a"], [], []]), "items").collect()}
    assert got == {("a", "b"): ("both", 0.2), ("a", "c"): ("disappeared_in_live", 0.25), ("b", "c"): ("new_in_live", 0.2)}


def test_jaccard_network_and_neighbourhood(spark):
    df = lists(spark, [["python", "sql"], ["python"], []])
    edge = g.jaccard_edges(df, "items").collect()
    assert [(x["a"], x["b"], x["jobs"], x["jaccard"]) for x in edge] == [("python", "sql", 1, 0.5)]
    assert g.jaccard_edges(df, "items", within=["python"]).count() == 0
    assert g.item_neighbourhood(df, "items", "sql").first()["jaccard"] == 0.5


def test_related_titles_need_shared_profile(spark):
    rows = [("x", ["a", "b", "c"])] * 30 + [("y", ["a", "b", "d"])] * 25 + [("z", ["q"])] * 40 + [("small", ["a", "b"])] * 5
    df = spark.createDataFrame(rows, "title string, items array<string>")
    assert sorted((x["title"], x["related"], x["shared"], x["jaccard"]) for x in g.related_titles(df, "title", "items").collect()) == [("x", "y", 2, 0.5), ("y", "x", 2, 0.5)]


def test_holm_step_down(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,)], "p double")
    assert sorted((x["p"], round(x["adjusted_p"], 9), x["rejected"]) for x in r.holm(df, "p").collect()) == [(0.01, 0.03, True), (0.03, 0.06, False), (0.04, 0.06, False)]
