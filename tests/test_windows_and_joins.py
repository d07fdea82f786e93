"""Caps, de-duplication, joins and contracts on literal cases."""

import pytest
from pyspark.sql import functions as F

from paysift.operators import aggregates as a
from paysift.operators import contracts, joins, windows


def test_company_cap_orders_by_date_then_id_as_text(spark):
    rows = [("3", "2026-01-01", "X", "d"), ("2", "2026-02-01", "X", "d"), ("1", "2026-02-01", "X", "d"), ("10", None, "X", "d"), ("9", None, None, "d"), ("8", "2026-01-01", None, "d")]
    df = spark.createDataFrame(rows, "id string, publication_date string, company_name string, fetch_date string")
    assert sorted(r["id"] for r in windows.company_cap(df, 1).collect()) == ["1", "8"]
    assert sorted(r["id"] for r in windows.company_cap(df, 3).collect()) == ["1", "2", "3", "8", "9"]
    assert windows.company_cap(df, None).count() == 6


def test_company_cap_with_one_company_holding_most_rows(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 100).cast("string"))).alias("company_name"),
                                   F.lit("d").alias("fetch_date"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("publication_date"))
    kept = windows.company_cap(df, 25).groupBy("company_name").count().collect()
    assert all(r["count"] == 25 for r in kept) and len(kept) == 11


def test_drop_reposts_treats_missing_as_equal(spark):
    rows = [(1, "a", None, 5.0), (2, "a", None, 5.0), (3, "a", "t", 5.0), (4, "a", None, 6.0)]
    df = spark.createDataFrame(rows, "id long, company string, description string, salary double")
    kept = windows.drop_reposts(df, ["company", "description", "salary"], [F.col("id")], ["description"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 4]


def test_impute_by_group_falls_back_to_the_overall_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 8.0), (None, None)], "g string, v double")
    got = sorted((str(r["g"]), r["v"], r["imputed"]) for r in windows.impute_by_group(df, "v", "g").collect())
    assert got == [("None", 8.0, False), ("None", 8.0, True), ("a", 1.0, False), ("a", 2.0, True), ("a", 3.0, False), ("b", 3.0, True)]


def test_zscore_is_zero_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 5.0), ("c", 1.0), ("c", 3.0)], "g string, v double")
    got = sorted((r["g"], round(r["z"], 6)) for r in windows.group_zscore(df, F.col("v"), ["g"]).collect())
    assert got == [("a", 0.0), ("a", 0.0), ("b", 0.0), ("c", -0.707107), ("c", 0.707107)]


def test_merge_found_under_keeps_label_order(spark):
    df = spark.createDataFrame([("1", 0, "x"), ("1", 3, "a"), ("1", 5, "x"), ("2", 1, "b")], "id string, o int, cat string")
    got = {r["id"]: r["cats"] for r in windows.merge_found_under(df, "id", "o", "cat", "cats").collect()}
    assert got == {"1": ["x", "a"], "2": ["b"]}


def test_fill_from_takes_the_first_match(spark):
    left = spark.createDataFrame([(1, None, "USD"), (2, 5.0, None), (3, None, None)], "id int, v double, c string")
    right = spark.createDataFrame([(1, 7.0, "EUR", 1), (1, 9.0, "EUR", 2), (2, 6.0, "CAD", 1)], "id int, v double, c string, o int")
    got = {r["id"]: (r["v"], r["c"], r["filled_values"]) for r in joins.fill_from(left, right, "id", ["v", "c"], [F.col("o")]).collect()}
    assert got == {1: (7.0, "USD", 1), 2: (5.0, "CAD", 1), 3: (None, None, 0)}


def test_lookup_id_matches_null_with_null(spark):
    left = spark.createDataFrame([("a", None), ("a", "TX"), ("b", None)], "city string, state string")
    dim = spark.createDataFrame([(2, "a", None), (1, "a", None), (3, "a", "TX")], "id int, city string, state string")
    got = sorted((r["city"], str(r["state"]), r["id"]) for r in joins.lookup_id(left, dim, {"city": "city", "state": "state"}, "id").collect())
    assert got == [("a", "None", 1), ("a", "TX", 3), ("b", "None", None)]


def test_checked_join_refuses_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(contracts.ContractError):
        joins.checked_join(left, right, "k")


def test_key_violations_report_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "b")], "k int, d string")
    assert sorted((r["k"], r["n_rows"]) for r in contracts.key_violations(df, ["k", "d"]).collect()) == [(1, 2), (2, 1)]


def test_overlap_report_counts(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("", False), ("b", False)], "k string, train boolean")
    row = a.overlap_report(df, "k", F.col("train")).first().asDict()
    assert row == {"nonempty_rows": 4, "repeated_groups": 2, "rows_in_repeated_groups": 4, "excess_rows": 2, "cross_split_groups": 2, "test_rows_with_train_group": 2, "largest_group": 2}


def test_histogram_with_domain_and_degenerate_range(spark):
    df = spark.createDataFrame([(100.0,), (100000.0,), (900.0,)], "v double")
    got = {r["bin"]: r["n"] for r in a.histogram(df, "v", 2, 0.0, 100000.0).collect()}
    assert got == {-1: 0, 0: 2, 1: 1, 2: 0}
    flat = a.histogram(spark.createDataFrame([(5.0,), (5.0,)], "v double"), "v", 4).collect()
    assert sum(r["n"] for r in flat) == 2 and min(r["low"] for r in flat if r["low"] is not None) == 4.0


def test_item_salaries_count_a_posting_once_per_item(spark):
    df = spark.createDataFrame([(["a", "b", "a"], 100.0, "Low"), (["a"], 1000.0, "High"), ([], 5.0, "High")], "items array<string>, s double, t string")
    got = {r["item"]: (r["n"], r["median"], r["high_share"]) for r in a.item_salaries(df, "items", "s", "t").collect()}
    assert got == {"a": (2, 550.0, 0.5), "b": (1, 100.0, 0.0)}


def test_salary_lineage_keeps_texts_and_groups(spark):
    raw = spark.createDataFrame([("1", "c", "t", "62400.00"), ("2", "c", "u", ""), ("3", "c", "t", "62400.000")], "job_id string, company string, title string, normalized_salary string")
    kept = spark.createDataFrame([("1", "62400.0", "Low"), ("2", "5", "Low"), ("9", "7", "Low")], "job_id string, normalized_salary string, salary_tier string")
    rows = {r["job_id"]: r for r in contracts.salary_lineage(kept, raw, "job_id", ["company", "title"], ["normalized_salary"], "normalized_salary", "salary_tier", "job_id").collect()}
    assert (rows["1"]["source_record"], rows["1"]["group_size"], rows["1"]["representative"], rows["1"]["source_normalized_salary"]) == (1, 2, "1", "62400.00")
    assert (rows["2"]["group_size"], rows["2"]["salary_origin"], rows["2"]["within_tolerance"]) == (1, "unavailable", True)
    assert (rows["9"]["source_status"], rows["9"]["source_record"]) == ("unavailable", None)
