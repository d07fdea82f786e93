"""Caps, de-duplication, group transforms and ranks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as w
from ..operators.outliers import salary_mismatch
from ..operators.warehouse import snapshot_checks
from ..scale import top_per_key
from .base import POSTINGS, RAW_PAY, SNAPSHOTS, descriptions, event_posts, EVENT_POSTS, postings, r6, raw_pay, yearly_snapshots
from .registry import Tables, query


@query("H1 H2 S-18 S-20", f"""
    WITH {SNAPSHOTS} SELECT id, fetch_date FROM snapshots QUALIFY row_number() OVER (PARTITION BY fetch_date, company_name ORDER BY publication_date DESC, CAST(id AS VARCHAR)) <= 25""")
def company_capped_snapshots(t: Tables):
    return w.company_cap(yearly_snapshots(t), 25).select("id", "fetch_date")


@query("H3", f"""
    WITH {RAW_PAY}, m AS (SELECT experience_level, quantile_cont(normalized_salary, 0.5) FILTER (experience_level <> '5-LOW') AS gm FROM raw_pay GROUP BY 1)
    SELECT job_id, round(coalesce(k, gm, (SELECT quantile_cont(k, 0.5) FROM (SELECT CASE WHEN experience_level <> '5-LOW' THEN normalized_salary END AS k FROM raw_pay))), 6) AS salary, k IS NULL AS imputed
    FROM (SELECT *, CASE WHEN experience_level <> '5-LOW' THEN normalized_salary END AS k FROM raw_pay) LEFT JOIN m USING (experience_level)""")
def imputed_salaries(t: Tables):
    known = raw_pay(t).withColumn("salary", F.when(F.col("experience_level") != "5-LOW", F.col("normalized_salary")))
    return w.impute_by_group(known, "salary", "experience_level").select("job_id", r6("salary").alias("salary"), "imputed")


@query("H4", """
    SELECT p_brand, p_type, n, round(n / sum(n) OVER (PARTITION BY p_brand), 6) AS share FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)""")
def type_share_of_brand(t: Tables):
    counts = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return w.share_of_group(counts, ["p_brand"], "n").withColumn("share", r6("share"))


@query("H5 M19 S-17", f"""
    WITH {POSTINGS} SELECT job_id, round(coalesce((ln(salary) - avg(ln(salary)) OVER g) / nullif(stddev_samp(ln(salary)) OVER g, 0), 0), 5) AS z
    FROM postings WINDOW g AS (PARTITION BY city, experience_level)""")
def salary_z_scores(t: Tables):
    return salary_mismatch(postings(t), "salary", ["city", "experience_level"]).select("job_id", F.round("z", 5).alias("z"))


@query("H6 S-4", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_order_per_customer(t: Tables):
    kept = w.keep_first(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return kept.select("o_custkey", "o_orderkey", "o_totalprice")


@query("H7", """
    WITH f AS (SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY ALL), l AS (SELECT user_id, string_agg(event_type, '; ' ORDER BY o) AS found_under FROM f GROUP BY 1)
    SELECT user_id, event_id, value, found_under FROM events JOIN l USING (user_id) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def merged_categories(t: Tables):
    merged = w.merge_found_under(t.events.select("user_id", "event_id", "value", "event_type"), "user_id", "event_id", "event_type", "found")
    return merged.select("user_id", "event_id", "value", F.array_join("found", "; ").alias("found_under"))


@query("H8 S-5", "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1")
def documents_without_reposts(t: Tables):
    return w.drop_reposts(descriptions(t), ["title", "description"], [F.col("job_id")], ["description"]).select(F.col("job_id").alias("doc_id"))


@query("H9", """
    WITH c AS (SELECT n_name, p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
    SELECT n_name, p_name, n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY n_name ORDER BY n DESC, p_name) AS INTEGER) AS rank FROM c) WHERE rank <= 3""")
def top_parts_per_nation(t: Tables):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    counts = sold.groupBy("n_name", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counts, ["n_name"], [F.col("n").desc(), F.col("p_name")], 3, "rank")


@query("H10", f"""
    WITH {POSTINGS}, c AS (SELECT CASE WHEN status <> 'P' THEN location END AS location, count(*) AS n FROM postings GROUP BY 1)
    SELECT location, n, row_number() OVER (ORDER BY n DESC, location NULLS LAST) - 1 AS index FROM c""")
def location_index(t: Tables):
    places = postings(t).select(F.when(F.col("status") != "P", F.col("location")).alias("location"))
    return w.index_by_frequency(places, "location").withColumn("index", F.col("index").cast("bigint"))


@query("H10", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders")
def order_positions(t: Tables):
    return w.dense_index(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "position", 1).select("o_orderkey", F.col("position").cast("bigint").alias("position"))


@query("H12", "SELECT p_type, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) = 1")
def best_part_per_type(t: Tables):
    return w.best_candidate(t.part.select("p_type", "p_partkey", "p_retailprice"), "p_retailprice", "p_partkey", ["p_type"])


@query("F13", f"WITH {EVENT_POSTS} SELECT fetch_date, count(*) AS n_rows, round(avg(k), 6) AS avg_skills FROM posts GROUP BY 1")
def rows_per_snapshot(t: Tables):
    return snapshot_checks(event_posts(t), length="k").withColumn("avg_skills", r6("avg_skills"))
