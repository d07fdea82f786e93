"""Aggregations, distributions and comparisons over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import tier_between
from ..operators import aggregates as a
from ..operators.marts import source_reference
from ..operators.rules import shares_by_date
from ..operators.windows import company_cap
from ..scale import grouped_quantiles, md5_number, with_row
from ..sources.snapshots import latest_rows
from .base import (BASKET, EVENT_POSTS, POSTINGS, RAW_PAY, SNAPSHOTS, TIERS, baskets, cuts, event_posts, mining_jobs, order_tiers,
                    postings, r6, raw_pay, with_tier, yearly_snapshots)
from .registry import Tables, query


@query("G1", f"""
    WITH {TIERS}, c AS (SELECT tier, count(*) AS n FROM tiers GROUP BY 1)
    SELECT label AS tier, CAST(position AS INTEGER) AS position, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT sum(n) FROM c), 6) AS share
    FROM (VALUES ('Low', 0), ('Mid', 1), ('High', 2), ('Top', 3)) v(label, position) LEFT JOIN c ON tier = label""")
def tier_shares(t: Tables):
    shares = a.value_shares(order_tiers(t), "tier", [*K.TIER_LABELS, "Top"])
    return shares.withColumn("share", r6("share"))


@query("G2", f"""
    WITH {POSTINGS},{TIERS} SELECT experience_level, count(*) AS n, round(100.0 * count(*) FILTER (tier = 'Low') / count(*), 6) AS "Low",
           round(100.0 * count(*) FILTER (tier = 'Mid') / count(*), 6) AS "Mid", round(100.0 * count(*) FILTER (tier = 'High') / count(*), 6) AS "High"
    FROM postings JOIN tiers USING (job_id) GROUP BY 1""")
def experience_by_tier(t: Tables):
    table = a.crosstab(with_tier(postings(t)), "experience_level", "tier", K.TIER_LABELS, percent=True)
    return table.withColumns({c: r6(c) for c in K.TIER_LABELS})


@query("G3 G4", f"""
    WITH {POSTINGS} SELECT city, count(*) AS n, round(avg(salary), 4) AS mean, round(quantile_cont(salary, 0.5), 6) AS median FROM postings GROUP BY 1 HAVING count(*) >= 500""")
def salary_by_city(t: Tables):
    s = a.group_summary(postings(t).select("city", "salary"), ["city"], "salary", 500)
    return s.withColumns({"mean": F.round("mean", 4), "median": r6("median")})


@query("G5 S-12", f"""
    WITH {BASKET},{TIERS} SELECT item, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.5), 6) AS median,
           round(avg(CAST(tier = 'High' AS INTEGER)), 6) AS high_share FROM basket JOIN tiers USING (job_id) JOIN orders ON o_orderkey = job_id GROUP BY 1 HAVING count(*) >= 25""")
def salary_by_item(t: Tables):
    s = a.item_salaries(mining_jobs(t), "items", "salary", "tier", 25)
    return s.withColumns({"mean": F.round("mean", 4), "median": r6("median"), "high_share": r6("high_share")})


@query("G6", f"""
    WITH {EVENT_POSTS} SELECT fetch_date, count(DISTINCT company_name) AS companies, min(mean_salary) AS low, max(mean_salary) AS high,
           CAST(sum(CAST(mean_salary AS DECIMAL(18,2))) AS DOUBLE) AS total FROM posts GROUP BY 1""")
def daily_totals(t: Tables):
    return event_posts(t).groupBy("fetch_date").agg(F.countDistinct("company_name").alias("companies"), F.min("mean_salary").alias("low"), F.max("mean_salary").alias("high"),
                                                    F.sum(F.col("mean_salary").cast("decimal(18,2)")).cast("double").alias("total"))


@query("G7 G8 S-10", f"WITH {BASKET} SELECT item, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM basket GROUP BY 1")
def item_shares(t: Tables):
    return a.item_shares(baskets(t), "items").withColumn("share", r6("share"))


@query("G9", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(t: Tables):
    return a.top_n(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


@query("G10", """
    (SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5) UNION ALL
    (SELECT c_custkey, c_acctbal, 'bottom' AS side FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)""")
def balance_extremes(t: Tables):
    return a.both_ends(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 5, "c_custkey")


@query("G11", """
    SELECT kind, count(*) AS n FROM (SELECT 'order' AS kind, o_orderkey AS k FROM orders UNION ALL SELECT 'event', event_id FROM events UNION ALL SELECT 'document', doc_id FROM documents) GROUP BY 1""")
def stacked_keys(t: Tables):
    part = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), F.col(key).alias("k"))
    return part(t.orders, "order", "o_orderkey").unionByName(part(t.events, "event", "event_id")).unionByName(part(t.documents, "document", "doc_id")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("G12", """
    WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45)
    SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS shared, count(*) FILTER (b.k IS NULL) AS only_left, count(*) FILTER (a.k IS NULL) AS only_right FROM a FULL JOIN b ON a.k = b.k""")
def part_set_overlap(t: Tables):
    line = t.lineitem
    return a.key_set_overlap(line.filter(F.col("l_returnflag") == "R"), line.filter(F.col("l_quantity") > 45), "l_partkey")


@query("G13", """
    SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.025), 6) AS q025, round(quantile_cont(o_totalprice, 0.05), 6) AS q05, round(quantile_cont(o_totalprice, 0.5), 6) AS q50,
           round(quantile_cont(o_totalprice, 0.9), 6) AS q90, round(quantile_cont(o_totalprice, 0.99), 6) AS q99, max(o_totalprice) AS q100, count(*) AS n FROM orders GROUP BY 1""")
def quantiles_by_priority(t: Tables):
    names = ["q025", "q05", "q50", "q90", "q99", "q100"]
    q = grouped_quantiles(t.orders, "o_totalprice", [0.025, 0.05, 0.5, 0.9, 0.99, 1.0], ["o_orderpriority"], names, "n")
    return q.withColumns({c: r6(c) for c in names})


@query("G14", """
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT least(23, CAST(floor((value - lo) / (hi - lo) * 24) AS INTEGER)) AS bin, count(*) AS n FROM events, e GROUP BY 1),
    frame AS (SELECT CAST(unnest(range(-1, 25)) AS INTEGER) AS bin)
    SELECT f.bin, CASE WHEN f.bin BETWEEN 0 AND 23 THEN round(lo * (1 - f.bin / 24e0) + hi * (f.bin / 24e0), 6) END AS low,
           CASE WHEN f.bin BETWEEN 0 AND 23 THEN round(lo * (1 - (f.bin + 1) / 24e0) + hi * ((f.bin + 1) / 24e0), 6) END AS high, coalesce(n, 0) AS n FROM frame f LEFT JOIN b ON b.bin = f.bin, e""")
def value_histogram(t: Tables):
    return a.histogram(t.events, "value", 24).withColumns({"low": r6("low"), "high": r6("high")})


@query("G14", """
    WITH b AS (SELECT CASE WHEN value < 50 THEN -1 WHEN value > 250 THEN 10 ELSE least(9, CAST(floor((value - 50) / 200 * 10) AS INTEGER)) END AS bin, count(*) AS n FROM events GROUP BY 1)
    SELECT CAST(f.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(range(-1, 11)) AS bin) f LEFT JOIN b ON b.bin = f.bin""")
def value_histogram_with_domain(t: Tables):
    return a.histogram(t.events, "value", 10, 50.0, 250.0).select("bin", "n")


@query("G15", """
    WITH s AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events),
    e AS (SELECT max(value) FILTER (i = floor((n - 1) * 0.05)) AS lo, max(value) FILTER (i = ceil((n - 1) * 0.95)) AS hi FROM s),
    b AS (SELECT CASE WHEN value < lo THEN -1 WHEN value > hi THEN 20 ELSE least(19, CAST(floor((value - lo) / (hi - lo) * 20) AS INTEGER)) END AS bin, count(*) AS n FROM events, e GROUP BY 1)
    SELECT CAST(f.bin AS INTEGER) AS bin, coalesce(n, 0) AS n, lo, hi FROM (SELECT unnest(range(-1, 21)) AS bin) f LEFT JOIN b ON b.bin = f.bin, e""")
def central_value_histogram(t: Tables):
    ends = a.order_statistics(t.events, "value", 0.05, 0.95)
    return a.central_histogram(t.events, "value", 20).select("bin", "n", ends["lo"].alias("lo"), ends["hi"].alias("hi"))


@query("G16", """
    SELECT event_type, min(value) AS minimum, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS maximum
    FROM events GROUP BY 1""")
def box_stats_by_type(t: Tables):
    return a.box_stats(t.events, ["event_type"], "value").withColumns({c: r6(c) for c in ("q1", "median", "q3")})


@query("G17", """
    WITH r AS (SELECT l_quantity, l_extendedprice, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
                      rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
    SELECT round(corr(a, b), 6) AS spearman FROM r""")
def rank_correlation(t: Tables):
    return a.spearman(t.lineitem, "l_quantity", "l_extendedprice").withColumn("spearman", r6("spearman"))


@query("G18", """
    SELECT count(*) AS n, 0 AS missing, min(o_totalprice) AS minimum, max(o_totalprice) AS maximum, round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.5), 6) AS median,
           count(*) - count(DISTINCT o_orderkey) AS repeated_ids FROM orders""")
def salary_summary(t: Tables):
    return a.salary_summary(t.orders, "o_orderkey", "o_totalprice").withColumns({"mean": F.round("mean", 4), "median": r6("median")})


@query("G19", """
    WITH k AS (SELECT text AS k, CAST('0x' || substr(md5(doc_id || '|7'), 1, 8) AS BIGINT) % 5 > 0 AS train FROM documents),
    g AS (SELECT k, count(*) AS c, count(*) FILTER (train) AS tr FROM k WHERE k <> '' GROUP BY 1)
    SELECT CAST(sum(c) AS BIGINT) AS nonempty_rows, count(*) FILTER (c > 1) AS repeated_groups, CAST(coalesce(sum(c) FILTER (c > 1), 0) AS BIGINT) AS rows_in_repeated_groups,
           CAST(sum(c - 1) AS BIGINT) AS excess_rows, count(*) FILTER (tr > 0 AND tr < c) AS cross_split_groups,
           CAST(coalesce(sum(c - tr) FILTER (tr > 0 AND tr < c), 0) AS BIGINT) AS test_rows_with_train_group, max(c) AS largest_group FROM g""")
def document_overlap(t: Tables):
    return a.overlap_report(t.documents, F.when(F.col("text") != "", F.sha2("text", 256)), md5_number("doc_id", F.lit(7)) % 5 > 0)


@query("G20", f"""
    WITH {TIERS}, x AS (SELECT CASE WHEN l_extendedprice * 4 <= p33 THEN 'Low' WHEN l_extendedprice * 4 <= p66 THEN 'Mid' ELSE 'High' END AS tier FROM lineitem, cuts WHERE l_returnflag = 'A'),
    c AS (SELECT tier, count(*) AS n FROM x GROUP BY 1)
    SELECT label AS tier, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT sum(n) FROM c), 6) AS share FROM (VALUES ('Low'), ('Mid'), ('High')) v(label) LEFT JOIN c ON tier = label""")
def external_benchmark(t: Tables):
    external = t.lineitem.filter(F.col("l_returnflag") == "A").select((F.col("l_extendedprice") * 4).alias("pay"))
    placed = with_row(external, cuts(t.orders, "o_totalprice"))
    shares = a.value_shares(placed.select(tier_between("pay", F.col("p33"), F.col("p66")).alias("tier")), "tier", K.TIER_LABELS)
    return shares.select("tier", "n", r6("share").alias("share"))


@query("G20", f"""
    WITH {POSTINGS}, l AS (SELECT experience_level, quantile_cont(salary, 0.5) AS m FROM postings WHERE region = 'ASIA' AND experience_level <> '5-LOW' GROUP BY 1),
    r AS (SELECT experience_level, quantile_cont(salary, 0.5) AS m FROM postings WHERE region = 'EUROPE' AND experience_level <> '1-URGENT' GROUP BY 1)
    SELECT experience_level, round(l.m, 6) AS left_median, round(r.m, 6) AS right_median FROM l FULL JOIN r USING (experience_level)""")
def medians_of_two_sources(t: Tables):
    p = postings(t)
    left = p.filter((F.col("region") == "ASIA") & (F.col("experience_level") != "5-LOW"))
    right = p.filter((F.col("region") == "EUROPE") & (F.col("experience_level") != "1-URGENT"))
    m = a.medians_side_by_side(left, right, "experience_level", "salary", "salary")
    return m.withColumns({"left_median": r6("left_median"), "right_median": r6("right_median")})


@query("G21", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 75")
def order_page(t: Tables):
    return a.page(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3, 25).drop("o_orderdate")


@query("G22", f"""
    WITH {POSTINGS}, c AS (SELECT coalesce(CASE WHEN status <> 'P' THEN company_name END, 'Unrecorded') AS company_name, count(*) AS n FROM postings WHERE industry = 'MACHINERY' GROUP BY 1)
    SELECT company_name, n, round(n / (SELECT sum(n) FROM c), 6) AS share FROM c ORDER BY n DESC, company_name LIMIT 10""")
def top_employers(t: Tables):
    cohort = a.cohort(postings(t), industry="MACHINERY").withColumn("company_name", F.when(F.col("status") != "P", F.col("company_name")))
    return a.top_members(cohort, "company_name", 10).withColumn("share", r6("share"))


@query("G23", f"WITH {SNAPSHOTS} SELECT id, fetch_date FROM snapshots QUALIFY fetch_date = max(fetch_date) OVER (PARTITION BY company_name)")
def latest_snapshot_rows(t: Tables):
    return latest_rows(yearly_snapshots(t), by="company_name").select("id", "fetch_date")


@query("G24 J29", f"""
    WITH {SNAPSHOTS},
    capped AS (SELECT * FROM snapshots QUALIFY row_number() OVER (PARTITION BY fetch_date, company_name ORDER BY publication_date DESC, CAST(id AS VARCHAR)) <= 25),
    c AS (SELECT fetch_date, item AS skill, count(*) AS n FROM capped JOIN basket ON job_id = id GROUP BY ALL),
    top AS (SELECT skill FROM c WHERE fetch_date = (SELECT max(fetch_date) FROM snapshots) ORDER BY n DESC, skill LIMIT 8)
    SELECT fetch_date, skill, n, round(n / (SELECT count(*) FROM capped x WHERE x.fetch_date = c.fetch_date), 6) AS share FROM c WHERE skill IN (SELECT skill FROM top)""")
def item_share_by_snapshot(t: Tables):
    return shares_by_date(company_cap(yearly_snapshots(t), 25), "items", "fetch_date", 8).withColumn("share", r6("share"))


@query("G25 C13", f"""
    WITH {RAW_PAY} SELECT count(*) AS total, count(min_salary) AS with_min, count(max_salary) AS with_max, count(*) FILTER (min_salary IS NOT NULL AND max_salary IS NOT NULL) AS with_both,
           count(*) FILTER (min_salary IS NOT NULL AND max_salary IS NOT NULL AND normalized_salary IS NULL) AS estimated FROM raw_pay""")
def salary_availability(t: Tables):
    raw = raw_pay(t).withColumn("predicted", F.col("normalized_salary").isNull().cast("int"))
    return a.salary_availability(raw, "min_salary", "max_salary", "predicted")


@query("G26", f"""
    WITH {BASKET}, o AS (SELECT o_orderkey, o_orderstatus, count(item) AS k FROM orders LEFT JOIN basket ON job_id = o_orderkey GROUP BY ALL)
    SELECT CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'open' END AS source, count(*) AS n, round(avg(o_totalprice), 4) AS mean_words, round(avg(k), 6) AS mean_items
    FROM o JOIN orders USING (o_orderkey, o_orderstatus) WHERE o_orderstatus <> 'P' GROUP BY 1""")
def source_reference_stats(t: Tables):
    listed = baskets(t).join(t.orders.select(F.col("o_orderkey").alias("job_id"), "o_orderstatus", F.col("o_totalprice").alias("words")), "job_id")
    out = source_reference({"final": listed.filter("o_orderstatus = 'F'"), "open": listed.filter("o_orderstatus = 'O'")}, "words", "items")
    return out.withColumns({"mean_words": F.round("mean_words", 4), "mean_items": r6("mean_items")})

