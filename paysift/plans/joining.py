"""Joins over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..sources.readers import read_sql, scan_for_keys
from .base import BASKET, POSTINGS, baskets, postings
from .cleaning import PLACES, place_text
from .registry import Tables, query


@query("E2 U3", """
    WITH named AS (SELECT l_orderkey AS job_id, p_name, min(l_linenumber) AS line FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#9' GROUP BY ALL)
    SELECT o_orderkey AS job_id, coalesce(string_agg(p_name, '; ' ORDER BY line, p_name), '') AS items FROM orders LEFT JOIN named ON job_id = o_orderkey GROUP BY 1""")
def attached_item_lists(t: Tables):
    jobs = t.orders.select(F.col("o_orderkey").alias("job_id"))
    links = t.lineitem.select(F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("code"), F.col("l_linenumber").alias("line"))
    names = t.part.filter(F.col("p_brand") != "Brand#9").select(F.col("p_partkey").alias("code"), F.upper("p_name").alias("name"))
    return joins.attach_item_lists(jobs, links, names, "job_id", "code", "name", "line", "items").select("job_id", F.array_join("items", "; ").alias("items"))


@query("E3 U4", """
    WITH named AS (SELECT DISTINCT l_orderkey AS job_id, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 0)
    SELECT o_orderkey AS job_id, coalesce(string_agg(n_name, '; ' ORDER BY n_name), 'Unknown') AS industry FROM orders LEFT JOIN named ON job_id = o_orderkey GROUP BY 1""")
def attached_joined_names(t: Tables):
    jobs = t.orders.select(F.col("o_orderkey").alias("job_id"))
    links = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("job_id"), F.col("s_nationkey").alias("code"))
    names = t.nation.filter(F.col("n_regionkey") != 0).select(F.col("n_nationkey").alias("code"), F.concat(F.lit(" "), "n_name").alias("name"))
    return joins.attach_joined_names(jobs, links, names, "job_id", "code", "name")


@query("E4 E5 A4", """
    SELECT o_orderpriority, count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_lines,
           count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_lines FROM orders GROUP BY 1""")
def orders_with_and_without_lines(t: Tables):
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    light, heavy = scan_for_keys(t.orders, keys, "o_orderkey", ["o_orderpriority"], ["o_orderpriority", "o_totalprice"])
    kept = heavy.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("with_lines"))
    gone = joins.drop_known(light, keys, ["o_orderkey"]).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("without_lines"))
    return kept.join(gone, "o_orderpriority", "left").fillna(0, ["without_lines"])


@query("E6", "SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_totalprice)) AS latest_total FROM orders GROUP BY 1")
def latest_total_per_customer(t: Tables):
    return joins.latest_value(t.orders, "o_custkey", "o_orderdate", "o_totalprice").withColumnRenamed("o_totalprice", "latest_total")


@query("E7", "SELECT user_id, arg_min(value, ts) AS first_purchase FROM events WHERE event_type = 'purchase' GROUP BY 1")
def first_purchase_per_user(t: Tables):
    bought = t.events.withColumn("first_purchase", F.when(F.col("event_type") == "purchase", F.col("value")))
    return joins.first_value(bought, "user_id", "ts", "first_purchase")


@query("E9 S-5", f"""
    WITH {PLACES},
    dim AS (SELECT row_number() OVER (ORDER BY k) AS location_id, city, state FROM places WHERE city IS NOT NULL AND k <> 22)
    SELECT c_custkey, CAST(min(location_id) AS INTEGER) AS location_id FROM customer JOIN places p ON p.k = c_nationkey
    LEFT JOIN dim d ON d.city IS NOT DISTINCT FROM p.city AND d.state IS NOT DISTINCT FROM p.state GROUP BY 1""")
def looked_up_locations(t: Tables):
    from pyspark.sql import Window

    from ..functions.places import parse_location

    parsed = lambda key: parse_location(place_text(F.col(key)))
    places = t.nation.select("n_nationkey", parsed("n_nationkey").alias("p")).select("n_nationkey", "p.city", "p.state")
    known = places.filter(F.col("city").isNotNull() & (F.col("n_nationkey") != 22))
    dim = known.withColumn("location_id", F.row_number().over(Window.orderBy("n_nationkey")))  # one row per nation
    customers = t.customer.select("c_custkey", parsed("c_nationkey").alias("p")).select("c_custkey", "p.city", "p.state")
    return joins.lookup_id(customers, dim, {"city": "city", "state": "state"}, "location_id").select("c_custkey", "location_id")


@query("E10", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def checked_label_join(t: Tables):
    return joins.checked_join(t.labels, t.documents.select("doc_id", "lang"), "doc_id", "inner", one_to_one=True)


@query("E11", f"""
    WITH {POSTINGS},
    l AS (SELECT city, industry, count(*) AS n FROM postings WHERE status = 'F' GROUP BY ALL HAVING count(*) > 40),
    r AS (SELECT city, industry, count(*) AS n FROM postings WHERE status = 'O' GROUP BY ALL HAVING count(*) > 40)
    SELECT city, industry, l.n AS n_left, r.n AS n_right, CASE WHEN r.n IS NULL THEN 'only_left' WHEN l.n IS NULL THEN 'only_right' ELSE 'both' END AS status
    FROM l FULL JOIN r USING (city, industry)""")
def outer_status_of_groups(t: Tables):
    side = lambda s: postings(t).filter(F.col("status") == s).groupBy("city", "industry").agg(F.count(F.lit(1)).alias("n")).filter("n > 40")
    return joins.outer_status(side("F"), side("O"), ["city", "industry"], ["n"])


@query("E12", f"""
    WITH {BASKET} SELECT x.item AS a, y.item AS b, count(*) AS jobs FROM basket x JOIN basket y ON x.job_id = y.job_id AND x.item < y.item GROUP BY ALL""")
def item_pair_counts(t: Tables):
    return baskets(t).select(F.explode(joins.item_pairs("items")).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("jobs"))


@query("E15", f"""
    WITH {BASKET}, sets AS (SELECT DISTINCT a.p_brand AS x, b.p_brand AS y FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_brand < b.p_brand WHERE a.p_size = 7)
    SELECT x || ', ' || y AS itemset, count(*) AS jobs FROM sets JOIN basket p ON p.item = x JOIN basket q ON q.item = y AND q.job_id = p.job_id GROUP BY 1""")
def itemsets_held(t: Tables):
    seven = t.part.filter(F.col("p_size") == 7).groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("s"))
    sets = seven.select(F.explode(joins.item_pairs("s")).alias("p")).select(F.array("p.a", "p.b").alias("itemset")).distinct()
    return joins.containing(baskets(t), sets, "items", "itemset").groupBy(F.array_join("itemset", ", ").alias("itemset")).agg(F.count(F.lit(1)).alias("jobs"))


@query("A12 E13 E14", f"""
    WITH {POSTINGS} SELECT region, industry, count(*) AS jobs, round(avg(salary), 4) AS avg_salary FROM postings GROUP BY ALL""")
def sql_over_frames(t: Tables):
    return read_sql(t.spark, """
        SELECT r_name AS region, c_mktsegment AS industry, count(*) AS jobs, round(avg(o_totalprice), 4) AS avg_salary
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        GROUP BY ALL""", orders=t.orders, customer=t.customer, nation=t.nation, region=t.region)
