"""Published marts over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts as m
from ..operators import rules as r
from ..operators.aggregates import cohort
from ..operators.windows import dense_index
from ..scale import distinct_rows, materialise
from ..sources.sinks import export_market, export_titles, join_lists, to_facts_json
from .base import (BASKET, EVENT_POSTS, JOBS, POSTINGS, SNAPSHOTS, TIERS, baskets, event_posts, jobs, mining_jobs, postings, r6,
                   yearly_snapshots)
from .mining import FIXED, MASKS, checked, fixed_rules, high, typed_jobs
from .registry import Tables, query


def brand_vocabulary(t: Tables):
    """Brands of all parts with an index in name order."""
    names = t.part.select(F.col("p_brand").alias("item")).distinct()
    return dense_index(names, ["item"], "index").withColumn("index", F.col("index").cast("int"))


@query("N1 N2", f"""
    WITH {BASKET},{TIERS}, k AS (SELECT o_orderkey AS job_id, count(item) AS k FROM orders LEFT JOIN basket ON job_id = o_orderkey GROUP BY 1)
    SELECT count(*) AS n_jobs, count(*) FILTER (k = 0) AS zero_item_jobs, round(avg(k), 6) AS mean_items, CAST(sum(k) AS BIGINT) AS distinct_pairs, min(o_totalprice) AS salary_min, max(o_totalprice) AS salary_max,
      round(avg(o_totalprice), 4) AS salary_mean, count(*) FILTER (tier = 'Low') AS jobs_low, count(*) FILTER (tier = 'Mid') AS jobs_mid, count(*) FILTER (tier = 'High') AS jobs_high,
      round(quantile_cont(o_totalprice, 0.5), 6) AS salary_median, (SELECT count(DISTINCT p_brand) FROM part) AS vocabulary_size FROM k JOIN tiers USING (job_id) JOIN orders ON o_orderkey = job_id""")
def job_facts(t: Tables):
    facts = m.job_facts(mining_jobs(t), "items", "salary", "tier", t.part.select("p_brand").distinct())
    return facts.withColumns({"mean_items": r6("mean_items"), "salary_mean": F.round("salary_mean", 4), "salary_median": r6("salary_median")})


@query("N2", f"WITH {BASKET} SELECT job_id, item FROM basket")
def job_item_pairs(t: Tables):
    return m.item_fact(baskets(t), "job_id", "items")


@query("N3", f"""
    WITH {SNAPSHOTS}, k AS (SELECT fetch_date FROM snapshots QUALIFY row_number() OVER (PARTITION BY fetch_date, company_name ORDER BY publication_date DESC, CAST(id AS VARCHAR)) <= 25)
    SELECT fetch_date, count(*) AS n_rows, (SELECT count(*) FROM k WHERE k.fetch_date = s.fetch_date) AS capped_rows FROM snapshots s GROUP BY 1""")
def snapshot_mart(t: Tables):
    return m.snapshot_mart(yearly_snapshots(t).drop("items"), 25)


ROLES = f"""{JOBS}, roles AS (SELECT j.*, CASE WHEN status = 'P' THEN -1 ELSE CAST(substr(experience_level, 1, 1) AS INTEGER) END AS role_id, CASE WHEN status = 'P' THEN 'Unknown' ELSE substr(experience_level, 3) END AS role_name FROM jobs j)"""


def role_jobs(t: Tables):
    """Jobs with roles from saved labels; partial orders have no label."""
    base = materialise(jobs(t))
    labels = base.filter(F.col("status") != "P").select("job_id", F.substring("experience_level", 1, 1).alias("cluster"), F.substring("experience_level", 3, 30).alias("cluster_name"))
    return materialise(m.assign_roles(base, labels, "job_id", "cluster", "cluster_name"))


@query("N4", f"WITH {ROLES} SELECT job_id, role_id, role_name FROM roles")
def assigned_roles(t: Tables):
    return role_jobs(t).select("job_id", "role_id", "role_name")


@query("N5", f"""
    WITH {ROLES} SELECT role_id, count(*) AS n, round(avg(CAST(tier = 'High' AS INTEGER)), 6) AS high_share, round(quantile_cont(salary, 0.5), 6) AS median_salary FROM roles GROUP BY 1""")
def role_mart(t: Tables):
    return m.role_mart(role_jobs(t), "role_id", "salary", "tier").withColumns({"high_share": r6("high_share"), "median_salary": r6("median_salary")})


@query("N5 H9", f"""
    WITH {ROLES}, s AS (SELECT role_id, count(*) AS size FROM roles GROUP BY 1), c AS (SELECT role_id, item, count(*) AS n FROM roles JOIN basket USING (job_id) GROUP BY ALL), o AS (SELECT item, count(*) AS o FROM basket GROUP BY 1)
    SELECT role_id, CAST(row_number() OVER (PARTITION BY role_id ORDER BY n DESC, item) AS INTEGER) AS rank, item, n, round(n / size, 6) AS share, round(o / (SELECT count(*) FROM roles), 6) AS overall_share
    FROM c JOIN s USING (role_id) JOIN o USING (item) QUALIFY rank <= 8""")
def role_items(t: Tables):
    return m.role_items(role_jobs(t), "role_id", "items").withColumns({"share": r6("share"), "overall_share": r6("overall_share")})


@query("N6 C35", f"""
    WITH {BASKET}, c AS (SELECT item, count(*) AS n FROM basket GROUP BY 1), v AS (SELECT p_brand AS item, row_number() OVER (ORDER BY p_brand) - 1 AS index FROM (SELECT DISTINCT p_brand FROM part))
    SELECT item, CAST(index AS INTEGER) AS index, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM orders), 6) AS share,
           CASE WHEN item < 'Brand#2' THEN true WHEN item < 'Brand#5' THEN false END AS is_technical FROM v LEFT JOIN c USING (item)""")
def item_mart(t: Tables):
    vocabulary = brand_vocabulary(t)
    flags = vocabulary.select("item", F.when(F.col("item") < "Brand#2", "True").when(F.col("item") < "Brand#5", "false").otherwise("unclear").alias("is_technical"))
    return m.item_mart(baskets(t), "items", vocabulary, "item", flags).withColumn("share", r6("share"))


@query("N12 B10", f"""
    WITH {JOBS}, r AS (SELECT industry, row_number() OVER (ORDER BY industry) - 1 AS i FROM (SELECT DISTINCT industry FROM jobs)), l AS (SELECT location, row_number() OVER (ORDER BY count(*) DESC, location) - 1 AS i FROM jobs GROUP BY location),
    v AS (SELECT p_brand AS item, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part)), x AS (SELECT job_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS codes FROM basket JOIN v USING (item) GROUP BY 1)
    SELECT job_id, salary, CAST(r.i AS INTEGER) AS role_index, CAST(l.i AS INTEGER) AS location_index, coalesce(codes, '') AS item_indices, CASE tier WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END AS tier_index
    FROM jobs j JOIN r ON r.industry = j.industry JOIN l ON l.location = j.location LEFT JOIN x USING (job_id)""")
def encoded_rows(t: Tables):
    rows = m.encode_rows(materialise(jobs(t)), "job_id", "salary", "industry", "location", "items", "tier", brand_vocabulary(t), "item", "index")
    return rows.select("job_id", "salary", F.col("role_index").cast("int").alias("role_index"), F.col("location_index").cast("int").alias("location_index"),
                       F.array_join(F.col("item_indices").cast("array<string>"), ",").alias("item_indices"), "tier_index")


MARKET = f"""{EVENT_POSTS},{POSTINGS},{TIERS},
market AS (SELECT 'salaried' AS source, CAST(id AS VARCHAR) AS id, job_title AS title, company_name AS company, fetch_date AS date, CASE WHEN k >= 10 THEN mean_salary END AS salary,
    CASE WHEN k < 10 THEN 'unavailable' WHEN k > 60 THEN 'estimated' ELSE 'advertised' END AS salary_status FROM posts
  UNION ALL SELECT 'unsalaried', CAST(job_id AS VARCHAR), title, company_name, strftime(posted, '%Y-%m-%d'), NULL, 'unavailable' FROM postings)"""


def market(t: Tables):
    """Events as the salaried and orders as the unsalaried source, in one schema."""
    empty = F.array().cast("array<string>")
    salaried = event_posts(t).select(F.col("id").cast("string").alias("id"), "job_title", "company_name", F.lit(None).cast("string").alias("location"), "fetch_date", empty.alias("matched_skills"),
                                     F.when(F.col("k") >= 10, F.col("mean_salary")).alias("mean_salary"), (F.col("k") > 60).alias("salary_is_predicted"), F.lit("Low").alias("salary_tier"))
    unsalaried = postings(t).select(F.col("job_id").cast("string").alias("id"), F.col("title").alias("job_title"), "company_name", "location", F.date_format("posted", "yyyy-MM-dd").alias("fetch_date"), empty.alias("matched_skills"))
    return export_market(salaried, unsalaried)


@query("B11 N8 C37", f"WITH {MARKET} SELECT * FROM market")
def market_export(t: Tables):
    return market(t).select("source", "id", "title", "company", "date", "salary", "salary_status")


@query("N8 D1 G23", f"""
    WITH {MARKET} SELECT source, count(*) AS n, count(DISTINCT (id, date)) AS keys, max(date) AS latest, count(*) FILTER (date = (SELECT max(date) FROM market x WHERE x.source = market.source)) AS latest_rows FROM market GROUP BY 1""")
def posting_mart_keys(t: Tables):
    rows = materialise(market(t))
    days = rows.groupBy("source", "date").agg(F.count(F.lit(1)).alias("n"))
    latest = days.groupBy("source").agg(F.max("date").alias("latest"))
    counts = days.join(latest, "source").groupBy("source").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"),
                                                               F.coalesce(F.sum(F.when(F.col("date") == F.col("latest"), F.col("n"))), F.lit(0)).alias("latest_rows"))
    keys = distinct_rows(rows.filter("id IS NOT NULL AND date IS NOT NULL"), ["source", "id", "date"]).groupBy("source").agg(F.count(F.lit(1)).alias("keys"))
    return counts.join(keys, "source", "left").select("source", "n", F.coalesce("keys", F.lit(0)).cast("bigint").alias("keys"), "latest", "latest_rows")


@query("N9", f"""
    WITH {SNAPSHOTS}, k AS (SELECT id, fetch_date, count(item) AS k FROM snapshots LEFT JOIN basket ON job_id = id GROUP BY ALL)
    SELECT count(*) AS n_rows, round(avg(k), 6) AS mean_items, count(*) FILTER (k = 0) AS zero_rows, count(DISTINCT fetch_date) AS dates, min(fetch_date) AS first_date, max(fetch_date) AS last_date FROM k""")
def audit_counts(t: Tables):
    return m.audit_counts(yearly_snapshots(t), "items", "fetch_date").withColumn("mean_items", r6("mean_items"))


@query("N9 N13", f"""
    WITH {MASKS},{FIXED},{checked('t', "tier <> 'High'", '0.1')},{checked('v', "tier = 'High'", '0.1')}, x AS (SELECT v.*, t.confidence AS tc FROM v_checks v JOIN t_checks t USING (antecedents, consequents))
    SELECT count(*) AS rules, count(*) FILTER (s_ok AND c_ok AND l_ok) AS confirmed, count(*) FILTER (NOT (s_ok AND c_ok AND l_ok) AND max_lift <= 1.0) AS blocked_by_ceiling,
      count(*) FILTER (NOT (s_ok AND c_ok AND l_ok) AND max_lift > 1.0 AND max_lift < 2.2) AS little_headroom, count(*) FILTER (NOT (s_ok AND c_ok AND l_ok) AND max_lift > 1.0 AND max_lift < 2.2 AND confidence > tc) AS headroom_higher_confidence FROM x""")
def rule_audit(t: Tables):
    jobs_ = materialise(typed_jobs(t))
    trained = r.score_rules(fixed_rules(t), jobs_.filter(~high()), "items")
    return m.rule_audit(r.validate_rules(trained, jobs_.filter(high()), "items", 0, 0.1, 0.35, 1.0), 2.2, 1.0)


@query("N11 G22", f"""
    WITH {POSTINGS},{BASKET}, cohort AS (SELECT * FROM postings WHERE title = 'machinery low'), i AS (SELECT item, count(*) AS n FROM cohort JOIN basket USING (job_id) GROUP BY 1), l AS (SELECT location AS item, count(*) AS n FROM cohort GROUP BY 1)
    SELECT 'items' AS view, item AS name, n, round(n / (SELECT sum(n) FROM i), 6) AS share FROM (SELECT * FROM i ORDER BY n DESC, item LIMIT 8)
    UNION ALL SELECT 'locations', item, n, round(n / (SELECT sum(n) FROM l), 6) FROM (SELECT * FROM l ORDER BY n DESC, item LIMIT 8) UNION ALL SELECT 'size', 'n', count(*), 1.0 FROM cohort""")
def career_profile(t: Tables):
    everyone = postings(t).select("job_id", "title", "salary", "location", "company_name").join(baskets(t), "job_id")
    views = m.career_profile(cohort(everyone, title="machinery low"), everyone, "title", "machinery low", "items", "salary", "location", "company_name")
    part = lambda view, name: views[view].select(F.lit(view).alias("view"), F.col(name).alias("name"), "n", r6("share").alias("share"))
    size = views["size"].select(F.lit("size").alias("view"), F.lit("n").alias("name"), "n", F.lit(1.0).alias("share"))
    return part("items", "item").unionByName(part("locations", "location")).unionByName(size)


@query("N13 C26 J30", f"""
    WITH {POSTINGS}, c AS (SELECT city, count(*) AS n FROM postings GROUP BY 1 ORDER BY n DESC, city LIMIT 1)
    SELECT count(*) AS postings, round(avg(CAST(posted >= DATE '2001-06-30' - 90 AS INTEGER)), 6) AS recent_share, count(DISTINCT postings.city) AS companies, strftime(min(posted), '%Y-%m-%d') AS first_published,
      strftime(max(posted), '%Y-%m-%d') AS last_published, any_value(c.city) AS top_company, round(any_value(c.n) / count(*), 6) AS top_company_share FROM postings, c""")
def key_numbers(t: Tables):
    out = m.key_numbers(postings(t), "posted", F.to_date(F.lit("2001-06-30")), "city")
    return out.select("postings", r6("recent_share").alias("recent_share"), "companies", F.date_format("first_published", "yyyy-MM-dd").alias("first_published"),
                      F.date_format("last_published", "yyyy-MM-dd").alias("last_published"), "top_company", r6("top_company_share").alias("top_company_share"))


@query("B9", """
    SELECT o_orderkey, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '","share":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '0.5' END || '}' AS fact FROM orders""")
def facts_json(t: Tables):
    facts = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(0.5).alias("share"))
    return to_facts_json(facts).select(F.get_json_object("fact", "$.id").cast("bigint").alias("o_orderkey"), "fact")


@query("B6", f"WITH {BASKET} SELECT o_orderkey AS job_id, coalesce(string_agg(item, '; ' ORDER BY item), '') AS items FROM orders LEFT JOIN basket ON job_id = o_orderkey GROUP BY 1")
def joined_lists(t: Tables):
    return join_lists(baskets(t), ["items"])


@query("B12", f"""
    WITH {POSTINGS}, e AS (SELECT job_id FROM postings WHERE status <> 'P' UNION ALL SELECT -1), m AS (SELECT job_id, CASE WHEN industry = 'BUILDING' THEN ' ' ELSE title END AS title, company_name FROM postings)
    SELECT coalesce(m.job_id, e.job_id) AS job_id, title, company_name, m.job_id IS NOT NULL AND e.job_id IS NOT NULL AND trim(coalesce(title, '')) <> '' AS valid FROM m FULL JOIN e ON e.job_id = m.job_id""")
def title_export(t: Tables):
    base = postings(t)
    meta = base.select("job_id", F.when(F.col("industry") == "BUILDING", " ").otherwise(F.col("title")).alias("title"), "company_name")
    exported = base.filter("status <> 'P'").select("job_id").unionByName(t.region.agg(F.min(F.lit(-1)).cast("bigint").alias("job_id")))
    return export_titles(meta, exported, title="title")


