"""Star schema and OLAP over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import warehouse as w
from ..scale import materialise
from .base import JOBS, cuts, item_lists, postings, r6, with_tier
from .cleaning import PLACES, place_text
from .registry import Tables, query

KINDS = {"matched_skills": "extracted", "skills_list": "category"}


def star_jobs(t: Tables, listed: bool = True):
    """Postings with brands as extracted items, part types as categories, and a missing company for partial orders.

    Without `listed` the item lists are left out, for queries that need none.
    """
    placed = with_tier(postings(t), tier="salary_tier", thresholds=cuts(t.orders, "o_totalprice"))
    nations = t.nation.select(F.col("n_name").alias("city"), place_text(F.col("n_nationkey")).alias("place"))
    p = placed.join(nations, "city").select(
        "job_id", F.when(F.col("status") != "P", F.col("company_id")).alias("company_id"), "company_name", "industry", "experience_level",
        F.col("salary").alias("normalized_salary"), F.col("posted").alias("date"), F.col("place").alias("location"), "salary_tier")
    lists = item_lists(t, matched_skills="p_brand", skills_list="p_type") if listed else t.orders.select(F.col("o_orderkey").alias("job_id"))
    return p.join(lists, "job_id")


def star(t: Tables):
    """(jobs, dim_items, dim_location, fact)."""
    jobs = materialise(star_jobs(t))
    items, places = w.build_dim_items(jobs, KINDS), w.build_dim_location(jobs)
    return jobs, items, places, materialise(w.build_fact(jobs, items, places, KINDS))


STAR = f"""{JOBS},{PLACES},
category AS (SELECT DISTINCT l_orderkey AS job_id, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey),
dim_items AS (
  SELECT row_number() OVER (ORDER BY kind, skill_name) AS skill_id, skill_name, CASE kind WHEN 0 THEN 'extracted' ELSE 'category' END AS skill_type
  FROM (SELECT DISTINCT 0 AS kind, item AS skill_name FROM basket UNION SELECT DISTINCT 1, item FROM category)),
dim_location AS (SELECT row_number() OVER (ORDER BY raw) AS location_id, raw AS location_raw, city, state, 'United States' AS country, kind AS location_type
  FROM places JOIN nation ON n_nationkey = k WHERE n_name IN (SELECT city FROM jobs)),
items AS (SELECT job_id, skill_id FROM basket JOIN dim_items ON skill_name = item AND skill_type = 'extracted'
          UNION ALL SELECT job_id, skill_id FROM category JOIN dim_items ON skill_name = item AND skill_type = 'category'),
fact AS (
  SELECT j.job_id, i.skill_id, l.location_id, CASE WHEN status <> 'P' THEN company_id ELSE 0 END AS company_id,
         CAST(strftime(posted, '%Y%m%d') AS INTEGER) AS time_id, tier AS salary_tier, experience_level, salary AS normalized_salary
  FROM jobs j JOIN nation n ON n.n_name = j.city JOIN places p ON p.k = n_nationkey JOIN dim_location l ON l.location_raw = p.raw LEFT JOIN items i USING (job_id)),
v_jobs AS (SELECT DISTINCT job_id, location_id, company_id, time_id, salary_tier, experience_level, normalized_salary FROM fact)"""


@query("F1", f"WITH {STAR} SELECT CAST(skill_id AS INTEGER) AS skill_id, skill_name, skill_type FROM dim_items")
def item_dimension(t: Tables):
    return w.build_dim_items(star_jobs(t).select("matched_skills", "skills_list"), KINDS).withColumn("skill_id", F.col("skill_id").cast("int"))


@query("F2", f"WITH {STAR} SELECT CAST(location_id AS INTEGER) AS location_id, location_raw, city, state, country, location_type FROM dim_location")
def location_dimension(t: Tables):
    return w.build_dim_location(star_jobs(t, False)).withColumn("location_id", F.col("location_id").cast("int"))


@query("F3 E8", """
    WITH used AS (SELECT DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_custkey ELSE 0 END AS company_id FROM orders),
    posted AS (SELECT o_custkey AS company_id, 'Posted ' || arg_min(o_orderkey, o_orderkey) AS company_name FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    latest AS (SELECT user_id AS company_id, arg_max(CAST(floor(value) AS BIGINT), ts) AS employee_count FROM events GROUP BY 1)
    SELECT company_id, CASE WHEN company_id = 0 THEN 'Unknown' ELSE coalesce(c_name, p.company_name) END AS company_name, c_nationkey AS company_size, employee_count
    FROM used LEFT JOIN customer ON c_custkey = company_id AND c_acctbal > 0 LEFT JOIN posted p USING (company_id) LEFT JOIN latest USING (company_id)""")
def company_dimension(t: Tables):
    companies = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("company_size"))
    counts = t.events.select(F.col("user_id").alias("company_id"), F.floor("value").alias("employee_count"), F.col("ts").alias("time_recorded"))
    posted = t.orders.select(F.col("o_orderkey").alias("job_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("company_id"),
                             F.concat(F.lit("Posted "), F.col("o_orderkey").cast("string")).alias("company_name"))
    return w.build_dim_company(companies, counts, posted).select("company_id", "company_name", "company_size", "employee_count")


@query("F4", """
    SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_id, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def time_dimension(t: Tables):
    return w.build_dim_time(t.orders, "o_orderdate")


@query("F5", """
    WITH dim AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 0)
    SELECT DISTINCT l_orderkey AS job_id, n_nationkey AS industry_id, n_name AS industry_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim ON s_nationkey = n_nationkey
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def industry_bridge(t: Tables):
    dim, bridge = industry_tables(t)
    return bridge.join(dim, "industry_id").select("job_id", "industry_id", "industry_name")


def industry_tables(t: Tables, status: str | None = "F"):
    """Supplier nations outside the first region as industries of an order."""
    industries = t.nation.select(F.col("n_nationkey").alias("industry_id"), F.when(F.col("n_regionkey") != 0, F.concat(F.lit(" "), "n_name")).alias("industry_name"))
    links = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("job_id"), F.col("s_nationkey").alias("industry_id"))
    jobs = t.orders if status is None else t.orders.filter(F.col("o_orderstatus") == status)
    return w.build_industry_tables(industries, links, jobs.select(F.col("o_orderkey").alias("job_id")))


@query("F6", f"WITH {STAR} SELECT job_id, CAST(skill_id AS INTEGER) AS skill_id, CAST(location_id AS INTEGER) AS location_id, company_id, time_id, salary_tier, experience_level, normalized_salary FROM fact")
def fact_table(t: Tables):
    fact = star(t)[3]
    return fact.withColumns({"skill_id": F.col("skill_id").cast("int"), "location_id": F.col("location_id").cast("int")})


@query("F7 S-12", f"WITH {STAR} SELECT salary_tier, count(*) AS jobs, round(avg(normalized_salary), 4) AS avg_salary FROM v_jobs GROUP BY 1")
def job_view(t: Tables):
    jobs = star_jobs(t, False)
    return w.job_rows(jobs, w.build_dim_location(jobs)).groupBy("salary_tier").agg(F.count(F.lit(1)).alias("jobs"), F.round(F.avg("normalized_salary"), 4).alias("avg_salary"))


@query("F8 S-14 S-15", f"""
    WITH {STAR} SELECT s.skill_name, count(*) AS jobs, round(100.0 * count(*) / (SELECT count(*) FROM v_jobs), 6) AS pct_of_jobs, round(avg(f.normalized_salary), 4) AS avg_salary,
           round(100.0 * avg(CAST(f.salary_tier = 'High' AS INTEGER)), 6) AS pct_high_tier
    FROM fact f JOIN dim_items s USING (skill_id) WHERE s.skill_type = 'extracted' GROUP BY 1 ORDER BY jobs DESC, s.skill_name LIMIT 10""")
def olap_top_items(t: Tables):
    jobs, items, _, fact = star(t)
    top = w.top_items(fact, items, jobs)
    return top.select("skill_name", "jobs", r6("pct_of_jobs").alias("pct_of_jobs"), F.round("avg_salary", 4).alias("avg_salary"), r6("pct_high_tier").alias("pct_high_tier"))


@query("F9", f"""
    WITH {STAR} SELECT experience_level, count(*) AS jobs, round(avg(normalized_salary), 4) AS avg_salary, min(normalized_salary) AS min_salary, max(normalized_salary) AS max_salary,
           round(100.0 * avg(CAST(salary_tier = 'Low' AS INTEGER)), 6) AS pct_low, round(100.0 * avg(CAST(salary_tier = 'Mid' AS INTEGER)), 6) AS pct_mid,
           round(100.0 * avg(CAST(salary_tier = 'High' AS INTEGER)), 6) AS pct_high FROM v_jobs GROUP BY 1""")
def olap_by_experience(t: Tables):
    out = w.pay_by_experience(star_jobs(t, False))
    return out.withColumns({"avg_salary": F.round("avg_salary", 4), **{f"pct_{x}": r6(f"pct_{x}") for x in ("low", "mid", "high")}})


@query("F10 S-24", f"""
    WITH {STAR}, dim AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 0),
    bridge AS (SELECT DISTINCT l_orderkey AS job_id, n_nationkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim ON s_nationkey = n_nationkey)
    SELECT n_name AS industry_name, state, count(*) AS jobs, round(avg(normalized_salary), 4) AS avg_salary
    FROM v_jobs JOIN bridge USING (job_id) JOIN dim_location USING (location_id) WHERE state IS NOT NULL GROUP BY ALL ORDER BY jobs DESC, industry_name, state LIMIT 15""")
def olap_industry_state(t: Tables):
    # Stored steps: a chain of joins in one stage would hold the sorts of all of them.
    jobs = materialise(star_jobs(t, False))
    places = materialise(w.build_dim_location(jobs))
    dim, bridge = industry_tables(t, None)
    out = w.pay_by_industry_and_state(w.job_rows(jobs, places), bridge, dim, places)
    return out.withColumn("avg_salary", F.round("avg_salary", 4))


@query("F11", f"WITH {STAR} SELECT location_type, count(*) AS locations, count(*) FILTER (state IS NULL) AS without_state FROM dim_location GROUP BY 1")
def location_kinds(t: Tables):
    return w.location_kinds(w.build_dim_location(star_jobs(t, False)))


@query("F11", f"""
    WITH {STAR} SELECT count(*) FILTER (state IS NULL) AS jobs_without_state, count(*) FILTER (company_id = 0) AS jobs_unknown_company,
           count(*) FILTER (company_id = 0 OR company_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS jobs_without_size,
           strftime(min(strptime(CAST(time_id AS VARCHAR), '%Y%m%d')), '%Y-%m-%d') AS first_date, strftime(max(strptime(CAST(time_id AS VARCHAR), '%Y%m%d')), '%Y-%m-%d') AS last_date
    FROM v_jobs JOIN dim_location USING (location_id)""")
def dimension_checks(t: Tables):
    jobs, _, places, fact = star(t)
    companies = t.customer.filter((F.col("c_acctbal") > 0) & (F.col("c_custkey") != 0)).select(F.col("c_custkey").alias("company_id"), F.col("c_nationkey").alias("company_size"))
    return w.dimension_checks(w.job_view(fact), places, companies, w.build_dim_time(jobs))


def live_posts(t: Tables):
    """Orders of the second half as live postings: half of them salaried, some unknown companies and places."""
    j = star_jobs(t)
    salaried = F.col("experience_level") != "4-NOT SPECIFIED"
    from ..functions.places import extract_state

    return j.filter(F.year("date") >= 1998).select(
        F.col("job_id").alias("id"), "location", F.upper("company_name").alias("company_name"), extract_state("location").alias("state"), F.col("date").alias("created"),
        salaried.alias("has_salary"), "salary_tier", F.col("normalized_salary").alias("mean_salary"), F.lit("2026-01-01").alias("fetch_date"), "matched_skills")


LIVE = f"""{STAR},
companies AS (SELECT c_custkey AS company_id, lower(c_name) AS name FROM customer WHERE c_acctbal > 0),
live AS (
  SELECT j.job_id, (SELECT min(location_id) FROM dim_location d WHERE lower(d.city) = lower(trim(split_part(p.raw, ',', 1))) AND d.state IS NOT DISTINCT FROM p.any_state) AS location_id,
         coalesce(c.company_id, 0) AS company_id, experience_level <> '4-NOT SPECIFIED' AS has_salary, tier, salary, posted
  FROM jobs j JOIN nation n ON n.n_name = j.city JOIN places p ON p.k = n_nationkey LEFT JOIN companies c ON c.name = lower(j.company_name) WHERE year(posted) >= 1998),
live_fact AS (SELECT l.*, i.skill_id FROM live l LEFT JOIN (SELECT job_id, skill_id FROM basket JOIN dim_items ON skill_name = item AND skill_type = 'extracted') i USING (job_id))"""


@query("F12 A13", f"""
    WITH {LIVE} SELECT job_id, CAST(location_id AS INTEGER) AS location_id, company_id, CAST(strftime(posted, '%Y%m%d') AS INTEGER) AS time_id, CASE WHEN has_salary THEN tier END AS salary_tier,
           CASE WHEN has_salary THEN salary END AS normalized_salary, CAST(has_salary AS INTEGER) AS has_salary, CAST(skill_id AS INTEGER) AS skill_id FROM live_fact""")
def live_fact(t: Tables):
    return loaded_live_fact(t).select("job_id", F.col("location_id").cast("int").alias("location_id"), "company_id", "time_id", "salary_tier", "normalized_salary", "has_salary",
                                      F.col("skill_id").cast("int").alias("skill_id"))


def loaded_live_fact(t: Tables):
    """The live fact against the star's dimensions."""
    _, items, places, _ = star(t)
    companies = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))
    return w.load_live_fact(live_posts(t), items, places, companies)


@query("F13", f"""
    WITH {LIVE}, per_job AS (SELECT job_id, count(*) AS r, max(CAST(has_salary AS INTEGER)) AS s, max(location_id) AS l, max(company_id) AS c FROM live_fact GROUP BY 1)
    SELECT CAST(sum(r) AS BIGINT) AS n_rows, CAST(sum(r * s) AS BIGINT) AS rows_with_salary, count(*) AS jobs, CAST(sum(s) AS BIGINT) AS jobs_with_salary,
           count(l) AS jobs_matched_location, count(*) FILTER (c <> 0) AS jobs_matched_company FROM per_job""")
def live_fact_checks(t: Tables):
    return w.live_fact_checks(loaded_live_fact(t))


@query("F14 J1", f"""
    WITH {STAR}, per_job AS (SELECT v.job_id, string_agg(item, ', ' ORDER BY item) AS items FROM v_jobs v LEFT JOIN basket USING (job_id) GROUP BY 1)
    SELECT job_id, coalesce(items, '') AS items FROM per_job""")
def baskets_from_fact(t: Tables):
    _, items, _, fact = star(t)
    return w.fact_baskets(fact, items).select("job_id", F.array_join("items", ", ").alias("items"))
