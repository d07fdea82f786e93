"""How the given tables stand in for postings, and the same relations as SQL.

An order is a posting: its total is the salary, its priority the experience level, its
customer the company, the customer's segment the industry and nation the place; the
distinct brands of its parts are the items.  Events are dated postings, documents are
descriptions, pages are raw HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import lookup, tier_between
from ..scale import grouped_quantiles, materialise, with_row
from .registry import Tables

EXPERIENCE = {"1-URGENT": "Executive", "2-HIGH": "Director", "3-MEDIUM": "Mid-Senior level", "4-NOT SPECIFIED": "Unknown",
              "5-LOW": "Entry level"}


def postings(t: Tables) -> DataFrame:
    """One row per order with its customer's company, place and industry."""
    customer = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    joined = t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("company_id"), F.col("c_name").alias("company_name"),
        F.col("n_name").alias("city"), F.col("r_name").alias("region"), F.concat_ws(", ", "n_name", "r_name").alias("location"),
        F.col("c_mktsegment").alias("industry"), F.col("o_orderpriority").alias("experience_level"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("salary"), F.to_date("o_orderdate").alias("posted"),
        F.concat_ws(" ", F.lower("c_mktsegment"), F.lower(F.substring("o_orderpriority", 3, 20))).alias("title"))


POSTINGS = """
postings AS (
  SELECT o_orderkey AS job_id, o_custkey AS company_id, c_name AS company_name, n_name AS city, r_name AS region,
         n_name || ', ' || r_name AS location, c_mktsegment AS industry, o_orderpriority AS experience_level,
         o_orderstatus AS status, o_totalprice AS salary, CAST(o_orderdate AS DATE) AS posted,
         lower(c_mktsegment) || ' ' || lower(substr(o_orderpriority, 3)) AS title
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def basket_rows(t: Tables, item: str = "p_brand") -> DataFrame:
    """Distinct (job, item) of orders with lines."""
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("job_id"), F.col(item).alias("item")).distinct())


BASKET = """
basket AS (
  SELECT DISTINCT l_orderkey AS job_id, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey)"""


def item_lists(t: Tables, **columns: str) -> DataFrame:
    """Sorted distinct values of part columns per order, from one pass over the lines; orders without lines have empty lists."""
    lists = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
             .groupBy(F.col("l_orderkey").alias("job_id")).agg(*[F.array_sort(F.collect_set(c)).alias(name) for name, c in columns.items()]))
    joined = t.orders.select(F.col("o_orderkey").alias("job_id")).join(lists, "job_id", "left")
    return joined.withColumns({name: F.coalesce(name, F.array().cast("array<string>")) for name in columns})


def baskets(t: Tables, item: str = "p_brand", name: str = "items") -> DataFrame:
    """Sorted distinct items of every order; orders without lines have an empty list."""
    return item_lists(t, **{name: item})


def cuts(df: DataFrame, salary: str = "salary") -> DataFrame:
    """One row (p33, p66): the exact tier thresholds."""
    return grouped_quantiles(df, salary, [1 / 3, 2 / 3], names=["p33", "p66"])


def with_tier(df: DataFrame, salary: str = "salary", tier: str = "tier", thresholds: DataFrame | None = None) -> DataFrame:
    """Add the tier by exact thirds of the frame's own salaries, or by given thresholds."""
    placed = with_row(df, cuts(df, salary) if thresholds is None else thresholds)
    return placed.withColumn(tier, tier_between(salary, F.col("p33"), F.col("p66"))).drop("p33", "p66")


TIERS = """
cuts AS (SELECT quantile_cont(o_totalprice, 1/3) AS p33, quantile_cont(o_totalprice, 2/3) AS p66 FROM orders),
tiers AS (
  SELECT o_orderkey AS job_id, CASE WHEN o_totalprice <= p33 THEN 'Low' WHEN o_totalprice <= p66 THEN 'Mid' ELSE 'High' END AS tier
  FROM orders, cuts)"""


def order_tiers(t: Tables) -> DataFrame:
    """job_id, salary and tier of every order."""
    return with_tier(t.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_totalprice").alias("salary")))


def jobs(t: Tables) -> DataFrame:
    """Postings with tier and items; the thresholds come from the orders alone."""
    return with_tier(postings(t), thresholds=cuts(t.orders, "o_totalprice")).join(baskets(t), "job_id")


def mining_jobs(t: Tables) -> DataFrame:
    """job_id, salary, tier, items: what rule mining needs."""
    return order_tiers(t).join(baskets(t), "job_id")


JOBS = f"""{POSTINGS},{BASKET},{TIERS},
jobs AS (SELECT p.*, tier FROM postings p JOIN tiers USING (job_id))"""


def raw_pay(t: Tables) -> DataFrame:
    """Postings with raw pay fields and missing values, derived from the order's own columns."""
    p = postings(t)
    period = lookup("industry", {"AUTOMOBILE": "HOURLY", "BUILDING": "WEEKLY", "FURNITURE": "MONTHLY", "HOUSEHOLD": "yearly", "MACHINERY": "UNKNOWN"})
    part = lookup("industry", {"AUTOMOBILE": 2080.0, "BUILDING": 52.0, "FURNITURE": 12.0, "HOUSEHOLD": 1.0, "MACHINERY": 1.0})
    no_range = F.col("region") == "ASIA"
    return p.select(
        "job_id", "company_name", "title", "experience_level", "region", "posted",
        F.when(~no_range & (F.col("experience_level") != "5-LOW"), F.col("salary") / part * 0.75).alias("min_salary"),
        F.when(~no_range & (F.col("experience_level") != "4-NOT SPECIFIED"), F.col("salary") / part * 1.25).alias("max_salary"),
        F.when(no_range & (F.col("experience_level") != "1-URGENT"), F.col("salary") / part).alias("med_salary"),
        period.alias("pay_period"),
        F.when(F.col("region") == "EUROPE", "EUR").when(F.col("region") != "AFRICA", "USD").alias("currency"),
        F.when(F.col("status") != "F", F.col("salary")).alias("normalized_salary"))


RAW_PAY = f"""{POSTINGS},
raw_pay AS (
  SELECT job_id, company_name, title, experience_level, region, posted,
    CASE WHEN region <> 'ASIA' AND experience_level <> '5-LOW' THEN salary / part * 0.75e0 END AS min_salary,
    CASE WHEN region <> 'ASIA' AND experience_level <> '4-NOT SPECIFIED' THEN salary / part * 1.25e0 END AS max_salary,
    CASE WHEN region = 'ASIA' AND experience_level <> '1-URGENT' THEN salary / part END AS med_salary,
    CASE industry WHEN 'AUTOMOBILE' THEN 'HOURLY' WHEN 'BUILDING' THEN 'WEEKLY' WHEN 'FURNITURE' THEN 'MONTHLY'
                  WHEN 'HOUSEHOLD' THEN 'yearly' ELSE 'UNKNOWN' END AS pay_period,
    CASE WHEN region = 'EUROPE' THEN 'EUR' WHEN region <> 'AFRICA' THEN 'USD' END AS currency,
    CASE WHEN status <> 'F' THEN salary END AS normalized_salary
  FROM (SELECT *, CASE industry WHEN 'AUTOMOBILE' THEN 2080e0 WHEN 'BUILDING' THEN 52e0 WHEN 'FURNITURE' THEN 12e0 ELSE 1e0 END AS part
        FROM postings)),
formula AS (
  SELECT *, CASE WHEN min_salary IS NULL AND max_salary IS NULL THEN med_salary
                 ELSE (coalesce(min_salary, max_salary) + coalesce(max_salary, min_salary)) / 2 END
            * CASE upper(pay_period) WHEN 'HOURLY' THEN 2080 WHEN 'WEEKLY' THEN 52 WHEN 'BIWEEKLY' THEN 26 WHEN 'MONTHLY' THEN 12
                                     WHEN 'YEARLY' THEN 1 END AS computed
  FROM raw_pay),
annual AS (SELECT *, coalesce(normalized_salary, computed) AS annual_salary FROM formula)"""


def raw_lists(t: Tables) -> DataFrame:
    """Comma-separated part names of every order with lines, in three spellings."""
    name = F.col("p_name")
    spelled = (F.when(F.col("l_returnflag") == "A", name).when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), F.upper(F.replace(name, F.lit(" "), F.lit("  ")))))
               .otherwise(F.concat(F.lit("* "), F.replace(name, F.lit(" "), F.lit("-")), F.lit("."))))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_link"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("at"), spelled.alias("s"))
    return rows.groupBy("job_link").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda x: x["s"]), ",").alias("job_skills"))


RAW_LISTS = """
spelled AS (
  SELECT l_orderkey AS job_link,
         CASE l_returnflag WHEN 'A' THEN p_name WHEN 'R' THEN lower(p_name) ELSE '* ' || replace(p_name, ' ', '-') || '.' END AS raw
  FROM lineitem JOIN part ON l_partkey = p_partkey),
raw_items AS (SELECT DISTINCT job_link, raw FROM spelled)"""


def yearly_snapshots(t: Tables) -> DataFrame:
    """Orders as dated snapshots: fetched at the end of their year, published on their date, by their customer's nation."""
    p = postings(t).join(baskets(t), "job_id")
    return p.select(F.col("job_id").alias("id"), "title", F.col("city").alias("company_name"), "location", "salary", "items",
                    F.concat(F.year("posted").cast("string"), F.lit("-12-31")).alias("fetch_date"),
                    F.date_format("posted", "yyyy-MM-dd").alias("publication_date"))


SNAPSHOTS = f"""{POSTINGS},{BASKET},
snapshots AS (
  SELECT job_id AS id, title, city AS company_name, location, salary, year(posted) || '-12-31' AS fetch_date,
         strftime(posted, '%Y-%m-%d') AS publication_date
  FROM postings)"""


def event_posts(t: Tables) -> DataFrame:
    """Events as dated postings: the user is the company, the JSON payload holds a number."""
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("company_name"),
                           F.col("event_type").alias("job_title"), F.col("value").alias("mean_salary"),
                           F.get_json_object("props", "$.k").cast("int").alias("k"), "ts", F.date_format("ts", "yyyy-MM-dd").alias("fetch_date"))


EVENT_POSTS = """
posts AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS company_name, event_type AS job_title, value AS mean_salary,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts, strftime(ts, '%Y-%m-%d') AS fetch_date
  FROM events)"""


def descriptions(t: Tables) -> DataFrame:
    """Documents as postings: source is the company, language the title."""
    return t.documents.select(F.col("doc_id").alias("job_id"), F.col("source").alias("company_name"), F.col("lang").alias("title"),
                              F.col("text").alias("description"))


def predictions(t: Tables) -> DataFrame:
    """A fixed prediction per order: the tier of its lines' summed price, against the tier of its total."""
    priced = t.lineitem.groupBy(F.col("l_orderkey").alias("job_id")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("priced"))
    base = postings(t).join(priced, "job_id")
    tiered = with_tier(with_tier(materialise(base), "salary", "actual_tier"), "priced", "predicted_tier")
    return tiered.select("job_id", "company_name", "industry", "city", "experience_level", "salary", "priced", "status", "actual_tier", "predicted_tier")


PREDICTIONS = f"""{POSTINGS},
priced AS (SELECT l_orderkey AS job_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS priced FROM lineitem GROUP BY 1),
scored AS (SELECT p.*, priced FROM postings p JOIN priced USING (job_id)),
scored_cuts AS (SELECT quantile_cont(salary, 1/3) AS s33, quantile_cont(salary, 2/3) AS s66,
                       quantile_cont(priced, 1/3) AS g33, quantile_cont(priced, 2/3) AS g66 FROM scored),
predictions AS (
  SELECT job_id, company_name, industry, city, experience_level, salary, priced, status,
         CASE WHEN salary <= s33 THEN 'Low' WHEN salary <= s66 THEN 'Mid' ELSE 'High' END AS actual_tier,
         CASE WHEN priced <= g33 THEN 'Low' WHEN priced <= g66 THEN 'Mid' ELSE 'High' END AS predicted_tier
  FROM scored, scored_cuts)"""


def r6(column: Column | str) -> Column:
    """Six decimals: absorbs the last bits of floating-point sums."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)
