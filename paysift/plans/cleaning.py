"""Text, salary, place and date cleaning over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, places, text, values
from ..operators.aggregates import cohort
from ..operators.vocabulary import load_item_lists
from ..sources.readers import parse_list_column
from .base import (BASKET, EVENT_POSTS, POSTINGS, RAW_LISTS, RAW_PAY, SNAPSHOTS, baskets, event_posts, postings, r6, raw_lists, raw_pay,
                   yearly_snapshots)
from .registry import Tables, query


@query("C1 C33 S-22", """
    SELECT doc_id, md5(norm) AS norm_md5, length(text) AS n_chars,
           CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS n_words
    FROM (SELECT doc_id, text, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS norm FROM documents)""")
def normalised_texts(t: Tables):
    d = t.documents
    return d.select("doc_id", F.md5(text.normalise_text("text")).alias("norm_md5"), F.length("text").alias("n_chars"), text.word_count("text").alias("n_words"))


@query("C2 C3 I1", f"""
    WITH {RAW_LISTS},
    firsts AS (
      SELECT l_orderkey AS job_link, min((l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS place,
             CASE l_returnflag WHEN 'A' THEN p_name WHEN 'R' THEN lower(p_name) ELSE '* ' || replace(p_name, ' ', '-') || '.' END AS raw
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT job_link, string_agg(raw, '; ' ORDER BY place) AS items, count(*) AS n_items FROM firsts GROUP BY 1""")
def clean_item_lists(t: Tables):
    lists = load_item_lists(raw_lists(t), "job_link", "job_skills", "job_skills", "items")
    return lists.select("job_link", text.join_items("items").alias("items"), F.size("items").cast("bigint").alias("n_items"))


@query("C4 C5 C6", f"""
    WITH {RAW_LISTS}
    SELECT raw, count(*) AS n, regexp_replace(regexp_replace(lower(raw), '^[^a-z0-9]+', ''), '[^a-z0-9+#]+$', '') AS form,
           regexp_replace(lower(raw), '[^a-z0-9+#]', '', 'g') AS item_key, NOT regexp_matches(raw, '[^\\x00-\\x7F]') AS ascii
    FROM raw_items GROUP BY raw""")
def item_spellings(t: Tables):
    items = raw_lists(t).select(F.explode(text.split_clean("job_skills")).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    return items.select("raw", "n", text.clean_form("raw").alias("form"), text.item_key("raw").alias("item_key"), text.is_ascii("raw").alias("ascii"))


@query("C7", """
    SELECT p_type AS skill, '(?<![a-z0-9])(?:' || string_agg(replace(replace(p_name, ' ', '[\\s\\-]*'), '+', '\\+'), '|' ORDER BY p_name) || ')(?![a-z0-9])' AS pattern
    FROM (SELECT DISTINCT p_type, p_name FROM part) GROUP BY p_type""")
def phrase_patterns(t: Tables):
    forms = t.part.groupBy(F.col("p_type").alias("skill")).agg(F.array_sort(F.collect_set("p_name")).alias("forms"))
    return forms.select("skill", text.form_pattern("forms").alias("pattern"))


@query("C8 C9 S-21", """
    SELECT lang, count(*) AS n,
      sum(CAST(regexp_matches(lower(text), '(^|[^a-z0-9])(?:the|la|die)\\s*(?:,|/|;|\\bor\\b|\\band\\b)\\s*of($|[^a-z0-9&+#\\-])|(^|[^a-z0-9&])of\\s*(?:,|/|;|\\bor\\b|\\band\\b)\\s*(?:the|la|die)') AS BIGINT)) AS listed,
      sum(CAST(regexp_matches(lower(text), '(^|[^a-z0-9])(?:was|que)(?:[^a-z0-9.]|[^a-z0-9.][^.]{0,38}[^a-z0-9.])with($|[^a-z0-9])|(^|[^a-z0-9])with(?:[^a-z0-9.]|[^a-z0-9.][^.]{0,38}[^a-z0-9.])(?:was|que)($|[^a-z0-9])') AS BIGINT)) AS near
    FROM documents GROUP BY lang""")
def context_patterns(t: Tables):
    lower = F.lower("text")
    # `of` in a list next to an article; `with` at most 40 characters from `was` or `que` in one sentence.
    listed = r"(?<![a-z0-9])(?:the|la|die)\s*(?:,|/|;|\bor\b|\band\b)\s*of(?![a-z0-9&+#\-])|(?<![a-z0-9&])of\s*(?:,|/|;|\bor\b|\band\b)\s*(?:the|la|die)"
    near = r"\b(?:was|que)\b[^.]{0,40}?\bwith\b|\bwith\b[^.]{0,40}?\b(?:was|que)\b".replace(r"\b", "(?:(?<![a-z0-9])(?=[a-z0-9])|(?<=[a-z0-9])(?![a-z0-9]))")
    return t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(lower.rlike(listed)).alias("listed"),
                                           F.count_if(lower.rlike(near)).alias("near"))


@query("C10", """
    SELECT doc_id, md5(regexp_replace(text, 'the\\s+of|of\\s+the', ' ', 'g')) AS blanked FROM documents""")
def phrases_blanked(t: Tables):
    return t.documents.select("doc_id", F.md5(text.blank_phrases("text", r"the\s+of|of\s+the")).alias("blanked"))


@query("C11 C12 S-3", f"""
    WITH {RAW_PAY} SELECT job_id, annual_salary FROM annual""")
def annualised_pay(t: Tables):
    return raw_pay(t).select("job_id", values.annualise("normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period").alias("annual_salary"))


@query("C15 S-1 S-2", f"""
    WITH {RAW_PAY},
    reasons AS (SELECT currency, CASE WHEN annual_salary IS NULL AND min_salary IS NULL THEN 'no salary'
                                      WHEN currency IS NOT NULL AND currency <> 'USD' THEN 'non-USD'
                                      WHEN coalesce(annual_salary < 10000, false) OR coalesce(annual_salary > 1000000, false) THEN 'implausible' END AS reason
                FROM annual)
    SELECT coalesce(reason, 'kept') AS reason, currency, count(*) AS n FROM reasons GROUP BY ALL""")
def salary_filter_reasons(t: Tables):
    annual = raw_pay(t).withColumn("annual", values.annualise("normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period"))
    reason = F.coalesce(values.salary_drop_reason("annual", "min_salary", "currency"), F.lit("kept"))
    return annual.groupBy(reason.alias("reason"), "currency").agg(F.count(F.lit(1)).alias("n"))


@query("C13 C16 S-7", f"""
    WITH {RAW_PAY}
    SELECT job_id, (min_salary + max_salary) / 2 AS mean_salary, min_salary IS NOT NULL AND max_salary IS NOT NULL AS has_salary,
           CASE WHEN annual_salary <= 62400 THEN 'Low' WHEN annual_salary <= 109200 THEN 'Mid' WHEN annual_salary IS NOT NULL THEN 'High' END AS tier
    FROM annual""")
def fixed_salary_tiers(t: Tables):
    annual = values.annualise("normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period")
    both = F.col("min_salary").isNotNull() & F.col("max_salary").isNotNull()
    return raw_pay(t).select("job_id", values.mean_if_both("min_salary", "max_salary").alias("mean_salary"), both.alias("has_salary"),
                             values.fixed_tier(annual).alias("tier"))


@query("C17", """
    SELECT c_custkey, CAST(CASE WHEN c <= 0 THEN 0 WHEN c <= 10 THEN 1 WHEN c <= 50 THEN 2 WHEN c <= 200 THEN 3 WHEN c <= 500 THEN 4 WHEN c <= 1000 THEN 5
                                WHEN c <= 5000 THEN 6 WHEN c <= 10000 THEN 7 ELSE 8 END AS INTEGER) AS size_class
    FROM (SELECT c_custkey, floor(c_acctbal) AS c FROM customer)""")
def company_size_classes(t: Tables):
    return t.customer.select("c_custkey", values.ordinal_bucket(F.floor("c_acctbal")).alias("size_class"))


# Location texts by nation number (with what they parse to in the SQL below).
PLACE_TEXTS = ["Austin, TX", "New York, New York, United States", "Texas, United States", "Greater Boston", "Dallas-Fort Worth Metroplex",
               "San Francisco Bay Area", "United States", "Columbus, Ohio Metropolitan Area", "Seattle, Washington", "WA", "Reno, nv",
               "Paris, France", "Greater Chicago, IL", "Juneau, AK, United States", "Remote", "Wyoming", "Puerto Rico, United States", "Ohio Area",
               "Miami, FL", "Kansas City Metropolitan Area", " Boise , ID ", "Erie, PA, Extra", "Lincoln, Nebraska", "Oslo", "Salem, OR"]
PLACES = """
places(k, raw, city, state, kind, any_state) AS (VALUES
  (0, 'Austin, TX', 'Austin', 'TX', 'city', 'TX'), (1, 'New York, New York, United States', 'New York', 'NY', 'city', 'NY'),
  (2, 'Texas, United States', NULL, 'TX', 'state', 'TX'), (3, 'Greater Boston', NULL, NULL, 'metro', NULL),
  (4, 'Dallas-Fort Worth Metroplex', NULL, NULL, 'metro', NULL), (5, 'San Francisco Bay Area', NULL, NULL, 'metro', NULL),
  (6, 'United States', NULL, NULL, 'country', NULL), (7, 'Columbus, Ohio Metropolitan Area', 'Columbus', 'OH', 'metro', NULL),
  (8, 'Seattle, Washington', 'Seattle', 'WA', 'city', 'WA'), (9, 'WA', NULL, 'WA', 'state', 'WA'), (10, 'Reno, nv', 'Reno', 'NV', 'city', 'NV'),
  (11, 'Paris, France', 'Paris', NULL, 'city', NULL), (12, 'Greater Chicago, IL', 'Greater Chicago', 'IL', 'metro', 'IL'),
  (13, 'Juneau, AK, United States', 'Juneau', 'AK', 'city', 'AK'), (14, 'Remote', NULL, NULL, 'metro', NULL), (15, 'Wyoming', NULL, 'WY', 'state', 'WY'),
  (16, 'Puerto Rico, United States', NULL, 'PR', 'state', 'PR'), (17, 'Ohio Area', NULL, 'OH', 'state', NULL), (18, 'Miami, FL', 'Miami', 'FL', 'city', 'FL'),
  (19, 'Kansas City Metropolitan Area', NULL, NULL, 'metro', NULL), (20, ' Boise , ID ', 'Boise', 'ID', 'city', 'ID'),
  (21, 'Erie, PA, Extra', 'Erie', NULL, 'city', 'PA'), (22, 'Lincoln, Nebraska', 'Lincoln', 'NE', 'city', 'NE'), (23, 'Oslo', NULL, NULL, 'metro', NULL),
  (24, 'Salem, OR', 'Salem', 'OR', 'city', 'OR'))"""


def place_text(nation):
    """The location text of a nation number."""
    return F.get(F.array(*[F.lit(p) for p in PLACE_TEXTS]), nation)


@query("C18", f"""
    WITH {PLACES} SELECT c_custkey, city, state, 'United States' AS country, kind AS location_type FROM customer JOIN places ON k = c_nationkey""")
def parsed_locations(t: Tables):
    return t.customer.select("c_custkey", places.parse_location(place_text(F.col("c_nationkey"))).alias("p")).select("c_custkey", "p.*")


@query("C19 C20 C21", f"""
    WITH {PLACES}
    SELECT c_custkey, a.any_state AS own_state, coalesce(a.any_state, b.any_state) AS first_state, coalesce(b.any_state, a.any_state) AS posting_state
    FROM customer JOIN places a ON a.k = c_nationkey JOIN places b ON b.k = 24 - c_nationkey""")
def location_states(t: Tables):
    a, b = place_text(F.col("c_nationkey")), place_text(24 - F.col("c_nationkey"))
    return t.customer.select("c_custkey", places.extract_state(a).alias("own_state"), places.first_state(F.array(a, b)).alias("first_state"),
                             places.posting_state(F.array(F.lit("US"), b), a).alias("posting_state"))


@query("C22", f"""
    WITH {POSTINGS}
    SELECT job_id, CASE experience_level WHEN '1-URGENT' THEN 'Executive' WHEN '2-HIGH' THEN 'Director'
                        WHEN '3-MEDIUM' THEN CASE WHEN status = 'F' THEN 'Senior' ELSE 'Mid-Senior' END
                        WHEN '5-LOW' THEN 'Entry' ELSE CASE WHEN status = 'F' THEN 'Senior' ELSE 'Unknown' END END AS experience
    FROM postings""")
def mapped_experience(t: Tables):
    level = values.lookup("experience_level", {"1-URGENT": "Executive", "2-HIGH": "Manager", "3-MEDIUM": "Mid Level", "5-LOW": "Entry Level"}, "Other")
    extra = F.when(F.col("status") == "F", "Senior Level").otherwise("None of these")
    levels = F.when(F.col("experience_level") == "3-MEDIUM", F.array(extra, level)).otherwise(F.array(level, extra))
    from .. import constants as K

    return postings(t).select("job_id", values.first_mapped(levels, K.LEVEL_TO_EXPERIENCE).alias("experience"))


@query("C23 C24", """
    SELECT o_orderkey, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_id, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
           dayname(d) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_columns(t: Tables):
    ms = t.orders.select("o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"))
    return ms.select("o_orderkey", *dates.date_parts(dates.epoch_ms_to_date("ms")))


@query("C25 C26", f"""
    WITH {SNAPSHOTS}
    SELECT fetch_date, count(*) AS n, round(avg(CAST(CAST(publication_date AS DATE) >= CAST(fetch_date AS DATE) - 90 AS INTEGER)), 6) AS recent_share,
           round(avg(CAST(year(CAST(publication_date AS DATE)) = year(CAST(fetch_date AS DATE)) AS INTEGER)), 6) AS same_year_share
    FROM snapshots GROUP BY 1""")
def recent_share_by_snapshot(t: Tables):
    stamped = yearly_snapshots(t).withColumn("published", F.to_date(dates.date_prefix(F.concat("publication_date", F.lit("T08:00:00Z")))))
    fetched = F.to_date("fetch_date")
    return stamped.groupBy("fetch_date").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(dates.is_recent("published", fetched).cast("int"))).alias("recent_share"),
                                             r6(F.avg(dates.same_year("published", fetched).cast("int"))).alias("same_year_share"))


@query("C27", f"""
    WITH {EVENT_POSTS},
    dated AS (SELECT CASE WHEN job_title = 'error' THEN fetch_date || 'x' ELSE fetch_date END AS day FROM posts),
    aged AS (SELECT day, CASE WHEN length(day) = 10 AND CAST(substr(day, 1, 10) AS DATE) <= DATE '2024-01-25' THEN DATE '2024-01-25' - CAST(substr(day, 1, 10) AS DATE) END AS age FROM dated)
    SELECT day, CAST(age AS INTEGER) AS age_days, CASE WHEN age IS NULL THEN 'unknown' WHEN age > 20 THEN 'stale' ELSE 'fresh' END AS label, count(*) AS n
    FROM aged GROUP BY ALL""")
def snapshot_freshness(t: Tables):
    day = F.when(F.col("job_title") == "error", F.concat("fetch_date", F.lit("x"))).otherwise(F.col("fetch_date"))
    today = F.to_date(F.lit("2024-01-25"))
    dated = event_posts(t).withColumn("day", day)
    return dated.groupBy("day", dates.snapshot_age("day", today).alias("age_days"), dates.snapshot_label("day", today, 20).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("C28 U2", """
    SELECT page_id, md5(plain) AS text_md5, CASE WHEN plain = '' THEN 0 ELSE len(string_split(plain, ' ')) END AS n_words
    FROM (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(
            regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
            '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS plain FROM pages)""")
def page_texts(t: Tables):
    plain = t.pages.select("page_id", text.html_to_text("html").alias("plain"))
    return plain.select("page_id", F.md5("plain").alias("text_md5"), text.word_count("plain").alias("n_words"))


@query("C29", """
    SELECT page_id, sha256(trim(regexp_replace(lower(regexp_replace(replace(replace(replace(replace(html, '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&'),
           '<[^>]+>', ' ', 'g')), '\\s+', ' ', 'g'))) AS description_key FROM pages""")
def page_description_keys(t: Tables):
    return t.pages.select("page_id", text.text_hash(text.normalised_description("html")).alias("description_key"))


@query("C30 C31 C32", """
    SELECT doc_id, sha256(text) AS exact_key, sha256(regexp_replace(regexp_replace(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), 'https?://\\S+', '<url>', 'g'),
           '\\d+(?:[.,]\\d+)*', '<num>', 'g')) AS template_key, lower(trim(source)) || '|' || lower(trim(lang)) AS company_title FROM documents""")
def document_keys(t: Tables):
    masked = text.masked_template(text.normalise_text("text"))
    return t.documents.select("doc_id", text.text_hash("text").alias("exact_key"), text.text_hash(masked).alias("template_key"),
                              text.pair_key("source", "lang").alias("company_title"))


@query("C32 H13 D16", f"""
    WITH {RAW_PAY},
    keyed AS (SELECT job_id, sha256('[' || coalesce('"' || experience_level || '"', 'null') || ',' || coalesce('"' || currency || '"', 'null') || ',"' || region || '"]') AS k FROM raw_pay)
    SELECT job_id, k AS repost_group, count(*) OVER (PARTITION BY k) AS group_size, min(job_id) OVER (PARTITION BY k) AS representative FROM keyed""")
def repost_groups(t: Tables):
    from ..operators.contracts import repost_stats

    return repost_stats(raw_pay(t), ["experience_level", "currency", "region"], "job_id").select("job_id", "repost_group", "group_size", "representative")


@query("C34", f"""
    WITH {BASKET}, lists AS (SELECT o_orderkey AS job_id, list(item) FILTER (item IS NOT NULL) AS items FROM orders LEFT JOIN basket ON job_id = o_orderkey GROUP BY 1)
    SELECT job_id, CAST(coalesce(len(items), 0) AS INTEGER) AS n_items, coalesce(list_contains(items, 'Brand#7'), false) AS has_seven,
           coalesce(list_contains(items, 'Brand#7') AND list_contains(items, 'Brand#3'), false) AS has_both FROM lists""")
def basket_predicates(t: Tables):
    wanted = F.array(F.lit("Brand#7"), F.lit("Brand#3"))
    return baskets(t).select("job_id", F.size("items").alias("n_items"), F.array_contains("items", "Brand#7").alias("has_seven"),
                             (F.size(F.array_except(wanted, F.col("items"))) == 0).alias("has_both"))


@query("C35 C36", """
    SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS strict_flag,
           event_type IN ('click', 'error') AS lenient_flag, CASE WHEN event_type IN ('purchase', 'view') THEN value END AS number
    FROM events""")
def parsed_flags(t: Tables):
    flag = values.lookup("event_type", {"click": "True", "view": " false ", "error": "1", "signup": "yes"})
    token = F.coalesce(values.lookup("event_type", {"click": "NaN", "error": "-inf", "signup": "true"}), F.col("value").cast("string"))
    return t.events.select("event_id", values.strict_bool(flag).alias("strict_flag"), values.lenient_bool(flag).alias("lenient_flag"),
                           values.finite_or_null(token).alias("number"))


@query("C37 G25", f"""
    WITH {EVENT_POSTS}
    SELECT CASE WHEN k < 10 THEN 'unavailable' WHEN k > 60 THEN 'estimated' ELSE 'advertised' END AS status, count(*) AS n FROM posts GROUP BY 1""")
def salary_statuses(t: Tables):
    status = values.salary_status(F.when(F.col("k") >= 10, F.col("mean_salary")), F.col("k") > 60)
    return event_posts(t).groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("C38", f"""
    WITH {POSTINGS} SELECT job_id FROM postings WHERE contains(lower(title || ' ' || company_name || ' ' || location || ' '), 'nation_1, amer')""")
def posting_search(t: Tables):
    found = text.contains_text("NATION_1, Amer", "title", "company_name", "location")
    return postings(t).filter(found).select("job_id")


@query("C39", f"""
    WITH {POSTINGS},{BASKET}
    SELECT p.job_id, salary FROM postings p JOIN basket b USING (job_id) WHERE industry = 'BUILDING' AND region = 'ASIA' AND item = 'Brand#5'""")
def cohort_rows(t: Tables):
    joined = postings(t).join(baskets(t), "job_id")
    return cohort(joined, "items", "Brand#5", industry="BUILDING", region="ASIA", title=None).select("job_id", "salary")


@query("C14 C41", f"""
    WITH {RAW_PAY}
    SELECT job_id, coalesce(currency, 'Unknown') AS currency, round(ln(annual_salary), 6) AS log_salary, round(sqrt(annual_salary), 6) AS root_salary,
           round(greatest(abs(annual_salary - 100000), 1000), 6) AS clipped_gap FROM annual""")
def filled_and_scaled(t: Tables):
    annual = raw_pay(t).withColumn("a", values.annualise("normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period"))
    gap = F.when(F.col("a").isNotNull(), F.greatest(F.abs(F.col("a") - 100000), F.lit(1000.0))).otherwise(F.lit(1000.0))
    return annual.select("job_id", F.coalesce("currency", F.lit("Unknown")).alias("currency"), r6(F.ln("a")).alias("log_salary"),
                         r6(F.sqrt("a")).alias("root_salary"), r6(gap).alias("clipped_gap"))


@query("C42", "SELECT page_id, replace(replace(url, 'example', '***'), 'page', '***') AS url FROM pages")
def scrubbed_urls(t: Tables):
    return t.pages.select("page_id", text.scrub("url", ["example", "", "page"]).alias("url"))


@query("C44 A10 A11", f"""
    WITH {BASKET} SELECT job_id, string_agg(item, ', ' ORDER BY item) AS itemset, count(*) AS n FROM basket GROUP BY 1""")
def parsed_itemsets(t: Tables):
    lists = baskets(t).filter(F.size("items") > 0)
    literal = F.concat(F.lit("['"), F.array_join(F.reverse("items"), "', '"), F.lit("']"))
    parsed = lists.select("job_id", parse_list_column(literal).alias("l"))
    again = text.parse_itemset(F.array_join(F.concat("l", F.slice("l", 1, 1)), " ,"))
    return parsed.select("job_id", F.array_join(again, ", ").alias("itemset"), F.size(again).cast("bigint").alias("n"))


@query("E1 S-4", f"""
    WITH {RAW_PAY},
    fills AS (SELECT region, min(min_salary) AS f FROM raw_pay WHERE pay_period = 'WEEKLY' GROUP BY 1)
    SELECT job_id, coalesce(min_salary, f) AS min_salary, CAST(min_salary IS NULL AND f IS NOT NULL AS INTEGER) AS filled_values
    FROM raw_pay LEFT JOIN fills USING (region)""")
def filled_from_table(t: Tables):
    from ..operators.joins import fill_from

    raw = raw_pay(t)
    fills = raw.filter(F.col("pay_period") == "WEEKLY").groupBy("region").agg(F.min("min_salary").alias("min_salary"))
    return fill_from(raw, fills, "region", ["min_salary"]).select("job_id", "min_salary", "filled_values")


