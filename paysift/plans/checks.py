"""Contracts, profiles and lineage over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values
from ..operators import contracts
from ..scale import md5_number, with_row
from ..session import scratch_path
from ..sources.sinks import file_fingerprints
from .base import BASKET, JOBS, RAW_PAY, TIERS, basket_rows, baskets, cuts, order_tiers, postings, r6, raw_pay, with_tier
from .registry import TABLE_NAMES, Tables, query


@query("D1", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_line_keys(t: Tables):
    return contracts.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("D2", "SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def dangling_users(t: Tables):
    bad = contracts.foreign_key_violations(t.events, t.supplier, "user_id", "s_suppkey")
    return bad.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("D3", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY 1")
def unknown_event_types(t: Tables):
    return contracts.domain_violations(t.events, "event_type", ["click", "view", "purchase"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("D4", """
    SELECT l_orderkey AS job_id, count(*) AS n_items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) <> count(DISTINCT p_brand)""")
def lists_with_repeats(t: Tables):
    lists = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("job_id")).agg(F.collect_list("p_brand").alias("items"))
    return contracts.repeated_items(lists, "items").select("job_id", F.size("items").cast("bigint").alias("n_items"))


@query("D5", f"""
    WITH {BASKET} SELECT item, count(*) AS uses FROM basket WHERE item NOT IN (SELECT p_brand FROM part WHERE p_brand < 'Brand#2') GROUP BY 1""")
def items_outside_vocabulary(t: Tables):
    vocabulary = t.part.filter(F.col("p_brand") < "Brand#2").select(F.col("p_brand").alias("item")).distinct()
    return contracts.unknown_items(baskets(t), "items", vocabulary, "item")


@query("D6", f"""
    WITH l AS (SELECT l_orderkey AS k, max(l_linestatus) AS status, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY 1)
    SELECT count(*) AS compared, count(*) FILTER (abs(o_totalprice - CAST(price AS DOUBLE)) > 100000) AS differ_price, count(*) FILTER (o_orderstatus <> status) AS differ_status
    FROM orders JOIN l ON k = o_orderkey""")
def totals_against_lines(t: Tables):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("status"),
                                                                   F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"))
    orders = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return contracts.disagreements(orders, lines, "k", ["price"], ["status"], 100000.0)


@query("D7", """
    WITH l AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
    stored AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N' OR p_brand > 'Brand#2' GROUP BY 1),
    again AS (SELECT p_brand, count(*) AS n FROM l WHERE p_brand < 'Brand#8' GROUP BY 1)
    SELECT count(*) FILTER (s.n = a.n) AS equal, count(*) FILTER (s.n <> a.n) AS different, count(*) FILTER (a.n IS NULL) AS only_stored,
           count(*) FILTER (s.n IS NULL) AS only_recomputed FROM stored s FULL JOIN again a USING (p_brand)""")
def reconciled_item_counts(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    stored = lines.filter((F.col("l_returnflag") != "N") | (F.col("p_brand") > "Brand#2")).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    again = basket_rows(t).filter(F.col("item") < "Brand#8").groupBy(F.col("item").alias("p_brand")).agg(F.count(F.lit(1)).alias("n"))
    return contracts.reconcile(stored, again, ["p_brand"], ["n"])


@query("D8 S-23", f"""
    WITH {RAW_PAY}, c AS (SELECT count(*) AS n, {", ".join(f"count({c}) AS {c}" for c in ("job_id", "company_name", "experience_level", "min_salary", "max_salary", "med_salary", "currency", "normalized_salary"))} FROM raw_pay)
    {" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{d}' AS dtype, n - {c} AS nulls, round((n - {c}) * 100.0 / n, 6) AS null_pct FROM c" for c, d in (("job_id", "bigint"), ("company_name", "string"), ("experience_level", "string"), ("min_salary", "double"), ("max_salary", "double"), ("med_salary", "double"), ("currency", "string"), ("normalized_salary", "double")))}""")
def null_report(t: Tables):
    columns = ["job_id", "company_name", "experience_level", "min_salary", "max_salary", "med_salary", "currency", "normalized_salary"]
    report = contracts.null_report(raw_pay(t).select(*columns))
    return report.select(F.col("column").alias("column_name"), "dtype", "nulls", r6("null_pct").alias("null_pct"))


@query("D9", """
    SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang, n_chars)""")
def duplicate_documents(t: Tables):
    return contracts.duplicate_rows(t.documents.select(F.sha2("text", 256).alias("text"), "lang", "n_chars"))


@query("D11", """
    SELECT count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS minimum, max(o_totalprice) AS maximum,
           round(quantile_cont(o_totalprice, 0.25), 6) AS q25, round(quantile_cont(o_totalprice, 0.5), 6) AS q50, round(quantile_cont(o_totalprice, 0.75), 6) AS q75 FROM orders""")
def described_totals(t: Tables):
    d = contracts.describe_number(t.orders, "o_totalprice")
    return d.select("n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "minimum", "maximum", *[r6(q).alias(q) for q in ("q25", "q50", "q75")])


@query("D12", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLE_NAMES))
def table_counts(t: Tables):
    return contracts.table_counts({n: getattr(t, n) for n in TABLE_NAMES})


@query("D13 M13", """
    SELECT doc_id, lang FROM documents ORDER BY CAST('0x' || substr(md5(doc_id || '|42'), 1, 8) AS BIGINT), doc_id LIMIT 100""")
def sampled_documents(t: Tables):
    return contracts.seeded_sample(t.documents.select("doc_id", "lang"), "doc_id", 100, 42)


@query("D14")
def file_hashes(t: Tables):
    return file_fingerprints(t.spark, f"{t.folder}/*.parquet").drop("path")


@query("D14", """
    WITH lines AS (SELECT c_nationkey, c_custkey, c_custkey || '|' || c_name AS line FROM customer)
    SELECT c_nationkey AS nation, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM lines GROUP BY 1""")
def hashes_of_written_files(t: Tables):
    path = scratch_path(t.spark, "hashed")
    lines = t.customer.select("c_nationkey", "c_custkey", F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    (lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("value", F.col("c_nationkey").alias("nation"))
     .write.partitionBy("nation").text(path))
    nation = F.regexp_extract("path", r"nation=(-?[0-9]+)/part", 1)
    return file_fingerprints(t.spark, f"{path}/*/part*").select(nation.cast("int").alias("nation"), "bytes", "sha256")


@query("D15", f"""
    WITH {RAW_PAY},
    cleaned AS (SELECT job_id, CASE WHEN currency IS NULL THEN annual_salary + 1 ELSE annual_salary END AS salary,
                       CASE WHEN annual_salary <= 62400 THEN 'Low' WHEN annual_salary <= 120000 THEN 'Mid' WHEN annual_salary IS NOT NULL THEN 'High' END AS tier FROM annual)
    SELECT count(*) AS raw_rows, count(*) FILTER (normalized_salary IS NULL) AS raw_missing, count(*) FILTER (normalized_salary IS NULL AND annual_salary IS NOT NULL) AS fills,
           count(*) FILTER (normalized_salary IS NOT NULL AND computed IS NOT NULL) AS comparable, count(*) FILTER (abs(normalized_salary - computed) > 0.011) AS formula_mismatches,
           count(*) AS cleaned_rows, count(*) FILTER (normalized_salary IS NULL) AS cleaned_missing_raw, count(*) FILTER (abs(salary - normalized_salary) > 0.011) AS salary_mismatches,
           count(*) FILTER (tier IS DISTINCT FROM CASE WHEN salary <= 62400 THEN 'Low' WHEN salary <= 109200 THEN 'Mid' WHEN salary IS NOT NULL THEN 'High' END) AS tier_mismatches
    FROM annual JOIN cleaned USING (job_id)""")
def annualisation_audit(t: Tables):
    raw = raw_pay(t)
    annual = raw.withColumn("a", values.annualise("normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period"))
    cleaned = annual.select("job_id", F.when(F.col("currency").isNull(), F.col("a") + 1).otherwise(F.col("a")).alias("normalized_salary"),
                            values.tier_between("a", F.lit(62400), F.lit(120000)).alias("salary_tier"))
    return contracts.annualisation_audit(raw, cleaned)


@query("D15", f"""
    WITH {RAW_PAY} SELECT pay_period AS period, count(*) AS n_rows, count(*) FILTER (abs(normalized_salary - computed) > 0.011) AS mismatches FROM annual GROUP BY 1""")
def formula_mismatch_by_period(t: Tables):
    return contracts.formula_mismatch_by_period(raw_pay(t))


@query("D16 A5", f"""
    WITH {RAW_PAY},
    source AS (SELECT *, row_number() OVER (ORDER BY posted, job_id) AS source_record,
                      sha256('[' || coalesce('"' || currency || '"', 'null') || ',"' || experience_level || '","' || title || '"]') AS k FROM raw_pay WHERE region <> 'AMERICA'),
    grouped AS (SELECT *, count(*) OVER (PARTITION BY k) AS group_size, min(job_id) OVER (PARTITION BY k) AS representative FROM source)
    SELECT p.job_id, g.source_record, g.k AS repost_group, g.group_size, g.representative, CASE WHEN g.job_id IS NULL THEN 'unavailable' ELSE 'linked' END AS source_status,
           CASE WHEN g.normalized_salary IS NULL THEN 'unavailable' ELSE 'source' END AS salary_origin, g.normalized_salary IS NULL OR p.region <> 'ASIA' AS within_tolerance
    FROM postings p LEFT JOIN grouped g USING (job_id)""")
def salary_lineage(t: Tables):
    retained = postings(t).select("job_id", (F.col("salary").cast("decimal(18,2)") + F.when(F.col("region") == "ASIA", F.lit(1)).otherwise(F.lit(0))).cast("string").alias("normalized_salary"),
                                  F.lit("Low").alias("salary_tier"))
    raw = raw_pay(t).filter(F.col("region") != "AMERICA").withColumn("normalized_salary", F.col("normalized_salary").cast("decimal(18,2)").cast("string"))
    lineage = contracts.salary_lineage(retained, raw, "job_id", ["currency", "experience_level", "title"], ["normalized_salary", "pay_period", "currency"],
                                       "normalized_salary", "salary_tier", "posted")
    return lineage.select("job_id", F.col("source_record").cast("bigint").alias("source_record"), "repost_group", "group_size", "representative",
                          "source_status", "salary_origin", "within_tolerance")


@query("D17 S-25", f"""
    WITH {JOBS},
    scores AS (SELECT city, experience_level AS candidate, count(*) FILTER (tier = 'High') AS score FROM jobs GROUP BY city, experience_level),
    best AS (SELECT city, candidate AS computed_winner FROM scores QUALIFY row_number() OVER (PARTITION BY city ORDER BY score DESC, candidate) = 1),
    stored AS (SELECT city, experience_level AS winner FROM jobs GROUP BY city, experience_level QUALIFY row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, experience_level) = 1)
    SELECT city, winner, computed_winner FROM stored JOIN best USING (city) WHERE winner <> computed_winner""")
def winner_conflicts(t: Tables):
    from ..scale import first_per_key

    counts = with_tier(postings(t)).groupBy("city", "experience_level").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tier") == "High").alias("score"))
    scores = counts.select("city", F.col("experience_level").alias("candidate"), "score", F.substring("experience_level", 1, 1).cast("int").alias("position"))
    stored = first_per_key(counts, ["city"], [F.col("n").desc(), F.col("experience_level")]).select("city", F.col("experience_level").alias("winner"))
    return contracts.winner_conflicts(scores, stored, "candidate", "score", "position", ["city"])


@query("D18", """
    WITH l AS (SELECT o_orderkey AS k, CAST('0x' || substr(md5(o_orderkey || '|1'), 1, 8) AS BIGINT) % 5 AS fold, o_orderstatus AS s FROM orders WHERE o_orderpriority <> '5-LOW'),
    r AS (SELECT o_orderkey AS k, CAST('0x' || substr(md5(o_orderkey || '|2'), 1, 8) AS BIGINT) % 5 AS fold, o_orderstatus AS s FROM orders WHERE o_orderstatus <> 'P')
    SELECT count(*) FILTER (l.fold IS NULL OR r.fold IS NULL) AS missing_or_extra, count(*) FILTER (l.fold IS DISTINCT FROM r.fold) AS fold_mismatches,
           count(*) FILTER (l.s IS DISTINCT FROM r.s) AS status_mismatches FROM l FULL JOIN r USING (k)""")
def split_differences(t: Tables):
    side = lambda seed, keep: t.orders.filter(keep).select(F.col("o_orderkey").alias("k"), (md5_number("o_orderkey", F.lit(seed)) % 5).alias("fold"), F.col("o_orderstatus").alias("status"))
    return contracts.assignment_differences(side(1, F.col("o_orderpriority") != "5-LOW"), side(2, F.col("o_orderstatus") != "P"), "k", ["fold", "status"])


@query("D19 S-14", f"""
    WITH {BASKET}, exact AS (SELECT item, count(*) AS c, count(*) / (SELECT count(*) FROM orders) AS support FROM basket GROUP BY 1),
    saved AS (SELECT item, round_even(support, 4) + CASE WHEN item > 'Brand#3' THEN 0.0002 ELSE 0 END AS support FROM exact)
    SELECT 'support' AS metric, count(*) FILTER (abs(s.support - e.support) > 0.000050001) AS beyond_rounding, round(max(abs(s.support - e.support)), 6) AS max_delta
    FROM saved s JOIN exact e USING (item)""")
def rounding_discrepancies(t: Tables):
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    exact = basket_rows(t).join(t.orders, F.col("job_id") == F.col("o_orderkey"), "left_semi").groupBy("item").agg((F.count(F.lit(1)) / F.any_value(total)).alias("support"))
    saved = exact.select("item", (F.bround("support", 4) + F.when(F.col("item") > "Brand#3", 0.0002).otherwise(0.0)).alias("support"))
    out = contracts.rounding_discrepancies(saved, exact, ["item"], ["support"])
    return out.withColumn("max_delta", r6("max_delta"))


@query("D20", f"""
    WITH n AS (SELECT l_orderkey, count(*) AS stored, count(DISTINCT p_brand) AS items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT count(*) AS n_rows, count(*) FILTER (stored <> items) AS mismatches FROM n""")
def stored_length_mismatches(t: Tables):
    lists = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("stored"), F.collect_set("p_brand").alias("items"))
    return contracts.length_mismatches(lists, "items", "stored")


@query("G13 S-6 S-8", f"""
    WITH {TIERS} SELECT tier, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high, any_value(round(p33, 6)) AS p33, any_value(round(p66, 6)) AS p66
    FROM tiers JOIN orders ON o_orderkey = job_id, cuts GROUP BY tier""")
def tiers_by_thirds(t: Tables):
    tiers = order_tiers(t).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.min("salary").alias("low"), F.max("salary").alias("high"))
    return with_row(tiers, cuts(t.orders, "o_totalprice")).withColumns({"p33": r6("p33"), "p66": r6("p66")})

