"""Itemsets and rules over whole tables.

Items are the six part types of an order, so the SQL side can hold an item set as a bit
mask and check itemsets and rules of every length.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as r
from ..operators.aggregates import top_n
from ..operators.splits import hash_folds
from ..operators.windows import company_cap
from ..scale import materialise
from .base import POSTINGS, TIERS, baskets, order_tiers, postings, r6
from .registry import Tables, query

TECHNICAL = ["PROMO", "SMALL", "STANDARD"]

MASKS = f"""{TIERS},
types(type, bit) AS (VALUES ('ECONOMY', 1), ('LARGE', 2), ('MEDIUM', 4), ('PROMO', 8), ('SMALL', 16), ('STANDARD', 32)),
line_types AS (SELECT DISTINCT l_orderkey AS job_id, bit FROM lineitem JOIN part ON l_partkey = p_partkey JOIN types ON type = p_type),
masks AS (SELECT o_orderkey AS job_id, coalesce(bit_or(bit), 0) AS mask FROM orders LEFT JOIN line_types ON job_id = o_orderkey GROUP BY 1),
job_masks AS (SELECT job_id, mask, tier FROM masks JOIN tiers USING (job_id)),
sets AS (SELECT m, string_agg(type, ', ' ORDER BY type) AS name, count(*) AS len FROM (SELECT unnest(range(1, 64)) AS m) JOIN types ON m & bit <> 0 GROUP BY m)"""


def mined(name: str, source: str, where: str, support: str, confidence: str, lift: str) -> str:
    """CTEs that mine one population: itemset counts, then all splits above the thresholds."""
    return f"""
{name}_pop AS (SELECT {source} FROM job_masks WHERE {where}),
{name}_sets AS (SELECT m, name, len, count(*) AS freq, (SELECT count(*) FROM {name}_pop) AS n FROM sets JOIN {name}_pop ON mask & m = m GROUP BY ALL HAVING count(*) / (SELECT count(*) FROM {name}_pop) >= {support}),
{name}_rules AS (
  SELECT b.m, a.name AS antecedents, c.name AS consequents, a.freq AS fa, c.freq AS fc, b.freq AS fb, b.n, b.freq / b.n AS support, b.freq / a.freq AS confidence, (b.freq * b.n) / (a.freq * c.freq) AS lift
  FROM {name}_sets b JOIN {name}_sets a ON a.m & b.m = a.m AND a.m <> b.m JOIN {name}_sets c ON c.m = b.m - a.m
  WHERE b.freq / a.freq > {confidence} AND (b.freq * b.n) / (a.freq * c.freq) > {lift})"""


def typed_jobs(t: Tables):
    """job_id, salary, tier and the part types of every order."""
    return order_tiers(t).join(baskets(t, "p_type"), "job_id")


def high():
    """The High tier."""
    return F.col("tier") == "High"


@query("J2 S-9 S-10", f"WITH {MASKS},{mined('a', 'mask', 'true', '0.05', '9', '9')} SELECT name AS itemset, freq, n, round(freq / n, 6) AS support, CAST(len AS INTEGER) AS length FROM a_sets")
def frequent_itemsets(t: Tables):
    found = r.frequent_itemsets(baskets(t, "p_type"), "items", 0.05)
    return found.select(r.itemset_text("itemset").alias("itemset"), "freq", "n", r6("support").alias("support"), "length")


@query("J3 J5 S-13", f"""
    WITH {MASKS},{mined('a', 'mask', 'true', '0.05', '0.3', '0.95')}
    SELECT antecedents, consequents, round(fa / n, 6) AS antecedent_support, round(fc / n, 6) AS consequent_support, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift,
           round(support - (fa / n) * (fc / n), 6) AS leverage, round((1 - fc / n) / nullif(1 - confidence, 0), 6) AS conviction FROM a_rules""")
def association_rules(t: Tables):
    metrics = ["antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage", "conviction"]
    return r.format_rules(r.mine_rules(baskets(t, "p_type"), "items", 0.05, 0.3, 0.95), []).select("antecedents", "consequents", *[r6(m).alias(m) for m in metrics])


@query("J4 J7 S-11", f"""
    WITH {MASKS},{mined('h', 'mask', "tier = 'High'", '0.1', '0.3', '0.95')},
    held AS (SELECT m, count(*) AS jobs, count(*) FILTER (tier = 'High') AS hi FROM sets JOIN job_masks ON mask & m = m GROUP BY 1)
    SELECT antecedents, consequents, fb AS itemset_count, round(lift, 6) AS lift, jobs AS jobs_with_itemset, round(hi / jobs, 6) AS high_tier_rate,
           round((hi / jobs) / (SELECT avg(CAST(tier = 'High' AS INTEGER)) FROM job_masks), 6) AS high_tier_lift FROM h_rules JOIN held USING (m)""")
def high_tier_rules(t: Tables):
    mined_rules = r.mine_high_tier(materialise(typed_jobs(t)), "items", high(), 0.1, 0.3, 0.95)
    return mined_rules.select("antecedents", "consequents", "itemset_count", r6("lift").alias("lift"), "jobs_with_itemset", r6("high_tier_rate").alias("high_tier_rate"), r6("high_tier_lift").alias("high_tier_lift"))


FIXED_RULES = [("PROMO", "SMALL"), ("LARGE, MEDIUM", "PROMO"), ("ECONOMY", "LARGE, STANDARD"), ("SMALL", "UNSEEN"), ("STANDARD", "MEDIUM"), ("ECONOMY, LARGE, MEDIUM", "SMALL")]
FIXED = """
fixed(antecedents, consequents, am, cm) AS (VALUES ('PROMO', 'SMALL', 8, 16), ('LARGE, MEDIUM', 'PROMO', 6, 8), ('ECONOMY', 'LARGE, STANDARD', 1, 34), ('SMALL', 'UNSEEN', 16, 64),
  ('STANDARD', 'MEDIUM', 32, 4), ('ECONOMY, LARGE, MEDIUM', 'SMALL', 7, 16))"""


def fixed_rules(t: Tables):
    """A few fixed rules, one of them with an item that never occurs."""
    return t.spark.createDataFrame(FIXED_RULES, "antecedents string, consequents string")


def scored(name: str, where: str) -> str:
    """CTE with the counts of the fixed rules in one population."""
    return f"""
{name} AS (SELECT antecedents, consequents, count(*) FILTER (mask & am = am) AS fa, count(*) FILTER (mask & cm = cm) AS fc, count(*) FILTER (mask & (am | cm) = (am | cm)) AS fb,
  count(*) FILTER (mask & (am | cm) = (am | cm) AND tier = 'High') AS hi, count(*) FILTER (tier = 'High') AS all_hi, count(*) AS n FROM fixed, job_masks WHERE {where} GROUP BY ALL)"""


METRICS = """round(fb / n, 6) AS support, round(fb / nullif(fa, 0), 6) AS confidence, round((fb * n) / nullif(fa * fc, 0), 6) AS lift"""


@query("J6 J11 E15 S-16", f"""
    WITH {MASKS},{FIXED},{scored('s', 'true')}
    SELECT antecedents, consequents, fa AS antecedent_count, fc AS consequent_count, fb AS itemset_count, n, {METRICS}, round(n / nullif(fc, 0), 6) AS max_lift, round(hi / nullif(fb, 0), 6) AS high_tier_rate,
           round((hi / nullif(fb, 0)) / (all_hi / n), 6) AS high_tier_lift FROM s""")
def scored_rules(t: Tables):
    s = r.score_rules(fixed_rules(t), typed_jobs(t), "items", high())
    return s.select("antecedents", "consequents", "antecedent_count", "consequent_count", "itemset_count", "n",
                    *[r6(m).alias(m) for m in ("support", "confidence", "lift", "max_lift", "high_tier_rate", "high_tier_lift")])


@query("J8", f"""
    WITH {MASKS},{mined('a', 'mask', 'true', '0.04', '0.2', '0.9')},{mined('h', 'mask', "tier = 'High'", '0.1', '0.3', '0.95')}
    SELECT antecedents, consequents, round(support, 6) AS support, support < 0.1 AS new_below_main_support, m IN (SELECT m FROM h_rules) AS in_high_tier_rules FROM a_rules WHERE m & 56 <> 0""")
def technical_rules(t: Tables):
    jobs = materialise(typed_jobs(t))
    known = r.mine_rules(jobs.filter(high()), "items", 0.1, 0.3, 0.95)
    found = r.technical_rules(jobs, "items", high(), TECHNICAL, known, 0.04, 0.1, 0.2, 0.9)
    return found.select("antecedents", "consequents", r6("support").alias("support"), "new_below_main_support", "in_high_tier_rules")


@query("J8b", f"""
    WITH {MASKS},{mined('a', 'mask', 'true', '0.2', '0.3', '1.0')}, wanted(item) AS (VALUES ('PROMO'), ('SMALL'), ('STANDARD'), ('UNSEEN')),
    c AS (SELECT type, count(*) AS n FROM types JOIN masks ON mask & bit <> 0 GROUP BY 1), s AS (SELECT item, coalesce(n, 0) AS jobs, coalesce(n, 0) / (SELECT count(*) FROM masks) AS support FROM wanted LEFT JOIN c ON type = item)
    SELECT item, jobs, round(support, 6) AS support, EXISTS (SELECT 1 FROM a_rules JOIN types ON m & bit <> 0 WHERE type = item) AS in_rules,
           CASE WHEN support >= 0.44 THEN 'frequent' WHEN support >= 0.01 THEN 'rare' ELSE 'below' END AS band FROM s""")
def technical_support_bands(t: Tables):
    lists = materialise(baskets(t, "p_type"))
    bands = r.technical_support_bands(lists, "items", [*TECHNICAL, "UNSEEN"], r.mine_rules(lists, "items", 0.2, 0.3, 1.0), 0.44)
    return bands.withColumn("support", r6("support"))


@query("J9", f"""
    WITH {MASKS}, tech AS (SELECT job_id, mask & 56 AS mask, tier FROM job_masks), {mined('a', 'mask & 56 AS mask', 'true', '0.02', '0.2', '0.9')}
    SELECT antecedents, consequents, fb AS itemset_count, n, round(support, 6) AS support, round(lift, 6) AS lift FROM a_rules""")
def strict_technical_rules(t: Tables):
    found = r.strict_technical_rules(baskets(t, "p_type"), "items", TECHNICAL, 0.02, 0.2, 0.9)
    return found.select("antecedents", "consequents", "itemset_count", "n", r6("support").alias("support"), r6("lift").alias("lift"))


@query("J10 E12", f"""
    WITH {MASKS}, p AS (SELECT a.type AS a, b.type AS b, count(*) AS jobs, count(*) FILTER (tier = 'High') AS hi FROM types a JOIN types b ON a.type < b.type AND (a.bit | b.bit) & 56 = (a.bit | b.bit)
      JOIN job_masks ON mask & a.bit <> 0 AND mask & b.bit <> 0 GROUP BY ALL), s AS (SELECT type, count(*) AS c FROM types JOIN masks ON mask & bit <> 0 GROUP BY 1), n AS (SELECT count(*) AS n, avg(CAST(tier = 'High' AS INTEGER)) AS h FROM job_masks)
    SELECT a, b, jobs, round(jobs / n, 6) AS support, round((jobs * n) / (x.c * y.c), 6) AS lift, round(hi / jobs, 6) AS high_tier_rate, round(hi / jobs / h, 6) AS high_tier_lift
    FROM p JOIN s x ON x.type = a JOIN s y ON y.type = b, n ORDER BY jobs DESC, a, b LIMIT 10""")
def technical_pairs(t: Tables):
    pairs = r.pair_metrics(typed_jobs(t), "items", high(), TECHNICAL)
    return top_n(pairs, [F.col("jobs").desc(), F.col("a"), F.col("b")], 10).select("a", "b", "jobs", *[r6(m).alias(m) for m in ("support", "lift", "high_tier_rate", "high_tier_lift")])


@query("J12", f"""
    WITH {MASKS},{mined('a', 'mask', 'true', '0.05', '0.3', '0.95')} SELECT antecedents, consequents, round(lift, 6) AS lift FROM a_rules ORDER BY a_rules.lift DESC, support DESC, antecedents, consequents LIMIT 10""")
def top_rules(t: Tables):
    return r.rank_general(r.mine_rules(baskets(t, "p_type"), "items", 0.05, 0.3, 0.95)).select("antecedents", "consequents", r6("lift").alias("lift"))


@query("J12", f"""
    WITH {MASKS},{mined('h', 'mask', "tier = 'High'", '0.1', '0.3', '0.95')}, held AS (SELECT m, count(*) AS jobs, count(*) FILTER (tier = 'High') AS hi FROM sets JOIN job_masks ON mask & m = m GROUP BY 1)
    SELECT antecedents, consequents, round(hi / jobs, 6) AS high_tier_rate FROM h_rules JOIN held USING (m) ORDER BY hi / jobs DESC, lift DESC, jobs DESC, antecedents, consequents LIMIT 5""")
def top_high_rules(t: Tables):
    found = r.mine_high_tier(materialise(typed_jobs(t)), "items", high(), 0.1, 0.3, 0.95)
    return r.rank_high(found).select("antecedents", "consequents", r6("high_tier_rate").alias("high_tier_rate"))


@query("J13", f"""
    WITH {MASKS},{mined('a', 'mask', 'bit_count(mask) >= 2', '0.04', '0.3', '0.95')} SELECT antecedents, consequents, n, round(support, 6) AS support, 0.04 AS used_support FROM a_rules""")
def adaptive_rules(t: Tables):
    found, used = r.adaptive_rules(baskets(t, "p_type"), "items", 2, 60, 0.4, 0.04, 0.3, 0.95)
    return found.select("antecedents", "consequents", "n", r6("support").alias("support"), F.lit(used).alias("used_support"))


@query("J14 E11", f"""
    WITH {MASKS},{mined('l', 'mask', "tier = 'Low'", '0.12', '0.3', '0.98')},{mined('h', 'mask', "tier = 'High'", '0.12', '0.3', '0.98')},
    every AS (SELECT b.m, a.name AS antecedents, c.name AS consequents, a.m AS am, c.m AS cm FROM sets b JOIN sets a ON a.m & b.m = a.m AND a.m <> b.m JOIN sets c ON c.m = b.m - a.m),
    live AS (SELECT e.*, count(*) FILTER (mask & am = am) AS fa, count(*) FILTER (mask & cm = cm) AS fc, count(*) FILTER (mask & m = m) AS fb, count(*) AS n FROM every e, job_masks WHERE tier = 'High' GROUP BY ALL)
    SELECT CASE WHEN h.m IS NULL THEN 'disappeared_in_live' WHEN l.m IS NULL THEN 'new_in_live' ELSE 'both' END AS status, e.antecedents, e.consequents, round(l.support, 6) AS support_train, round(l.lift, 6) AS lift_train,
           round(e.fb / e.n, 6) AS support_live, round((e.fb * e.n) / (e.fa * e.fc), 6) AS lift_live
    FROM live e LEFT JOIN l_rules l ON l.antecedents = e.antecedents AND l.consequents = e.consequents LEFT JOIN h_rules h ON h.antecedents = e.antecedents AND h.consequents = e.consequents
    WHERE l.m IS NOT NULL OR h.m IS NOT NULL""")
def compared_rules(t: Tables):
    jobs = materialise(typed_jobs(t))
    live = jobs.filter(high())
    train_rules, live_rules = (r.mine_rules(d, "items", 0.12, 0.3, 0.98) for d in (jobs.filter(F.col("tier") == "Low"), live))
    c = r.compare_rules(materialise(train_rules), materialise(live_rules), live, "items")
    return c.select("status", "antecedents", "consequents", *[r6(m).alias(m) for m in ("support_train", "lift_train", "support_live", "lift_live")])


def checked(name: str, where: str, support: str) -> str:
    """CTE with metrics and threshold results of the fixed rules."""
    return f"""{scored(name + '0', where)}, {name} AS (SELECT *, fb / n AS support, fb / nullif(fa, 0) AS confidence, (fb * n) / nullif(fa * fc, 0) AS lift, n / nullif(fc, 0) AS max_lift FROM {name}0),
{name}_checks AS (SELECT *, coalesce(support >= {support}, false) AS s_ok, coalesce(confidence > 0.35, false) AS c_ok, coalesce(lift > 1.0, false) AS l_ok FROM {name})"""


CAPPED_IDS = f"""
capped AS (SELECT job_id FROM postings QUALIFY row_number() OVER (PARTITION BY city ORDER BY posted DESC, CAST(job_id AS VARCHAR)) <= 250)"""


def type_postings(t: Tables):
    """Postings with part types, for caps by city."""
    return postings(t).select(F.col("job_id").alias("id"), F.col("city").alias("company_name"), F.col("posted").alias("publication_date"), F.lit("all").alias("fetch_date")).join(
        baskets(t, "p_type").withColumnRenamed("job_id", "id"), "id")


@query("J15 S-19", f"""
    WITH {MASKS},{POSTINGS},{CAPPED_IDS},{FIXED},{checked('v', 'bit_count(mask) >= 2', '0.1')},{checked('w', 'bit_count(mask) >= 2 AND job_id IN (SELECT job_id FROM capped)', '0.1')}
    SELECT v.antecedents, v.consequents, round(v.support, 6) AS support, round(v.lift, 6) AS lift, round(v.max_lift, 6) AS max_lift, v.s_ok AND v.c_ok AND v.l_ok AS validated, v.c_ok AND v.l_ok AS lift_holds,
           CASE WHEN v.lift IS NULL OR v.confidence IS NULL THEN 'not measurable' ELSE concat_ws(', ', CASE WHEN NOT v.s_ok THEN 'support' END, CASE WHEN NOT v.c_ok THEN 'confidence' END, CASE WHEN NOT v.l_ok THEN 'lift' END) END AS failure_reasons,
           coalesce(v.max_lift <= 1.0, false) AS lift_ceiling_blocks_threshold, w.s_ok AND w.c_ok AND w.l_ok AS validated_company_capped, round(w.lift, 6) AS lift_company_capped
    FROM v_checks v JOIN w_checks w USING (antecedents, consequents)""")
def validated_rules(t: Tables):
    sample = materialise(type_postings(t))
    trained = r.score_rules(fixed_rules(t), sample, "items")
    out = r.validate_rules(trained, sample, "items", 2, 0.1, 0.35, 1.0, company_cap(sample, 250))
    return out.select("antecedents", "consequents", *[r6(m).alias(m) for m in ("support", "lift", "max_lift")], "validated", "lift_holds", "failure_reasons", "lift_ceiling_blocks_threshold",
                      "validated_company_capped", r6("lift_company_capped").alias("lift_company_capped"))


@query("J16", f"""
    WITH {MASKS},{FIXED},{checked('v', 'bit_count(mask) >= 2', '0.2')},{checked('w', 'bit_count(mask) >= 2', '0.1')}
    SELECT v.antecedents, v.consequents, v.fb AS itemset_count, v.n, v.s_ok AND v.c_ok AND v.l_ok AS passes_primary, w.s_ok AND w.c_ok AND w.l_ok AS passes_sensitivity
    FROM v_checks v JOIN w_checks w USING (antecedents, consequents)""")
def fixed_rule_evaluation(t: Tables):
    out = r.evaluate_fixed_rules(fixed_rules(t), baskets(t, "p_type"), "items", 2, 0.2, 0.1, 0.35, 1.0)
    return out.select("antecedents", "consequents", "itemset_count", "n", "passes_primary", "passes_sensitivity")


@query("J16 S-19", f"WITH {MASKS} SELECT count(*) AS postings, count(*) FILTER (bit_count(mask) >= 2) AS eligible, count(*) FILTER (bit_count(mask) < 2) AS excluded, count(*) FILTER (mask = 0) AS empty FROM masks")
def rule_eligibility(t: Tables):
    return r.eligibility_report(baskets(t, "p_type"), "items")


def shares_sql(name: str, where: str) -> str:
    """CTE with the item shares of one population."""
    return f"{name} AS (SELECT type, count(*) FILTER (mask & bit <> 0) / count(*) AS share FROM types, job_masks WHERE {where} GROUP BY type)"


COMPARISON = f"""{MASKS},{shares_sql('lv', "tier = 'High'")},{shares_sql('tr', 'true')},{shares_sql('gr', "tier = 'Low'")},
comparison AS (SELECT type AS skill, lv.share AS live_share, tr.share AS train_share, gr.share AS train_group_share, type IN ('PROMO', 'SMALL', 'STANDARD') AS is_technical,
  100 * (lv.share - gr.share) AS pp, lv.share / nullif(gr.share, 0) AS ratio FROM lv JOIN tr USING (type) JOIN gr USING (type))"""


def comparison(t: Tables):
    """High postings as the live source, Low postings as the training group."""
    jobs = materialise(typed_jobs(t))
    return r.source_comparison(jobs.filter(high()), jobs, jobs.filter(F.col("tier") == "Low"), "items", TECHNICAL, jobs.filter(F.col("tier") == "Mid"))


@query("J26", f"""
    WITH {COMPARISON} SELECT skill, round(live_share, 6) AS live_share, round(train_share, 6) AS train_share, round(train_group_share, 6) AS train_group_share, is_technical, round(pp, 6) AS change_vs_group_pp,
           round(ratio, 6) AS ratio_vs_group FROM comparison""")
def source_comparison(t: Tables):
    return comparison(t).select("skill", "is_technical", *[r6(c).alias(c) for c in ("live_share", "train_share", "train_group_share", "change_vs_group_pp", "ratio_vs_group")])


@query("J27", f"""
    WITH {COMPARISON} SELECT * FROM (SELECT skill, round(pp, 6) AS change_vs_group_pp, 'top' AS side FROM comparison ORDER BY pp DESC, skill LIMIT 2)
    UNION ALL SELECT * FROM (SELECT skill, round(pp, 6) AS change_vs_group_pp, 'bottom' AS side FROM comparison ORDER BY pp, skill LIMIT 2)""")
def demand_shifts(t: Tables):
    return r.demand_shifts(comparison(t), 2).select("skill", r6("change_vs_group_pp").alias("change_vs_group_pp"), "side")


@query("J29b", f"""
    WITH {COMPARISON} SELECT skill, round(live_share, 6) AS live_share, round(train_share, 6) AS train_share FROM comparison ORDER BY comparison.live_share DESC, skill LIMIT 4""")
def compared_top_items(t: Tables):
    return top_n(comparison(t), [F.col("live_share").desc(), F.col("skill")], 4).select("skill", r6("live_share").alias("live_share"), r6("train_share").alias("train_share"))


@query("J29b", f"""
    WITH {MASKS},{FIXED},{scored('t', "tier <> 'High'")},{checked('v', "tier = 'High'", '0.1')}
    SELECT v.antecedents, v.consequents, round((t.fb * t.n) / (t.fa * t.fc), 6) AS training_lift, round(v.lift, 6) AS live_lift, v.s_ok AND v.c_ok AND v.l_ok AS confirmed
    FROM t JOIN v_checks v USING (antecedents, consequents) WHERE v.lift IS NOT NULL""")
def training_against_live_lift(t: Tables):
    jobs = materialise(typed_jobs(t))
    trained = r.score_rules(fixed_rules(t), jobs.filter(~high()), "items")
    out = r.validate_rules(trained, jobs.filter(high()), "items", 0, 0.1, 0.35, 1.0).filter(F.col("lift").isNotNull())
    return out.select("antecedents", "consequents", r6("training_lift").alias("training_lift"), r6("lift").alias("live_lift"), F.col("validated").alias("confirmed"))


@query("J28", f"""
    WITH {MASKS},{POSTINGS}, held AS (SELECT city, count(*) AS n FROM postings JOIN masks USING (job_id) WHERE mask & 25 = 25 GROUP BY 1)
    SELECT city, n, round(n / (SELECT sum(n) FROM held), 6) AS share FROM held""")
def template_concentration(t: Tables):
    listed = postings(t).select("job_id", "city").join(baskets(t, "p_type"), "job_id")
    return r.template_concentration(listed, "items", ["ECONOMY", "PROMO", "SMALL"], "city").withColumn("share", r6("share"))


@query("J30", "SELECT o_custkey, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def employer_concentration(t: Tables):
    return r.employer_concentration(t.orders, "o_custkey", 10).withColumn("share", r6("share"))


@query("J31", """
    WITH folds AS (SELECT o_orderkey AS j, o_custkey AS e, CAST('0x' || substr(md5(o_custkey || '|5'), 1, 8) AS BIGINT) % 5 = 0 AS validation FROM orders),
    b AS (SELECT DISTINCT l_orderkey AS j, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey), d AS (SELECT f.*, item FROM folds f JOIN b USING (j)),
    n AS (SELECT validation, count(*) AS n FROM folds GROUP BY 1), s AS (SELECT validation, item, count(*) AS c, count(DISTINCT e) AS employers FROM d GROUP BY ALL),
    p AS (SELECT x.validation, x.item AS a, y.item AS b, count(*) AS jobs, count(DISTINCT x.e) AS employers FROM d x JOIN d y ON x.j = y.j AND x.item < y.item GROUP BY ALL),
    m AS (SELECT p.*, x.c AS ca, y.c AS cb, n.n, x.employers AS ea, y.employers AS eb, jobs / n.n AS support, (jobs * n.n) / (x.c * y.c) AS lift FROM p JOIN s x ON x.validation = p.validation AND x.item = a
          JOIN s y ON y.validation = p.validation AND y.item = b JOIN n ON n.validation = p.validation),
    chosen AS (SELECT * FROM m WHERE NOT validation AND support >= 0.001 AND support < 0.03 AND lift >= 1.0 AND greatest(jobs / ca, jobs / cb) > 0.1 AND employers >= 10 AND ea >= 20 AND eb >= 20 ORDER BY lift DESC, jobs DESC, a, b LIMIT 10)
    SELECT c.a, c.b, c.jobs, round(c.lift, 6) AS lift, c.employers AS pair_employers, v.jobs AS validation_jobs, round(v.lift, 6) AS validation_lift FROM chosen c LEFT JOIN m v ON v.validation AND v.a = c.a AND v.b = c.b""")
def replicated_pairs(t: Tables):
    jobs = baskets(t).join(t.orders.select(F.col("o_orderkey").alias("job_id"), "o_custkey"), "job_id")
    folded = materialise(hash_folds(jobs, "o_custkey", 5, 5))
    out = r.replicate_pairs(folded, "items", "o_custkey", "o_custkey", F.col("fold") == 0, 10, 20, (0.001, 0.03), 1.0, 10, 0.1)
    return out.select("a", "b", "jobs", r6("lift").alias("lift"), "pair_employers", "validation_jobs", r6("validation_lift").alias("validation_lift"))

