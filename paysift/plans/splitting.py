"""Grouped splits, leakage checks and bootstraps over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bootstrap as b
from ..operators import splits as s
from ..scale import materialise, md5_number
from .base import POSTINGS, PREDICTIONS, TIERS, baskets, descriptions, order_tiers, postings, predictions, r6
from .mining import FIXED, MASKS, fixed_rules
from .registry import Tables, query


def number(*parts: str) -> str:
    """SQL of the reproducible number of some parts."""
    return f"CAST('0x' || substr(md5({' || chr(124) || '.join(f'CAST({p} AS VARCHAR)' for p in parts)}), 1, 8) AS BIGINT)"


def customer_tiers(t: Tables):
    """job_id, tier and customer of every order."""
    return order_tiers(t).join(t.orders.select(F.col("o_orderkey").alias("job_id"), "o_custkey"), "job_id")


@query("L1 S-18", """
    WITH g AS (SELECT CASE WHEN lang IN ('fr', 'es') THEN 'missing:' || doc_id ELSE 'employer:' || lower(trim(source)) END AS grp FROM documents)
    SELECT grp AS employer, count(*) AS n FROM g GROUP BY 1""")
def employer_groups(t: Tables):
    company = F.when(F.col("title") == "es", F.lit("  ")).when(F.col("title") != "fr", F.concat(F.lit(" "), F.upper("company_name")))
    return descriptions(t).groupBy(s.employer_group(company, "job_id").alias("employer")).agg(F.count(F.lit(1)).alias("n"))


@query("L1", """
    SELECT CASE WHEN lang = 'de' THEN 'singleton-job:' || doc_id ELSE sha256(text) END AS grp, count(*) AS n FROM documents GROUP BY 1""")
def description_groups(t: Tables):
    key = F.when(F.col("title") != "de", F.sha2("description", 256))
    return descriptions(t).groupBy(s.description_group(key, "job_id").alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@query("K-6", f"""
    WITH {TIERS}, h AS (SELECT *, {number('job_id', '42')} AS h FROM tiers)
    SELECT job_id, tier, CASE WHEN count(*) OVER (PARTITION BY tier ORDER BY h) <= round(count(*) OVER (PARTITION BY tier) * 0.2) THEN 'test' ELSE 'train' END AS role FROM h""")
def stratified_split(t: Tables):
    return s.stratified_split(order_tiers(t), "job_id", "tier", 42).select("job_id", "tier", "role")


@query("K-7", f"""
    WITH {TIERS}, h AS (SELECT *, {number('job_id', '7')} AS h FROM tiers)
    SELECT job_id, CAST((rank() OVER (PARTITION BY tier ORDER BY h) - 1) % 3 AS INTEGER) AS fold FROM h""")
def stratified_folds(t: Tables):
    return s.stratified_folds(order_tiers(t), "job_id", "tier", 3, 7).select("job_id", "fold")


def snake(k: int, seed: int, source: str, name: str) -> str:
    """CTEs that deal whole customers into folds, in the order the operator documents."""
    return f"""
{name}_g AS (SELECT o_custkey, count(*) FILTER (tier = 'Low') AS c0, count(*) FILTER (tier = 'Mid') AS c1, count(*) FILTER (tier = 'High') AS c2, count(*) AS size, {number('o_custkey', str(seed))} AS h FROM {source} GROUP BY 1),
{name}_m AS (SELECT *, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 1 WHEN c1 >= c2 THEN 2 ELSE 3 END AS main FROM {name}_g),
{name}_t AS (SELECT *, main + rank() OVER (PARTITION BY main, size ORDER BY h) - 1 + (SELECT count(*) FROM {name}_m o WHERE o.main = x.main AND o.size > x.size) AS turn FROM {name}_m x),
{name} AS (SELECT o_custkey, CAST(CASE WHEN (turn // {k}) % 2 = 0 THEN turn % {k} ELSE {k - 1} - turn % {k} END AS INTEGER) AS fold FROM {name}_t)"""


CUSTOMER_TIERS = f"""{TIERS},
customer_tiers AS (SELECT job_id, tier, o_custkey FROM tiers JOIN orders ON o_orderkey = job_id)"""


@query("L2 L8", f"""
    WITH {CUSTOMER_TIERS},{snake(5, 2026, 'customer_tiers', 'folds')}
    SELECT fold, count(*) AS n_rows, count(DISTINCT c.o_custkey) AS n_groups, count(*) FILTER (tier = 'Low') AS low, count(*) FILTER (tier = 'High') AS high FROM customer_tiers c JOIN folds USING (o_custkey) GROUP BY 1""")
def group_folds(t: Tables):
    folded = s.stratified_group_folds(customer_tiers(t), "o_custkey", "tier", 5, 2026)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_custkey").alias("n_groups"), F.count_if(F.col("tier") == "Low").alias("low"),
                                      F.count_if(F.col("tier") == "High").alias("high"))


DESIGN = f"""{CUSTOMER_TIERS},{snake(5, 2026, 'customer_tiers', 'outer_folds')},
roles AS (SELECT c.*, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS outer_role FROM customer_tiers c JOIN outer_folds USING (o_custkey)),
training AS (SELECT * FROM roles WHERE outer_role = 'train'),{snake(3, 2027, 'training', 'inner_folds')},
design AS (SELECT r.*, coalesce(i.fold, -1) AS inner_fold FROM roles r LEFT JOIN inner_folds i ON i.o_custkey = r.o_custkey AND outer_role = 'train')"""


@query("L2 L8 K-24", f"WITH {DESIGN} SELECT job_id, o_custkey, outer_role, CAST(inner_fold AS INTEGER) AS inner_fold FROM design")
def grouped_design(t: Tables):
    return s.grouped_design(customer_tiers(t), "o_custkey", "tier").select("job_id", "o_custkey", "outer_role", "inner_fold")


@query("L3", f"""
    WITH {CUSTOMER_TIERS}, roles AS (SELECT *, CASE WHEN {number('o_custkey', '9')} % 5 = 0 THEN 'test' ELSE 'train' END AS role FROM customer_tiers),
    g AS (SELECT o_custkey, count(*) AS c, count(*) FILTER (role = 'train') AS tr, count(*) FILTER (role = 'test') AS te FROM roles GROUP BY 1)
    SELECT count(*) FILTER (role = 'train') AS train_rows, count(*) FILTER (role = 'test') AS test_rows, count(*) FILTER (role = 'train' AND tier = 'Low') AS train_low,
      count(*) FILTER (role = 'train' AND tier = 'Mid') AS train_mid, count(*) FILTER (role = 'train' AND tier = 'High') AS train_high, count(*) FILTER (role = 'test' AND tier = 'Low') AS test_low,
      count(*) FILTER (role = 'test' AND tier = 'Mid') AS test_mid, count(*) FILTER (role = 'test' AND tier = 'High') AS test_high, (SELECT count(*) FROM g WHERE tr > 0) AS train_groups,
      (SELECT count(*) FROM g WHERE te > 0) AS test_groups, (SELECT count(*) FROM g WHERE tr > 0 AND te > 0) AS shared_groups, (SELECT count(*) FROM g) AS groups_total, (SELECT max(c) FROM g) AS largest_group,
      (SELECT quantile_cont(c, 0.5) FROM g) AS group_size_q50, (SELECT quantile_cont(c, 0.9) FROM g) AS group_size_q90, (SELECT round(quantile_cont(c, 0.99), 6) FROM g) AS group_size_q99,
      (SELECT CAST(max(c) AS DOUBLE) FROM g) AS group_size_q100, round((SELECT max(c) FROM g) / count(*), 6) AS largest_group_share FROM roles""")
def split_statistics(t: Tables):
    folded = s.hash_folds(customer_tiers(t), "o_custkey", 5, 9)
    roles = folded.withColumn("role", F.when(F.col("fold") == 0, "test").otherwise("train"))
    return s.split_statistics(roles, "role", "o_custkey", "tier").withColumns({c: r6(c) for c in ("largest_group_share", "group_size_q99")})


@query("L4 G12", f"""
    WITH r AS (SELECT {number('o_custkey', '9')} % 5 = 0 AS a, {number('o_orderkey', '9')} % 5 = 0 AS b FROM orders)
    SELECT count(*) FILTER (a) AS old_test_rows, count(*) FILTER (b) AS new_test_rows, count(*) FILTER (a AND b) AS shared_test_rows, count(*) FILTER (a AND NOT b) AS old_test_now_training,
           count(*) FILTER (b AND NOT a) AS new_test_previously_training FROM r""")
def compared_splits(t: Tables):
    role = lambda key: F.when(md5_number(key, F.lit(9)) % 5 == 0, "test").otherwise("train")
    return s.compare_splits(t.orders.select(role("o_custkey").alias("old"), role("o_orderkey").alias("new")), "old", "new")


@query("L9 C29 C30 C31", f"""
    WITH n AS (SELECT source, lang, text, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS norm, {number('doc_id', '3')} % 5 > 0 AS train FROM documents),
    k AS (SELECT unnest([struct_pack(key := 'exact_description', v := text), struct_pack(key := 'normalized_description', v := norm),
      struct_pack(key := 'masked_template', v := regexp_replace(regexp_replace(norm, 'https?://\\S+', '<url>', 'g'), '\\d+(?:[.,]\\d+)*', '<num>', 'g')),
      struct_pack(key := 'company_title', v := lower(trim(source)) || '|' || lower(trim(lang)))]) AS e, train FROM n),
    g AS (SELECT e.key AS key, e.v AS v, count(*) AS c, count(*) FILTER (train) AS tr FROM k WHERE e.v <> '' GROUP BY ALL)
    SELECT key, CAST(sum(c) AS BIGINT) AS nonempty_rows, count(*) FILTER (c > 1) AS repeated_groups, CAST(coalesce(sum(c) FILTER (c > 1), 0) AS BIGINT) AS rows_in_repeated_groups, CAST(sum(c - 1) AS BIGINT) AS excess_rows,
           count(*) FILTER (tr > 0 AND tr < c) AS cross_split_groups, CAST(coalesce(sum(c - tr) FILTER (tr > 0 AND tr < c), 0) AS BIGINT) AS test_rows_with_train_group, max(c) AS largest_group FROM g GROUP BY 1""")
def leakage_report(t: Tables):
    return s.leakage_report(descriptions(t), "description", "company_name", "title", md5_number("job_id", F.lit(3)) % 5 > 0)


@query("L10", f"""
    WITH {TIERS}, f AS (SELECT {number('job_id', '4')} % 4 AS fold, tier FROM tiers) SELECT CAST(fold AS INTEGER) AS fold, count(DISTINCT tier) AS n_classes, count(DISTINCT tier) = 3 AS complete FROM f GROUP BY 1""")
def class_coverage(t: Tables):
    return s.class_coverage(s.hash_folds(order_tiers(t), "job_id", 4, 4), "fold", "tier")


@query("L5", """
    WITH RECURSIVE keyed AS (SELECT doc_id, 'a' || md5(text) AS k FROM documents UNION ALL SELECT doc_id, 'b' || lang || n_chars FROM documents WHERE n_chars > 400),
    firsts AS (SELECT k, min(doc_id) AS m FROM keyed GROUP BY 1), links AS (SELECT doc_id AS u, m AS v FROM keyed JOIN firsts USING (k) UNION SELECT m, doc_id FROM keyed JOIN firsts USING (k)),
    reach AS (SELECT u, u AS label FROM links UNION SELECT l.v, r.label FROM reach r JOIN links l ON l.u = r.u)
    SELECT doc_id, coalesce(min(label), doc_id) AS component FROM documents LEFT JOIN reach ON u = doc_id GROUP BY doc_id""")
def connected_documents(t: Tables):
    keyed = t.documents.select("doc_id", F.md5("text").alias("same_text"), F.when(F.col("n_chars") > 400, F.concat("lang", F.col("n_chars").cast("string"))).alias("same_shape"))
    return s.connected_groups(keyed, "doc_id", ["same_text", "same_shape"]).select("doc_id", "component")


REPLICATES = 200


def draws(groups: str, seed: int, replicates: int = REPLICATES) -> str:
    """CTEs that index groups, draw blocks of 256 of them with replacement per replicate, and deal a block's draws to its groups."""
    wide = lambda *parts: f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"
    return f"""
indexed AS (SELECT grp, row_number() OVER (ORDER BY grp) - 1 AS g FROM (SELECT DISTINCT {groups} AS grp FROM source)), size AS (SELECT count(*) AS n_groups FROM indexed),
blocks AS (SELECT r, ({wide(f"'{seed}'", 'r', 'j')} % n_groups) // 256 AS b, count(*) AS k, any_value(n_groups) AS n_groups FROM (SELECT unnest(range({replicates})) AS r), size, (SELECT unnest(range((SELECT n_groups FROM size))) AS j) GROUP BY ALL),
drawn AS (SELECT r, b * 256 + {wide(f"'{seed}'", "'in'", 'r', 'b', 'j')} % least(256, n_groups - b * 256) AS g FROM (SELECT *, unnest(range(1, k + 1)) AS j FROM blocks)),
weights AS (SELECT r, grp, count(*) AS w FROM drawn JOIN indexed USING (g) GROUP BY ALL)"""


CELLS = ", ".join(f"sum(w * n{i}{j}) AS n{i}{j}" for i in range(3) for j in range(3))
GROUP_CELLS = ", ".join(f"count(*) FILTER (actual_tier = '{a}' AND PRED = '{p}') AS n{i}{j}" for i, a in enumerate(("Low", "Mid", "High")) for j, p in enumerate(("Low", "Mid", "High")))
F1 = {c: f"coalesce(2 * n{i}{i} / nullif({' + '.join(f'n{i}{j}' for j in range(3))} + {' + '.join(f'n{j}{i}' for j in range(3))}, 0), 0)" for i, c in enumerate(("low", "mid", "high"))}
TOTAL = "(" + " + ".join(f"n{i}{j}" for i in range(3) for j in range(3)) + ")"
REPLICATE_METRICS = f"(n00 + n11 + n22) / {TOTAL} AS accuracy, ({F1['low']} + {F1['mid']} + {F1['high']}) / 3 AS macro_f1, {F1['low']} AS f1_low, {F1['mid']} AS f1_mid, {F1['high']} AS f1_high"
INTERVALS = "SELECT metric, round(quantile_cont(v, 0.025), 6) AS low, round(quantile_cont(v, 0.975), 6) AS high, count(v) AS defined_replicates FROM (UNPIVOT {} ON accuracy, macro_f1, f1_low, f1_mid, f1_high INTO NAME metric VALUE v) GROUP BY 1"


def rounded_intervals(df):
    """Interval bounds at six decimals."""
    return df.withColumns({"low": r6("low"), "high": r6("high")})


@query("L6 K-15", f"""
    WITH {PREDICTIONS}, source AS (SELECT company_name AS grp, * FROM predictions), {draws('company_name', 42)},
    cells AS (SELECT company_name AS grp, {GROUP_CELLS.replace('PRED', 'predicted_tier')} FROM source GROUP BY 1), sums AS (SELECT r, {CELLS} FROM weights JOIN cells USING (grp) GROUP BY 1),
    reps AS (SELECT {REPLICATE_METRICS} FROM sums) {INTERVALS.format('reps')}""")
def prediction_intervals(t: Tables):
    return rounded_intervals(b.prediction_bootstrap(materialise(predictions(t)), "company_name", "actual_tier", "predicted_tier", REPLICATES))


@query("L11", f"""
    WITH {PREDICTIONS}, source AS (SELECT city AS grp, *, CASE WHEN industry IN ('BUILDING', 'MACHINERY') THEN actual_tier ELSE predicted_tier END AS candidate FROM predictions), {draws('city', 5)},
    bc AS (SELECT city AS grp, {GROUP_CELLS.replace('PRED', 'predicted_tier')} FROM source GROUP BY 1), cc AS (SELECT city AS grp, {GROUP_CELLS.replace('PRED', 'candidate')} FROM source GROUP BY 1),
    bs AS (SELECT r, {CELLS} FROM weights JOIN bc USING (grp) GROUP BY 1), cs AS (SELECT r, {CELLS} FROM weights JOIN cc USING (grp) GROUP BY 1),
    br AS (SELECT r, {REPLICATE_METRICS} FROM bs), cr AS (SELECT r, {REPLICATE_METRICS} FROM cs),
    d AS (SELECT c.accuracy - b.accuracy AS accuracy, c.macro_f1 - b.macro_f1 AS macro_f1, c.f1_low - b.f1_low AS f1_low, c.f1_mid - b.f1_mid AS f1_mid, c.f1_high - b.f1_high AS f1_high FROM br b JOIN cr c USING (r))
    {INTERVALS.format('d')}""")
def paired_intervals(t: Tables):
    scored = materialise(predictions(t).withColumn("candidate", F.when(F.col("industry").isin("BUILDING", "MACHINERY"), F.col("actual_tier")).otherwise(F.col("predicted_tier"))))
    return rounded_intervals(b.paired_bootstrap(scored, "city", "actual_tier", "predicted_tier", "candidate", REPLICATES, 5))


@query("L6", f"""
    WITH {PREDICTIONS}, source AS (SELECT city AS grp, * FROM predictions), {draws('city', 6)},
    long AS (SELECT grp, unnest([struct_pack(c := 'Low', v := -priced, p := actual_tier = 'Low'), struct_pack(c := 'Mid', v := -abs(priced - 150000), p := actual_tier = 'Mid'),
      struct_pack(c := 'High', v := priced, p := actual_tier = 'High')]) AS e FROM source),
    vals AS (SELECT r, e.c AS c, e.v AS v, sum(w) AS n, sum(w) FILTER (e.p) AS p FROM weights JOIN long USING (grp) GROUP BY ALL),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY r, c ORDER BY v) - n AS before FROM vals),
    auc AS (SELECT r, c, (sum(coalesce(p, 0) * (before + n / 2)) - sum(p) * sum(p) / 2) / (sum(p) * (sum(n) - sum(p))) AS auc FROM ranked GROUP BY ALL), macro AS (SELECT r, avg(auc) AS v FROM auc GROUP BY 1)
    SELECT 'roc_auc_ovr' AS metric, round(quantile_cont(v, 0.025), 6) AS low, round(quantile_cont(v, 0.975), 6) AS high, count(v) AS defined_replicates FROM macro""")
def auc_intervals(t: Tables):
    scored = materialise(scored_predictions(t))
    return rounded_intervals(b.auc_bootstrap(scored, "city", "actual_tier", SCORES, REPLICATES, 6))


SCORES = {"Low": "score_low", "Mid": "score_mid", "High": "score_high"}


def scored_predictions(t: Tables):
    """Predictions with one score per class."""
    return predictions(t).withColumns({"score_low": -F.col("priced"), "score_mid": -F.abs(F.col("priced") - 150000), "score_high": F.col("priced")})


RULE_DRAWS = f"""{MASKS},{POSTINGS},{FIXED}, source AS (SELECT p.job_id, city, mask FROM postings p JOIN masks USING (job_id)), {draws('city', 42)},
sums AS (SELECT r, antecedents, consequents, sum(w) FILTER (mask & am = am) AS fa, sum(w) FILTER (mask & cm = cm) AS fc, sum(w) FILTER (mask & (am | cm) = (am | cm)) AS fb, sum(w) AS n
  FROM weights JOIN source ON city = grp, fixed GROUP BY ALL),
reps AS (SELECT r, antecedents, consequents, coalesce(fb, 0) / n AS support, coalesce(fb, 0) / fa AS confidence, coalesce(fb, 0) * n / (fa * fc) AS lift, coalesce(fc, 0) / n AS consequent_support, n / fc AS max_lift FROM sums)"""


def city_baskets(t: Tables):
    """Part types of every order with its city."""
    return postings(t).select("job_id", "city").join(baskets(t, "p_type"), "job_id")


@query("L7", f"""
    WITH {RULE_DRAWS} SELECT antecedents, consequents, metric, round(quantile_cont(v, 0.025), 6) AS low, round(quantile_cont(v, 0.975), 6) AS high, count(v) AS defined_replicates
    FROM (SELECT antecedents, consequents, unnest([struct_pack(m := 'support', v := support), struct_pack(m := 'confidence', v := confidence), struct_pack(m := 'lift', v := lift),
      struct_pack(m := 'consequent_support', v := consequent_support), struct_pack(m := 'max_lift', v := max_lift)]) AS e FROM reps), (SELECT 1), LATERAL (SELECT e.m AS metric, e.v AS v) GROUP BY ALL""")
def rule_intervals(t: Tables):
    return rounded_intervals(b.rule_bootstrap(city_baskets(t), "items", "city", fixed_rules(t), REPLICATES))


@query("L7", f"""
    WITH {RULE_DRAWS} SELECT antecedents, consequents, round(avg(CAST(coalesce(support >= 0.2 AND confidence > 0.35 AND lift > 1.0, false) AS INTEGER)), 6) AS pass_fraction_primary,
      round(avg(CAST(coalesce(support >= 0.05 AND confidence > 0.35 AND lift > 1.0, false) AS INTEGER)), 6) AS pass_fraction_sensitivity FROM reps GROUP BY ALL""")
def rule_pass_fractions(t: Tables):
    values = b.rule_replicates(city_baskets(t), "items", "city", fixed_rules(t), REPLICATES)
    out = b.rule_pass_fraction(values, {"primary": 0.2, "sensitivity": 0.05}, 0.35, 1.0)
    return out.withColumns({c: r6(c) for c in ("pass_fraction_primary", "pass_fraction_sensitivity")})


@query("J31", f"""
    WITH {RULE_DRAWS}, k AS (SELECT * FROM reps WHERE antecedents || '|' || consequents IN ('PROMO|SMALL', 'STANDARD|MEDIUM'))
    SELECT antecedents, consequents, round(quantile_cont(lift, 0.025), 6) AS lift_lower_bound, count(lift) AS defined_replicates FROM k GROUP BY ALL""")
def pair_lift_bounds(t: Tables):
    pairs = fixed_rules(t).filter(F.concat_ws("|", "antecedents", "consequents").isin("PROMO|SMALL", "STANDARD|MEDIUM")).select(F.col("antecedents").alias("a"), F.col("consequents").alias("b"))
    return b.pair_lift_bounds(city_baskets(t), "items", "city", pairs, REPLICATES, 42, 0.05).withColumn("lift_lower_bound", r6("lift_lower_bound"))

