"""Features, classifiers and metrics over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.values import lookup
from ..operators import features as f
from ..operators import metrics as m
from ..operators import models
from ..operators.joins import attach_joined_names
from ..operators.splits import grouped_design, hash_folds, stratified_split
from ..scale import materialise
from ..session import scratch_path
from .base import EXPERIENCE, POSTINGS, PREDICTIONS, TIERS, baskets, order_tiers, postings, predictions, r6
from .registry import Tables, query
from .splitting import SCORES, number, scored_predictions

BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def model_jobs(t: Tables):
    """Jobs in the columns the features need; industries are the supplier nations of an order."""
    p = postings(t)
    links = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("job_id"), F.col("s_nationkey").alias("code"))
    named = attach_joined_names(p.drop("industry"), links, t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")), "job_id", "code", "name")
    jobs = named.select("job_id", F.col("title").alias("job_title"), "company_name", lookup("experience_level", EXPERIENCE).alias("experience_level"), "industry")
    places = p.select("job_id", F.when(F.col("region") != "ASIA", F.col("city")).alias("state"))
    companies = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("job_id"), F.floor("c_acctbal").alias("employee_count"))
    framed = f.model_frame(jobs, places, companies)
    tiers = order_tiers(t).select("job_id", F.col("tier").alias("salary_tier"))
    return framed.join(tiers, "job_id").join(baskets(t, "p_brand", "matched_skills"), "job_id")


FRAME = f"""{POSTINGS},{TIERS},
frame AS (SELECT p.job_id, title AS job_title, company_name, experience_level, CASE WHEN region <> 'ASIA' THEN city END AS state, floor(c_acctbal) AS employee_count, tier AS salary_tier
  FROM postings p JOIN tiers USING (job_id) JOIN customer ON c_custkey = company_id),
links AS (SELECT DISTINCT l_orderkey AS job_id, n_name AS industry FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""


@query("K-1 E10 E14", f"""
    WITH {FRAME}, i AS (SELECT job_id, string_agg(industry, '; ' ORDER BY industry) AS industry FROM links GROUP BY 1)
    SELECT f.job_id, job_title, state, CAST(employee_count AS BIGINT) AS employee_count, coalesce(industry, 'Unknown') AS industry, salary_tier FROM frame f LEFT JOIN i USING (job_id)""")
def model_frame(t: Tables):
    return model_jobs(t).select("job_id", "job_title", "state", "employee_count", "industry", "salary_tier")


@query("K-2", f"""
    WITH {FRAME} SELECT * FROM (SELECT 'state' AS kind, state AS name FROM frame WHERE state IS NOT NULL GROUP BY state ORDER BY count(*) DESC, state LIMIT 8)
    UNION ALL SELECT * FROM (SELECT 'industry' AS kind, industry AS name FROM links GROUP BY industry ORDER BY count(*) DESC, industry LIMIT 6)""")
def top_categories(t: Tables):
    top = f.top_categories(model_jobs(t), states=8, industries=6)
    return t.spark.createDataFrame([("state", s) for s in top["states"]] + [("industry", i) for i in top["industries"]], "kind string, name string")


@query("K-0 K-3 K-5 U5", f"""
    WITH {FRAME}, top_states AS (SELECT state FROM frame WHERE state IS NOT NULL GROUP BY state ORDER BY count(*) DESC, state LIMIT 20), top_industries AS (SELECT industry FROM links GROUP BY industry ORDER BY count(*) DESC, industry LIMIT 15),
    items AS (SELECT DISTINCT l_orderkey AS job_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
    other AS (SELECT f.job_id FROM frame f LEFT JOIN links USING (job_id) GROUP BY 1 HAVING count(links.industry) = 0 OR count(*) FILTER (links.industry NOT IN (SELECT industry FROM top_industries)) > 0)
    SELECT 'experience_level' AS feature, CAST(sum(CASE experience_level WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 ELSE -1 END) AS DOUBLE) AS total FROM frame
    UNION ALL SELECT 'company_size', CAST(sum(CASE WHEN employee_count <= 0 THEN 0 WHEN employee_count <= 10 THEN 1 WHEN employee_count <= 50 THEN 2 WHEN employee_count <= 200 THEN 3 WHEN employee_count <= 500 THEN 4
      WHEN employee_count <= 1000 THEN 5 WHEN employee_count <= 5000 THEN 6 WHEN employee_count <= 10000 THEN 7 ELSE 8 END) AS DOUBLE) FROM frame
    UNION ALL SELECT 'skill_' || item, CAST(count(*) AS DOUBLE) FROM items GROUP BY 1 UNION ALL SELECT 'n_matched_skills', CAST(count(*) AS DOUBLE) FROM items
    UNION ALL SELECT 'state_' || s.state, CAST(count(*) AS DOUBLE) FROM top_states s JOIN frame f ON f.state = s.state GROUP BY 1
    UNION ALL SELECT 'state_Other', CAST(count(*) AS DOUBLE) FROM frame WHERE state IS NULL OR state NOT IN (SELECT state FROM top_states)
    UNION ALL SELECT 'industry_' || industry, CAST(count(*) AS DOUBLE) FROM links WHERE industry IN (SELECT industry FROM top_industries) GROUP BY 1 UNION ALL SELECT 'industry_Other', CAST(count(*) AS DOUBLE) FROM other""")
def feature_totals(t: Tables):
    jobs = materialise(model_jobs(t))
    model = f.PostingFeatures(skills=BRANDS).fit(jobs)
    names = F.array(*[F.lit(n) for n in model.feature_names])
    # The vector is as wide as the feature list.
    long = model.transform(jobs).select(F.posexplode(vector_to_array("features")).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("total"))
    return long.select(F.get(names, F.col("i")).alias("feature"), "total")


@query("K-4", f"""
    WITH {POSTINGS}, w AS (SELECT job_id, unnest(regexp_extract_all(title, '\\w\\w+')) AS word FROM postings), d AS (SELECT word, count(*) AS tf, count(DISTINCT job_id) AS df FROM w WHERE word <> 'not' GROUP BY 1 ORDER BY tf DESC, word LIMIT 8)
    SELECT word, round(ln((1 + (SELECT count(*) FROM postings)) / (1 + df)) + 1, 6) AS idf FROM d""")
def title_word_weights(t: Tables):
    words, idf = f.text_vocabulary(postings(t), "title", 8, ["not"])
    return t.spark.createDataFrame(list(zip(words, idf)), "word string, idf double").withColumn("idf", r6("idf"))


@query("K-4 K-5")
def text_feature_norms(t: Tables):
    jobs = materialise(model_jobs(t))
    model = f.PostingFeatures(skills=BRANDS, use_text=True).fit(jobs)
    x = vector_to_array("f_title")
    return model.transform(jobs).select("job_id", F.round(F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)), 6).alias("title_norm"))


@query("K-14 K-15 L6", f"""
    WITH {PREDICTIONS}, c AS (SELECT industry, count(*) AS n, {", ".join(f"count(*) FILTER (actual_tier = '{a}' AND predicted_tier = '{p}') AS n{i}{j}" for i, a in enumerate(("Low", "Mid", "High")) for j, p in enumerate(("Low", "Mid", "High")))} FROM predictions GROUP BY 1),
    s AS (SELECT *, 2 * n00 / (2 * n00 + n01 + n02 + n10 + n20) AS f0, 2 * n11 / (2 * n11 + n10 + n12 + n01 + n21) AS f1, 2 * n22 / (2 * n22 + n20 + n21 + n02 + n12) AS f2 FROM c)
    SELECT industry, n, round((n00 + n11 + n22) / n, 6) AS accuracy, round((f0 + f1 + f2) / 3, 6) AS macro_f1, round(f1, 6) AS f1_mid, round(n22 / (n20 + n21 + n22), 6) AS recall_high, round((n01 + n11 + n21) / n, 6) AS predicted_share_mid FROM s""")
def metrics_by_industry(t: Tables):
    out = m.classification_metrics(predictions(t), "actual_tier", "predicted_tier", ["industry"])
    return out.select("industry", "n", *[r6(c).alias(c) for c in ("accuracy", "macro_f1", "f1_mid", "recall_high", "predicted_share_mid")])


@query("K-14", f"""
    WITH {PREDICTIONS}, long AS (SELECT unnest([struct_pack(c := 'Low', v := -priced, p := actual_tier = 'Low'), struct_pack(c := 'Mid', v := -abs(priced - 150000), p := actual_tier = 'Mid'),
      struct_pack(c := 'High', v := priced, p := actual_tier = 'High')]) AS e FROM predictions),
    r AS (SELECT e.c AS c, e.p AS p, rank() OVER (PARTITION BY e.c ORDER BY e.v) + (count(*) OVER (PARTITION BY e.c, e.v) - 1) / 2.0 AS rank FROM long)
    SELECT c AS label, round((sum(rank) FILTER (p) - count(*) FILTER (p) * (count(*) FILTER (p) + 1) / 2.0) / (count(*) FILTER (p) * count(*) FILTER (NOT p)), 6) AS auc FROM r GROUP BY 1""")
def auc_per_class(t: Tables):
    return m.auc_ovr(scored_predictions(t), "actual_tier", SCORES).withColumn("auc", r6("auc"))


@query("K-16", f"""
    WITH {PREDICTIONS}, c AS (SELECT actual_tier AS actual, predicted_tier AS predicted, count(*) AS n FROM predictions GROUP BY ALL)
    SELECT a.l AS actual, p.l AS predicted, coalesce(n, 0) AS n, round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY a.l), 6) AS share
    FROM (VALUES ('Low'), ('Mid'), ('High')) a(l) CROSS JOIN (VALUES ('Low'), ('Mid'), ('High')) p(l) LEFT JOIN c ON actual = a.l AND predicted = p.l""")
def normalised_confusion(t: Tables):
    return m.normalised_confusion(m.confusion(predictions(t), "actual_tier", "predicted_tier")).withColumn("share", r6("share"))


@query("K-21", f"""
    WITH {PREDICTIONS} SELECT CASE WHEN status = 'P' THEN 'estimated' ELSE 'advertised' END AS subgroup, count(*) AS n, round(avg(CAST(actual_tier = predicted_tier AS INTEGER)), 6) AS accuracy FROM predictions GROUP BY 1""")
def subgroup_accuracy(t: Tables):
    flagged = predictions(t).withColumn("flag", F.when(F.col("status") == "P", "True").otherwise("0"))
    return m.subgroup_metrics(flagged, "actual_tier", "predicted_tier", "flag").select("subgroup", "n", r6("accuracy").alias("accuracy"))


@query("K-22", f"""
    WITH {PREDICTIONS}, ev AS (SELECT * FROM predictions WHERE industry = 'BUILDING'), tr AS (SELECT * FROM predictions WHERE industry <> 'BUILDING'),
    e AS (SELECT actual_tier AS l FROM ev GROUP BY 1 ORDER BY count(*) DESC, CASE actual_tier WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END LIMIT 1),
    h AS (SELECT actual_tier AS l FROM tr GROUP BY 1 ORDER BY count(*) DESC, CASE actual_tier WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END LIMIT 1)
    SELECT 'evaluation_majority' AS baseline, l AS label, round(avg(CAST(actual_tier = l AS INTEGER)), 6) AS accuracy FROM ev, e GROUP BY l
    UNION ALL SELECT 'training_majority', l, round(avg(CAST(actual_tier = l AS INTEGER)), 6) FROM ev, h GROUP BY l""")
def majority_baselines(t: Tables):
    scored = materialise(predictions(t))
    out = m.majority_baselines(scored.filter("industry = 'BUILDING'"), scored.filter("industry <> 'BUILDING'"), "actual_tier")
    return out.select("baseline", "label", r6("accuracy").alias("accuracy"))


@query("K-25", f"""
    WITH {PREDICTIONS}, s AS (SELECT actual_tier, {number('company_name', '11')} % 3 AS fold, exp(-priced / 100000) AS lo, exp(-abs(priced - 150000) / 100000) AS mi, 1 - exp(-priced / 300000) AS hi FROM predictions),
    p AS (SELECT actual_tier, fold, k, CASE WHEN lo >= mi * k AND lo >= hi THEN 'Low' WHEN mi * k >= hi THEN 'Mid' ELSE 'High' END AS q FROM s, (VALUES (1.0e0), (1.15e0), (1.3e0)) v(k)),
    f AS (SELECT k, fold, c, 2 * count(*) FILTER (actual_tier = c AND q = c) / nullif(count(*) FILTER (actual_tier = c) + count(*) FILTER (q = c), 0) AS f1 FROM p, (VALUES ('Low'), ('Mid'), ('High')) l(c) GROUP BY ALL),
    m AS (SELECT k, fold, sum(coalesce(f1, 0)) / 3 AS macro FROM f GROUP BY ALL) SELECT k AS multiplier, round(avg(macro), 6) AS mean_macro_f1 FROM m GROUP BY 1""")
def middle_multipliers(t: Tables):
    p = F.col("priced")
    scored = hash_folds(predictions(t), "company_name", 3, 11).withColumns({
        "score_low": F.exp(-p / 100000), "score_mid": F.exp(-F.abs(p - 150000) / 100000), "score_high": 1 - F.exp(-p / 300000)})
    return models.choose_multiplier(scored, "fold").withColumn("mean_macro_f1", r6("mean_macro_f1"))


def split_jobs(t: Tables):
    """Stored labelled jobs with outer role and inner fold, whole companies kept together."""
    jobs = models.labelled(model_jobs(t))
    return materialise(grouped_design(jobs, "company_name", "salary_tier"))


@query("K-9 K-10 K-11 K-12 K-13 K-14 K-17 K-17b")
def model_results(t: Tables):
    jobs = split_jobs(t)
    train, test = jobs.filter("outer_role = 'train'"), jobs.filter("outer_role = 'test'")
    fitted = {name: pipeline.fit(train) for name, pipeline in models.candidate_families(BRANDS).items()}
    return m.results_table(models.evaluate_candidates(fitted, train, test))


@query("K-8 L8 S-25")
def cv_selection(t: Tables):
    jobs = split_jobs(t).filter("outer_role = 'train'")
    candidates = {"logistic": models.with_features(models.logistic(max_iter=10), BRANDS), "ordinal_ridge": models.with_features(models.ordinal_ridge(), BRANDS, True)}
    forest = models.random_forest(5, depth=3)
    candidates["random_forest"] = models.with_features(forest, BRANDS)
    grids = {"random_forest": models.grid_for(forest[0], maxDepth=[2, 4])}
    return models.select_by_cv(jobs, candidates, "inner_fold", 3, grids)[1]


@query("K-18")
def feature_importance(t: Tables):
    jobs = materialise(models.labelled(model_jobs(t)))
    return models.feature_importance(models.with_features(models.random_forest(10, depth=4), BRANDS).fit(jobs))


@query("K-19")
def reloaded_model_agreement(t: Tables):
    jobs = materialise(models.labelled(model_jobs(t)))
    fitted = models.with_features(models.logistic(max_iter=5), BRANDS).fit(jobs)
    path = scratch_path(t.spark, "model")
    models.save_model(fitted, path, name="logistic")
    again, meta = models.load_model(path)
    a, b = (models.predictions(x, jobs).select("job_id", F.col("predicted_tier").alias(n)) for x, n in ((fitted, "before"), (again, "after")))
    return a.join(b, "job_id").groupBy((F.col("before") == F.col("after")).alias("same")).agg(F.count(F.lit(1)).alias("n")).withColumn("features", F.lit(len(meta["feature_names"])))


@query("K-20 K-21")
def live_predictions(t: Tables):
    jobs = materialise(models.labelled(model_jobs(t)).join(postings(t).select("job_id", F.col("salary").alias("mean_salary"), "status"), "job_id"))
    fitted = models.with_features(models.logistic(), BRANDS).fit(jobs.filter("status <> 'O'"))
    live = jobs.filter("status = 'O'").withColumn("salary_is_predicted", F.col("mean_salary") > 250000)
    return models.predict_live(fitted, live)


@query("K-24", f"""
    WITH {TIERS}, h AS (SELECT *, {number('job_id', '42')} AS h FROM tiers)
    SELECT job_id, tier, CASE WHEN count(*) OVER (PARTITION BY tier ORDER BY h) <= round(count(*) OVER (PARTITION BY tier) * 0.2) THEN 'test' ELSE 'train' END AS role, 'logistic' AS selected_model, 42 AS seed FROM h""")
def evaluation_manifest(t: Tables):
    split = stratified_split(order_tiers(t), "job_id", "tier", 42)
    return models.evaluation_manifest(split.withColumn("fold", F.lit(-1)), "job_id", "salary", "tier", "role", "fold", "logistic", 42).select("job_id", "tier", "role", "selected_model", "seed")


@query("K-23", f"""
    WITH {PREDICTIONS}, c AS (SELECT industry AS model, count(*) AS n, {", ".join(f"count(*) FILTER (actual_tier = '{a}' AND predicted_tier = '{p}') AS n{i}{j}" for i, a in enumerate(("Low", "Mid", "High")) for j, p in enumerate(("Low", "Mid", "High")))} FROM predictions GROUP BY 1),
    s AS (SELECT *, 2 * n11 / (2 * n11 + n10 + n12 + n01 + n21) AS f1, (2 * n00 / (2 * n00 + n01 + n02 + n10 + n20) + 2 * n11 / (2 * n11 + n10 + n12 + n01 + n21) + 2 * n22 / (2 * n22 + n20 + n21 + n02 + n12)) / 3 AS macro FROM c)
    SELECT a.model, round(a.macro - k.macro, 6) AS macro_vs_control, round(a.f1 - k.f1, 6) AS mid_vs_control, round(a.macro - b.macro, 6) AS macro_vs_reference,
           CASE WHEN a.f1 > k.f1 AND a.macro >= k.macro THEN 'helps' WHEN a.f1 > k.f1 THEN 'raises Mid by over-predicting it' ELSE 'does not help' END AS verdict
    FROM s a, s k, s b WHERE k.model = 'BUILDING' AND b.model = 'MACHINERY' AND a.model IN ('FURNITURE', 'HOUSEHOLD')""")
def ordinal_comparison(t: Tables):
    results = materialise(m.classification_metrics(predictions(t), "actual_tier", "predicted_tier", ["industry"]).withColumnRenamed("industry", "model"))
    out = m.ordinal_comparison(results, "BUILDING", "MACHINERY", ["FURNITURE", "HOUSEHOLD"])
    return out.select("model", *[r6(c).alias(c) for c in ("macro_vs_control", "mid_vs_control", "macro_vs_reference")], "verdict")

