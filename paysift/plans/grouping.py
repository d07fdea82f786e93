"""Clusters, neighbours and outliers over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.values import lookup
from ..operators import clustering as c
from ..operators import density as d
from ..operators import hotspots as h
from ..operators import neighbours as n
from ..operators import outliers as o
from ..operators.aggregates import item_shares
from ..scale import materialise
from .base import BASKET, EXPERIENCE, JOBS, POSTINGS, basket_rows, baskets, jobs, mining_jobs, postings, r6, with_tier
from .registry import Tables, query

BRANDS = [f"Brand#{i}" for i in range(1, 26)]

# Brand sets as 25-bit masks; distances between sets are bit counts.
BRAND_SETS = f"""{BASKET},
sets AS (SELECT job_id, bit_or(1 << (CAST(substr(item, 7) AS INTEGER) - 1)) AS mask FROM basket GROUP BY 1),
groups AS (SELECT mask, count(*) AS w, min(job_id) AS sid FROM sets GROUP BY 1)"""


@query("E16", """
    WITH p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    SELECT id AS vec_id, neighbour, round(dist, 5) AS distance, CAST(row_number() OVER (PARTITION BY id ORDER BY dist, neighbour) AS INTEGER) AS rank FROM p QUALIFY rank <= 10""")
def nearest_neighbours(t: Tables):
    return n.knn_join(t.embeddings, "vec_id", "embedding", 10).withColumn("distance", F.round("distance", 5))


@query("M14", """
    WITH p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS other, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist, b.vec_id AS neighbour FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    k AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, neighbour) <= 15), s AS (SELECT label, count(*) AS c FROM embeddings GROUP BY 1)
    SELECT round(avg(CAST(own = other AS INTEGER)), 6) AS purity, (SELECT round(sum(c * c) / (sum(c) * sum(c)), 6) FROM s) AS chance_purity FROM k""")
def neighbour_purity(t: Tables):
    near = n.knn_join(t.embeddings, "vec_id", "embedding", 15)
    chance = n.chance_purity(t.embeddings, "label").scalar()
    return n.label_purity(near, t.embeddings, "vec_id", "label").select(r6("purity").alias("purity"), r6(chance).alias("chance_purity"))


@query("M12 M14")
def compared_spaces(t: Tables):
    vectors = materialise(t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label").withColumn("features", array_to_vector("v")))
    flat, _ = c.pca_coordinates(vectors)
    return h.compare_spaces({"full": vectors.select("vec_id", "v"), "pca": flat.select("vec_id", F.col("coordinates").alias("v"))}, vectors, "vec_id", "v", ["label"], 15)


PAIR_DISTANCES = """
pairs AS (SELECT a.vec_id AS id, a.label AS label, b.label AS other, avg(DIST) FILTER (a.vec_id <> b.vec_id) AS m, count(*) AS c FROM embeddings a, embeddings b GROUP BY ALL),
s AS (SELECT id, label, max(m) FILTER (label = other) AS a, min(m) FILTER (label <> other) AS b, max(c) FILTER (label = other) AS own FROM pairs GROUP BY ALL)
SELECT round(avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 5) AS silhouette FROM s"""


@query("M2", "WITH" + PAIR_DISTANCES.replace("DIST", "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"))
def euclidean_silhouette(t: Tables):
    return n.silhouette(t.embeddings, "vec_id", "embedding", "label").withColumn("silhouette", F.round("silhouette", 5))


@query("M2", "WITH" + PAIR_DISTANCES.replace("DIST", "1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"))
def cosine_silhouette(t: Tables):
    return n.silhouette(t.embeddings, "vec_id", "embedding", "label", "cosine").withColumn("silhouette", F.round("silhouette", 5))


@query("M3", """
    WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), m AS (SELECT label, i, avg(v) AS m FROM x GROUP BY ALL),
    d AS (SELECT vec_id, label, sqrt(sum((v - m) * (v - m))) AS d FROM x JOIN m USING (label, i) GROUP BY ALL), s AS (SELECT label, avg(d) AS s FROM d GROUP BY 1),
    g AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS g FROM m a JOIN m b ON a.i = b.i AND a.label <> b.label GROUP BY ALL),
    r AS (SELECT a, max((x.s + y.s) / g) AS r FROM g JOIN s x ON x.label = a JOIN s y ON y.label = b GROUP BY 1) SELECT round(avg(r), 5) AS davies_bouldin FROM r""")
def davies_bouldin(t: Tables):
    return c.davies_bouldin(t.embeddings, "embedding", "label").withColumn("davies_bouldin", F.round("davies_bouldin", 5))


@query("M4 S-26", f"""
    WITH {BRAND_SETS}, dist AS (SELECT a.mask, bit_count(xor(a.mask, b.mask)) AS dd, sum(b.w) AS w FROM groups a, groups b GROUP BY ALL),
    cum AS (SELECT mask, dd, sum(w) OVER (PARTITION BY mask ORDER BY dd) AS c FROM dist), k AS (SELECT mask, min(dd) AS kd FROM cum WHERE c >= 20 GROUP BY 1)
    SELECT kd AS k_distance_sq, count(*) AS n FROM sets JOIN k USING (mask) GROUP BY 1""")
def set_k_distances(t: Tables):
    return d.set_k_distances(baskets(t), "job_id", "items", 20).groupBy("k_distance_sq").agg(F.count(F.lit(1)).alias("n"))


@query("M5", f"""
    WITH {BRAND_SETS}, dist AS (SELECT a.mask, bit_count(xor(a.mask, b.mask)) AS dd, sum(b.w) AS w FROM groups a, groups b GROUP BY ALL),
    cum AS (SELECT mask, dd, sum(w) OVER (PARTITION BY mask ORDER BY dd) AS c FROM dist), k AS (SELECT mask, min(dd) AS kd FROM cum WHERE c >= 20 GROUP BY 1), r AS (SELECT kd FROM sets JOIN k USING (mask))
    SELECT DISTINCT kd AS k_distance_sq, round(sqrt(kd) + 1e-6, 6) AS eps FROM r, (SELECT quantile_cont(sqrt(kd), 0.1) AS lo, quantile_cont(sqrt(kd), 0.9) AS hi FROM r) WHERE sqrt(kd) >= lo - 1e-6 AND sqrt(kd) <= hi + 1e-6""")
def radius_candidates(t: Tables):
    distances = materialise(d.set_k_distances(baskets(t), "job_id", "items", 20))
    return d.eps_candidates(distances).withColumn("eps", r6("eps"))


@query("M6 E17 S-27", f"""
    WITH RECURSIVE {BRAND_SETS}, near AS (SELECT a.mask AS a, b.mask AS b, b.w FROM groups a JOIN groups b ON bit_count(xor(a.mask, b.mask)) <= 1),
    core AS (SELECT a AS mask FROM near GROUP BY 1 HAVING sum(w) >= 60), links AS (SELECT a, b FROM near WHERE a IN (SELECT mask FROM core) AND b IN (SELECT mask FROM core)),
    reach AS (SELECT mask AS a, mask AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b), comp AS (SELECT a AS mask, min(sid) AS root FROM reach JOIN groups ON groups.mask = b GROUP BY 1),
    numbered AS (SELECT mask, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM comp), border AS (SELECT a AS mask, min(cluster) AS cluster FROM near JOIN numbered ON numbered.mask = b WHERE a NOT IN (SELECT mask FROM core) GROUP BY 1)
    SELECT o_orderkey AS job_id, CAST(coalesce(x.cluster, y.cluster, -1) AS INTEGER) AS cluster, x.cluster IS NOT NULL AS core
    FROM orders LEFT JOIN sets ON job_id = o_orderkey LEFT JOIN numbered x ON x.mask = sets.mask LEFT JOIN border y ON y.mask = sets.mask""")
def density_clusters(t: Tables):
    return d.dbscan_sets(baskets(t), "job_id", "items", 1.0, 60)


@query("M6", """
    WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer), near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON abs(a.x - b.x) <= 1.05 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 1.1025),
    core AS (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= 22), reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b JOIN core ON core.id = n.b),
    comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY 1), numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM comp),
    border AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN numbered ON numbered.id = b WHERE a NOT IN (SELECT id FROM core) GROUP BY 1)
    SELECT p.id AS c_custkey, CAST(coalesce(x.cluster, y.cluster, -1) AS INTEGER) AS cluster, x.cluster IS NOT NULL AS core FROM p LEFT JOIN numbered x USING (id) LEFT JOIN border y USING (id)""")
def point_clusters(t: Tables):
    points = t.customer.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").alias("y"))
    return d.dbscan_points(points, "c_custkey", ["x", "y"], 1.05, 22)


@query("M7")
def tuned_density(t: Tables):
    lists = materialise(baskets(t).filter(F.size("items") > 0))
    vectors = c.multi_hot(lists, "items", BRANDS, "v").select("job_id", "v")
    score = lambda labels: t.spark.createDataFrame([(c.fast_silhouette(vectors.join(labels, "job_id").filter("cluster >= 0"), "v"),)], "silhouette double")
    table = d.tune_dbscan(lists, "job_id", "items", min_samples=60, silhouette_of=score)
    return table.join(d.pick_density_run(table).select("eps", F.lit(True).alias("chosen")), "eps", "left").fillna(False, ["chosen"])


@query("M1 M2 M3")
def kmeans_sweep(t: Tables):
    vectors = materialise(c.vector_column(t.embeddings, "embedding"))
    return c.kmeans_sweep(vectors, "vec_id", range(3, 6), restarts=2)[0]


@query("M11")
def compared_representations(t: Tables):
    lists = materialise(baskets(t, "p_type").filter(F.size("items") > 0))
    return c.compare_representations(lists, "job_id", "items", ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], 3, restarts=1)


def clustered(t: Tables):
    """Jobs with a fixed label: the customer's region number, and -1 for the last one."""
    regions = t.region.select(F.col("r_name").alias("region"), F.when(F.col("r_regionkey") == 4, -1).otherwise(F.col("r_regionkey")).alias("cluster"))
    return materialise(jobs(t).join(regions, "region"))


CLUSTERED = f"""{JOBS},
clustered AS (SELECT j.*, CASE WHEN r_regionkey = 4 THEN -1 ELSE r_regionkey END AS cluster FROM jobs j JOIN region ON r_name = j.region),
sizes AS (SELECT cluster, count(*) AS size FROM clustered GROUP BY 1), overall AS (SELECT item, count(*) AS c FROM basket GROUP BY 1),
shares AS (SELECT cluster, item, count(*) / any_value(size) AS s, any_value(c) / (SELECT count(*) FROM clustered) AS o FROM clustered JOIN basket USING (job_id) JOIN sizes USING (cluster) JOIN overall USING (item) WHERE cluster >= 0 GROUP BY ALL),
eligible AS (SELECT *, s / o AS lift, s >= 0.15 AND s / o > 1 AS e FROM shares), marked AS (SELECT *, max(CAST(e AS INTEGER)) OVER (PARTITION BY cluster) = 1 AS over_represented FROM eligible),
defining AS (SELECT cluster, item, s, o, lift, over_represented, CAST(row_number() OVER (PARTITION BY cluster ORDER BY CASE WHEN over_represented THEN lift ELSE s END DESC, s DESC, item) AS INTEGER) AS rank
  FROM marked WHERE e OR NOT over_represented QUALIFY rank <= 5)"""


@query("M8 M24", f"WITH {CLUSTERED} SELECT cluster, item, round(s, 6) AS share_in_cluster, round(o, 6) AS share_overall, round(lift, 6) AS lift, over_represented, rank FROM defining")
def defining_items(t: Tables):
    return c.defining_items(clustered(t), "items", "cluster").withColumns({x: r6(x) for x in ("share_in_cluster", "share_overall", "lift")})


THEMES = [("Brand#1", "ones", 0), ("Brand#2", "twos", 1), ("Brand#3", "others", 2), ("Brand#4", "others", 2)] + [(f"Brand#{i}", "ones" if i < 20 else "twos", 0 if i < 20 else 1) for i in range(10, 26)]


@query("M9", f"""
    WITH {CLUSTERED}, themed AS (SELECT *, CASE WHEN item IN ('Brand#3', 'Brand#4') THEN 'others' WHEN item LIKE 'Brand#2%' THEN 'twos' WHEN item LIKE 'Brand#1%' THEN 'ones' END AS theme FROM defining),
    scores AS (SELECT cluster, theme, sum(lift * s) AS x, CASE theme WHEN 'ones' THEN 0 WHEN 'twos' THEN 1 ELSE 2 END AS p FROM themed WHERE theme IS NOT NULL GROUP BY ALL),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY x DESC, p) = 1),
    named AS (SELECT d.cluster, item, CASE WHEN NOT over_represented THEN 'Generalist (few listed skills)' ELSE coalesce(theme, 'General Professional') END AS name FROM defining d LEFT JOIN best USING (cluster) WHERE rank = 1)
    SELECT cluster, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' (' || item || ')' ELSE name END AS cluster_name FROM named""")
def cluster_names(t: Tables):
    return c.name_clusters(c.defining_items(clustered(t), "items", "cluster"), "cluster", THEMES)


@query("M10 M23", f"""
    WITH {CLUSTERED}, k AS (SELECT job_id, count(*) AS k FROM basket GROUP BY 1)
    SELECT cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM clustered), 6) AS share, round(avg(salary), 4) AS avg_salary, round(quantile_cont(salary, 0.5), 6) AS median_salary, round(avg(coalesce(k, 0)), 6) AS mean_items,
           round(avg(CAST(tier = 'Low' AS INTEGER)), 6) AS share_low, round(avg(CAST(tier = 'Mid' AS INTEGER)), 6) AS share_mid, round(avg(CAST(tier = 'High' AS INTEGER)), 6) AS share_high
    FROM clustered LEFT JOIN k USING (job_id) GROUP BY 1""")
def cluster_profiles(t: Tables):
    out = c.cluster_profiles(clustered(t), "cluster", "items", "salary", "tier")
    return out.withColumns({"avg_salary": F.round("avg_salary", 4), **{x: r6(x) for x in ("share", "median_salary", "mean_items", "share_low", "share_mid", "share_high")}})


@query("M10 H9", f"""
    WITH {CLUSTERED}, t AS (SELECT cluster, title, count(*) AS n FROM clustered GROUP BY ALL) SELECT cluster, title, n, CAST(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, title) AS INTEGER) AS rank FROM t QUALIFY rank <= 5""")
def cluster_titles(t: Tables):
    return c.top_titles(clustered(t).select("cluster", "title"), "cluster", "title")


@query("M22", f"""
    WITH {CLUSTERED}, chosen AS (SELECT DISTINCT item FROM (SELECT *, CASE WHEN s >= 0.15 AND s / (o2 / (SELECT sum(size) FROM sizes WHERE cluster >= 0)) > 1 THEN s / (o2 / (SELECT sum(size) FROM sizes WHERE cluster >= 0)) END AS l
      FROM (SELECT cluster, item, s, sum(s * size) OVER (PARTITION BY item) AS o2 FROM shares JOIN sizes USING (cluster))) WHERE l IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY l DESC, s DESC, item) <= 5)
    SELECT cluster, item, round(s, 6) AS share FROM shares WHERE item IN (SELECT item FROM chosen)""")
def cluster_heatmap(t: Tables):
    return c.cluster_heatmap(clustered(t), "items", "cluster").withColumn("share", r6("share"))


@query("M23 M24", f"WITH {CLUSTERED} SELECT cluster, round(quantile_cont(salary, 0.5), 6) AS median_salary FROM clustered WHERE cluster >= 0 GROUP BY 1")
def clusters_by_salary(t: Tables):
    return c.cluster_order(clustered(t), "cluster", "salary").withColumn("median_salary", r6("median_salary"))


@query("M21", f"""
    WITH {POSTINGS}, ct AS (SELECT region, industry, count(*) AS n FROM postings GROUP BY ALL), s AS (SELECT sum(n * (n - 1) / 2) AS x FROM ct),
    a AS (SELECT sum(n * (n - 1) / 2) AS x FROM (SELECT sum(n) AS n FROM ct GROUP BY region)), b AS (SELECT sum(n * (n - 1) / 2) AS x FROM (SELECT sum(n) AS n FROM ct GROUP BY industry)), t AS (SELECT sum(n) AS n FROM ct)
    SELECT round((s.x - a.x * b.x / (n * (n - 1) / 2)) / ((a.x + b.x) / 2 - a.x * b.x / (n * (n - 1) / 2)), 6) AS adjusted_rand_index FROM s, a, b, t""")
def adjusted_rand_index(t: Tables):
    return c.adjusted_rand_index(postings(t), "region", "industry").withColumn("adjusted_rand_index", r6("adjusted_rand_index"))


@query("M20 M21")
def robustness_summary(t: Tables):
    lists = baskets(t, "p_type")
    return c.robustness_grid(lists, "job_id", "items", ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], ks=(3,), seeds=(42, 43), components=3, max_iter=20)[1]


@query("M11 M17")
def singular_coordinates(t: Tables):
    rows = c.svd_rows(baskets(t), "job_id", "items", 5)
    return rows.select("job_id", F.transform("coordinates", lambda x: F.round(x, 6)).alias("coordinates"))


@query("M11", """
    WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS job_id, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey), gram AS (SELECT a.item AS i, b.item AS j, CAST(count(*) AS DOUBLE) AS x FROM b a JOIN b USING (job_id) GROUP BY ALL),
    m AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(x ORDER BY j) AS r FROM gram GROUP BY i)), it AS (SELECT 0 AS s, (SELECT list_transform(m[1], lambda x: CAST(1 AS DOUBLE)) FROM m) AS v, CAST(0 AS DOUBLE) AS l
      UNION ALL SELECT s + 1, list_transform(w, lambda c: c / sqrt(list_dot_product(w, w))), sqrt(list_dot_product(w, w)) FROM (SELECT s, list_transform((SELECT m FROM m), lambda r: list_dot_product(r, v)) AS w FROM it WHERE s < 100))
    SELECT round(l / (SELECT sum(x) FROM gram WHERE i = j), 6) AS leading_share FROM it WHERE s = 100""")
def leading_share(t: Tables):
    long = materialise(basket_rows(t, "p_type").select("job_id", "item", F.lit(1.0).alias("x")))
    return t.spark.createDataFrame([(round(c.singular_basis(long, "job_id", 1)[1], 6),)], "leading_share double")


@query("M12")
def principal_coordinates(t: Tables):
    vectors = materialise(c.vector_column(t.embeddings, "embedding"))
    flat, explained = c.pca_coordinates(vectors)
    return flat.select("vec_id", F.get("coordinates", F.lit(0)).alias("x"), F.get("coordinates", F.lit(1)).alias("y"), F.lit(explained).alias("explained"))


def outlier_jobs(t: Tables):
    """Mining jobs with place, experience names and the two feature sets."""
    base = mining_jobs(t).join(postings(t).select("job_id", "city", "company_name", lookup("experience_level", EXPERIENCE).alias("experience")), "job_id")
    return materialise(base)


@query("M16 M17 U6")
def isolation_flags(t: Tables):
    features = o.outlier_features(outlier_jobs(t), "items", BRANDS, "experience", "salary")
    return o.isolation_forest(features, "job_id", "x", trees=100).select("job_id", "anomaly_score", "flagged")


@query("M16 M17 M18")
def outlier_overlap(t: Tables):
    base = outlier_jobs(t).select("job_id", "items", "experience", "salary")
    main = o.isolation_forest(o.outlier_features(base, "items", BRANDS, "experience", "salary").select("job_id", "x"), "job_id", "x", trees=50).select("job_id", "flagged", "anomaly_score")
    compact = o.isolation_forest(o.compact_features(base, "job_id", "items", "experience", "salary", 5).select("job_id", "x"), "job_id", "x", trees=50).select("job_id", F.col("flagged").alias("compact"))
    both = materialise(base.select("job_id", F.size("items").alias("n_items"), "salary").join(main, "job_id").join(compact, "job_id"))
    drivers = o.score_drivers(both, "anomaly_score", ["n_items", "salary"])
    overlap = o.flag_overlap(both, "flagged", "compact")
    return drivers.select("input", "spearman", *[x.alias(y) for x, y in zip([overlap.select("overlap").scalar()], ["overlap"])])


FLAGGED = f"""{JOBS}, listed AS (SELECT job_id, count(*) AS k FROM basket GROUP BY 1),
scored AS (SELECT j.*, coalesce(k, 0) AS k, coalesce((ln(salary) - avg(ln(salary)) OVER g) / nullif(stddev_samp(ln(salary)) OVER g, 0), 0) AS z FROM jobs j LEFT JOIN listed USING (job_id) WINDOW g AS (PARTITION BY city)),
flags AS (SELECT *, k >= 7 AS flagged, salary > 480000 AS rich FROM scored)"""


def flagged_jobs(t: Tables):
    """Jobs with fixed flags (many items, high salary) and their salary mismatch."""
    z = o.salary_mismatch(jobs(t), "salary", ["city"])
    return materialise(z).withColumns({"flagged": F.size("items") >= 7, "rich": F.col("salary") > 480000})


@query("M18 M19", f"""
    WITH {FLAGGED}, long AS (SELECT 'all' AS grp, * FROM flags UNION ALL SELECT 'flagged', * FROM flags WHERE flagged UNION ALL SELECT 'rich', * FROM flags WHERE rich)
    SELECT grp AS "group", count(*) AS jobs, round(avg(k), 6) AS mean_items, round(avg(CAST(tier = 'High' AS INTEGER)), 6) AS share_high, round(avg(CAST(abs(z) > 2 AS INTEGER)), 6) AS mismatch_share,
           round(avg(CAST(z < -2 AS INTEGER)), 6) AS low_for_profile, round(quantile_cont(salary, 0.5), 6) AS median_salary FROM long GROUP BY 1""")
def flagged_comparison(t: Tables):
    out = o.compare_flagged(flagged_jobs(t), "items", "salary", "tier", "z", {"flagged": F.col("flagged"), "rich": F.col("rich")})
    return out.select("group", "jobs", *[r6(x).alias(x) for x in ("mean_items", "share_high", "mismatch_share", "low_for_profile", "median_salary")])


@query("M18", f"""
    WITH {FLAGGED}, n AS (SELECT count(*) AS n, count(*) FILTER (flagged) AS f FROM flags), i AS (SELECT item, count(*) AS c, count(*) FILTER (flagged) AS f FROM flags JOIN basket USING (job_id) GROUP BY 1)
    SELECT item, round(i.f / n.f, 6) AS share_flagged, round((i.f / n.f) / (c / n), 6) AS lift FROM i, n WHERE i.f / n.f >= 0.25""")
def flagged_items(t: Tables):
    return o.flagged_items(flagged_jobs(t), "items", "flagged").withColumns({"share_flagged": r6("share_flagged"), "lift": r6("lift")})


@query("M18", f"""
    WITH {FLAGGED} SELECT experience_level, round(count(*) / (SELECT count(*) FROM flags), 6) AS share_all, round(count(*) FILTER (flagged) / (SELECT count(*) FROM flags WHERE flagged), 6) AS share_flagged FROM flags GROUP BY 1""")
def flagged_experience(t: Tables):
    return o.flagged_mix(flagged_jobs(t), "experience_level", "flagged").withColumns({"share_all": r6("share_all"), "share_flagged": r6("share_flagged")})


@query("M18", f"""
    WITH {FLAGGED} SELECT count(*) FILTER (flagged) AS flagged_first, count(*) FILTER (rich) AS flagged_second, round(count(*) FILTER (flagged AND rich) / count(*) FILTER (flagged), 6) AS overlap FROM flags""")
def flag_overlap(t: Tables):
    return o.flag_overlap(flagged_jobs(t), "flagged", "rich").withColumn("overlap", r6("overlap"))


@query("M15")
def high_tier_hotspots(t: Tables):
    points = with_tier(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").cast("double").alias("y")), "c_acctbal")
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_set("p_type")).alias("items"))
    points = materialise(points.join(bought, "c_custkey", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
    spots = h.high_tier_hotspots(points, "c_custkey", ["x", "y"], "tier", 30, 0.7, 1.05, 20)
    return h.describe_hotspots(points, materialise(spots), "c_custkey", ["x", "y"], "tier", "nation", "items", "c_mktsegment", item_shares(points, "items"))


