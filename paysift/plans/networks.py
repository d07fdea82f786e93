"""Co-occurrence and similarity graphs over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as g
from ..scale import materialise
from .base import BASKET, POSTINGS, baskets, postings, r6
from .registry import Tables, query

PAIRS = f"""{BASKET}, single AS (SELECT item, count(*) AS c FROM basket GROUP BY 1), n AS (SELECT count(*) AS n FROM orders),
pairs AS (SELECT x.item AS a, y.item AS b, count(*) AS jobs FROM basket x JOIN basket y ON x.job_id = y.job_id AND x.item < y.item GROUP BY ALL),
edges AS (SELECT a, b, jobs, p.c AS ca, q.c AS cb, n, jobs / n AS support, (jobs * n) / (p.c * q.c) AS lift, jobs / (p.c + q.c - jobs) AS jaccard FROM pairs JOIN single p ON p.item = a JOIN single q ON q.item = b, n)"""
GRAPH = f"{PAIRS}, graph AS (SELECT * FROM edges WHERE support >= 0.018)"


def graph_edges(t: Tables):
    """Brand pairs in at least 1.8 % of orders."""
    return g.cooccurrence_edges(baskets(t), "items", 0.018)


@query("J17", f"WITH {GRAPH} SELECT a, b, jobs, round(support, 6) AS support, round(lift, 6) AS lift FROM graph")
def cooccurrence_graph(t: Tables):
    return graph_edges(t).select("a", "b", "jobs", r6("support").alias("support"), r6("lift").alias("lift"))


@query("J17 J18", f"""
    WITH {GRAPH}, ends AS (SELECT a AS node, ca AS c, n FROM graph UNION ALL SELECT b, cb, n FROM graph)
    SELECT node, max(c) AS jobs, round(max(c / n), 6) AS support, count(*) AS degree FROM ends GROUP BY 1 ORDER BY degree DESC, jobs DESC, node LIMIT 10""")
def graph_hubs(t: Tables):
    return g.hubs(graph_edges(t)).withColumn("support", r6("support"))


@query("J18", f"WITH {GRAPH} SELECT a, b, jobs, round(lift, 6) AS lift FROM graph WHERE lift >= 0.9 ORDER BY graph.lift DESC, jobs DESC, a, b LIMIT 10")
def strongest_edges(t: Tables):
    return g.strongest_edges(graph_edges(t), 10, 0.9).select("a", "b", "jobs", r6("lift").alias("lift"))


JACCARD = f"""{PAIRS}, top AS (SELECT item FROM single ORDER BY c DESC, item LIMIT 12),
sides AS (SELECT a AS node, b AS other, jobs, jaccard FROM edges WHERE a IN (SELECT item FROM top) AND b IN (SELECT item FROM top)
  UNION ALL SELECT b, a, jobs, jaccard FROM edges WHERE a IN (SELECT item FROM top) AND b IN (SELECT item FROM top)),
best AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY node ORDER BY jaccard DESC, jobs DESC, other) <= 2),
network AS (SELECT DISTINCT least(node, other) AS a, greatest(node, other) AS b, jobs, jaccard FROM best)"""


@query("J19", f"WITH {JACCARD} SELECT a, b, jobs, round(jaccard, 6) AS jaccard FROM network")
def jaccard_network(t: Tables):
    return g.jaccard_edges(baskets(t), "items", 12).select("a", "b", "jobs", r6("jaccard").alias("jaccard"))


@query("J19", f"""
    WITH {JACCARD},{POSTINGS}, c AS (SELECT item, industry, count(*) AS c FROM basket JOIN postings USING (job_id) GROUP BY ALL)
    SELECT t.item, industry FROM top t JOIN c USING (item) QUALIFY row_number() OVER (PARTITION BY t.item ORDER BY c DESC, industry) = 1""")
def node_majorities(t: Tables):
    listed = postings(t).select("job_id", "industry").join(baskets(t), "job_id")
    return g.majority_group(listed, "items", "industry", g.top_items(listed, "items", 12).select("item"))


@query("J20", f"""
    WITH {PAIRS}, sides AS (SELECT a AS item, b AS neighbour, jobs, ca AS c FROM edges UNION ALL SELECT b, a, jobs, cb FROM edges)
    SELECT item, neighbour, jobs, round(jobs / c, 6) AS share_among_selected FROM sides QUALIFY row_number() OVER (PARTITION BY item ORDER BY jobs DESC, neighbour) <= 6""")
def item_neighbours(t: Tables):
    return g.item_neighbours(baskets(t), "items").withColumn("share_among_selected", r6("share_among_selected"))


@query("J21", f"""
    WITH {PAIRS} SELECT CASE WHEN a = 'Brand#7' THEN b ELSE a END AS neighbour, jobs, round(jaccard, 6) AS jaccard FROM edges WHERE a = 'Brand#7' OR b = 'Brand#7'
    ORDER BY edges.jaccard DESC, jobs DESC, neighbour LIMIT 11""")
def item_neighbourhood(t: Tables):
    return g.item_neighbourhood(baskets(t), "items", "Brand#7").withColumn("jaccard", r6("jaccard"))


@query("J22", f"""
    WITH {JACCARD}, focus AS (SELECT min(a) AS f FROM network)
    SELECT CASE WHEN a = f THEN b ELSE a END AS neighbour, jobs, round(jaccard, 6) AS jaccard FROM network, focus WHERE a = f OR b = f""")
def network_neighbours(t: Tables):
    edges = materialise(g.jaccard_edges(baskets(t), "items", 12))
    focus = edges.agg(F.min("a")).scalar()
    return g.edge_neighbours(edges, focus).withColumn("jaccard", r6("jaccard"))


@query("J23", f"""
    WITH {BASKET},{POSTINGS}, b AS (SELECT job_id, item FROM basket JOIN postings USING (job_id) WHERE title = 'machinery low'), s AS (SELECT item, count(*) AS c FROM b GROUP BY 1),
    top AS (SELECT * FROM s ORDER BY c DESC, item LIMIT 12), p AS (SELECT x.item AS a, y.item AS b, count(*) AS jobs FROM b x JOIN b y ON x.job_id = y.job_id AND x.item < y.item GROUP BY ALL)
    SELECT a, p.b, jobs, round(jobs / (u.c + v.c - jobs), 6) AS jaccard FROM p JOIN top u ON u.item = a JOIN top v ON v.item = p.b ORDER BY jobs / (u.c + v.c - jobs) DESC, a, p.b LIMIT 18""")
def title_network(t: Tables):
    cohort = postings(t).filter("title = 'machinery low'").select("job_id").join(baskets(t), "job_id")
    return g.cohort_network(cohort, "items").withColumn("jaccard", r6("jaccard"))


@query("J24", f"""
    WITH {BASKET},{POSTINGS}, sizes AS (SELECT title, count(*) AS n FROM postings GROUP BY 1 HAVING count(*) >= 25),
    profile AS (SELECT title, item, n FROM postings JOIN basket USING (job_id) JOIN sizes USING (title) GROUP BY ALL HAVING count(*) >= 0.155 * n), s AS (SELECT title, count(*) AS c, any_value(n) AS n FROM profile GROUP BY 1),
    shared AS (SELECT x.title, y.title AS related, count(*) AS shared FROM profile x JOIN profile y ON x.item = y.item AND x.title <> y.title GROUP BY ALL)
    SELECT x.title, x.related, r.n AS related_jobs, x.shared, round(x.shared / (l.c + r.c - x.shared), 6) AS jaccard FROM shared x JOIN s l ON l.title = x.title JOIN s r ON r.title = x.related
    WHERE x.shared >= 2 AND x.shared / (l.c + r.c - x.shared) >= 0.25""")
def related_titles(t: Tables):
    listed = postings(t).select("job_id", "title").join(baskets(t), "job_id")
    return g.related_titles(listed, "title", "items", prevalence=0.155).withColumn("jaccard", r6("jaccard"))


@query("J25", f"WITH {POSTINGS} SELECT title, count(*) AS n, round(quantile_cont(salary, 0.5), 6) AS median_salary FROM postings GROUP BY 1")
def title_groups(t: Tables):
    return g.title_groups(postings(t), "title", "salary").withColumn("median_salary", r6("median_salary"))


@query("J25", f"""
    WITH {POSTINGS}, groups AS (SELECT title, count(*) AS n FROM postings GROUP BY 1), pool AS (SELECT title, n FROM groups WHERE title IN ('machinery low', 'building urgent') AND n >= 25)
    SELECT 'default' AS kind, title, n FROM (SELECT title, n FROM groups WHERE n >= 25 ORDER BY title <> 'furniture high', n DESC, title LIMIT 1) UNION ALL SELECT 'featured', title, n FROM pool""")
def chosen_titles(t: Tables):
    groups = materialise(g.title_groups(postings(t), "title", "salary"))
    first = g.default_title(groups, "title", "furniture high").select(F.lit("default").alias("kind"), "title", "n")
    pool = g.featured_pool(groups, "title", ["machinery low", "building urgent"]).select(F.lit("featured").alias("kind"), "title", "n")
    return first.unionByName(pool)
