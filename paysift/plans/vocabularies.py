"""Vocabulary building and text matching over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import form_pattern, is_ascii, join_items, split_clean
from ..functions.values import share
from ..operators import matching as m
from ..operators import vocabulary as v
from .base import BASKET, RAW_LISTS, basket_rows, baskets, r6, raw_lists
from .registry import Tables, query

SYNONYMS = {"hot ring": "hot bolt"}
EXCLUDED = ["old rod"]
FORCED = ["small anvil", "quantum widget"]
EXTRA = {"quantum widget": ["q widget", "quantum-widget"]}

SPELLINGS = f"""{RAW_LISTS},
forms AS (SELECT regexp_replace(regexp_replace(raw, '^[^a-z0-9]+', ''), '[^a-z0-9+#]+$', '') AS form, regexp_replace(raw, '[^a-z0-9+#]', '', 'g') AS k, count(*) AS n FROM raw_items GROUP BY ALL),
grouped AS (SELECT CASE k WHEN 'hotring' THEN 'hotbolt' ELSE k END AS grp, form, sum(n) AS job_count FROM forms WHERE k NOT IN ('oldrod', '') GROUP BY ALL),
shared AS (SELECT *, sum(job_count) OVER (PARTITION BY grp) AS group_count FROM grouped)"""


@query("H4 H11", f"""
    WITH {SPELLINGS} SELECT grp AS word_group, form, CAST(job_count AS BIGINT) AS job_count, round(job_count / group_count, 6) AS group_share, job_count >= 0.01 * group_count AS searched FROM shared""")
def spelling_groups(t: Tables):
    lists = raw_lists(t).select(split_clean("job_skills").alias("items"))
    g = v.spelling_groups(lists, "items", SYNONYMS, EXCLUDED)
    return g.select(F.col("group").alias("word_group"), "form", "job_count", r6(share("job_count", "group_count")).alias("group_share"), (F.col("searched") & is_ascii("form")).alias("searched"))


@query("I2 I3 C7 G11", f"""
    WITH {SPELLINGS},
    merged AS (SELECT grp, CASE grp WHEN 'hotbolt' THEN 'hot bolt' ELSE arg_min(form, (-job_count, form)) END AS skill, CAST(sum(job_count) AS BIGINT) AS job_count, count(*) AS n_variants,
                      string_agg(form, '; ' ORDER BY job_count DESC, form) FILTER (job_count >= 0.01 * group_count) AS forms FROM shared GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY job_count DESC, skill) <= 30 AS in_top FROM merged),
    chosen AS (
      SELECT skill, job_count, n_variants, CASE WHEN grp = 'smallanvil' THEN concat_ws('; ', 'small anvil', CASE WHEN forms <> 'small anvil' THEN replace(replace(forms, 'small anvil; ', ''), '; small anvil', '') END) ELSE forms END AS forms,
             grp = 'smallanvil' AS forced, in_top FROM ranked WHERE in_top OR grp = 'smallanvil'
      UNION ALL SELECT 'quantum widget', 0, 0, 'quantum widget; q widget; quantum-widget', true, false)
    SELECT skill, job_count, n_variants, forms, forced, CAST(row_number() OVER (ORDER BY in_top DESC, job_count DESC, skill) - 1 AS INTEGER) AS position FROM chosen""")
def vocabulary(t: Tables):
    lists = raw_lists(t).select(split_clean("job_skills").alias("items"))
    built = v.build_vocabulary(lists, "items", 30, SYNONYMS, EXCLUDED, FORCED, EXTRA, {})
    return built.select("skill", "job_count", "n_variants", join_items("forms").alias("forms"), "forced", "position")


# A small vocabulary of words frequent in the documents; some phrases contain other words.
WORDS = ["the", "of", "and", "la", "der", "que", "that", "of the", "in the", "de la"]
EXCLUSIONS = {"that": r"(?<![a-z0-9])that\s+the(?![a-z0-9])"}


def word_vocabulary(t: Tables):
    """The words as a vocabulary table."""
    rows = [(w, [w], i) for i, w in enumerate(WORDS)]
    return t.spark.createDataFrame(rows, "skill string, forms array<string>, position int").withColumn("pattern", form_pattern("forms"))


def word_matcher(t: Tables, exclusions=EXCLUSIONS) -> m.PhraseMatcher:
    """Matcher over the words."""
    return m.matcher_from(word_vocabulary(t), exclusions)


# RE2 has no look-around: every boundary character is doubled and then consumed instead.
MATCHED = r"""
t0 AS (SELECT doc_id, lang, regexp_replace(lower(text), '([^a-z0-9])', '\1\1', 'g') AS x FROM documents),
t1 AS (SELECT *, regexp_matches(x, '(^|[^a-z0-9])of[\s\-]*the($|[^a-z0-9])') AS of_the, regexp_replace(x, '(^|[^a-z0-9])of[\s\-]*the($|[^a-z0-9])', '\1 \2', 'g') AS y FROM t0),
t2 AS (SELECT *, regexp_matches(y, '(^|[^a-z0-9])in[\s\-]*the($|[^a-z0-9])') AS in_the, regexp_replace(y, '(^|[^a-z0-9])in[\s\-]*the($|[^a-z0-9])', '\1 \2', 'g') AS z FROM t1),
t3 AS (SELECT *, regexp_matches(z, '(^|[^a-z0-9])de[\s\-]*la($|[^a-z0-9])') AS de_la, regexp_replace(z, '(^|[^a-z0-9])de[\s\-]*la($|[^a-z0-9])', '\1 \2', 'g') AS w FROM t2),
t4 AS (SELECT *, regexp_replace(w, '(^|[^a-z0-9])that\s+the($|[^a-z0-9])', '\1 \2', 'g') AS u FROM t3),
matched AS (
  SELECT doc_id, lang, unnest([struct_pack(p := 0, s := 'the', hit := regexp_matches(w, '(^|[^a-z0-9])the($|[^a-z0-9])')), struct_pack(p := 1, s := 'of', hit := regexp_matches(w, '(^|[^a-z0-9])of($|[^a-z0-9])')),
    struct_pack(p := 2, s := 'and', hit := regexp_matches(w, '(^|[^a-z0-9])and($|[^a-z0-9])')), struct_pack(p := 3, s := 'la', hit := regexp_matches(w, '(^|[^a-z0-9])la($|[^a-z0-9])')),
    struct_pack(p := 4, s := 'der', hit := regexp_matches(w, '(^|[^a-z0-9])der($|[^a-z0-9])')), struct_pack(p := 5, s := 'que', hit := regexp_matches(w, '(^|[^a-z0-9])que($|[^a-z0-9])')),
    struct_pack(p := 6, s := 'that', hit := regexp_matches(u, '(^|[^a-z0-9])that($|[^a-z0-9])')), struct_pack(p := 7, s := 'of the', hit := of_the), struct_pack(p := 8, s := 'in the', hit := in_the),
    struct_pack(p := 9, s := 'de la', hit := de_la)]) AS e, regexp_matches(w, '(^|[^a-z0-9])that($|[^a-z0-9])') AS any_that FROM t4)"""


@query("I5 I6 U1 C10 S-21", f"""
    WITH {MATCHED} SELECT doc_id, coalesce(string_agg(e.s, '; ' ORDER BY e.p) FILTER (e.hit), '') AS matched FROM matched GROUP BY 1""")
def matched_words(t: Tables):
    return m.match_skills(t.documents.select("doc_id", "text"), "text", word_matcher(t)).select("doc_id", join_items("matched_skills").alias("matched"))


@query("I7", r"""
    WITH bench AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}+#]+') AS w FROM benchmark),
    terms AS (SELECT DISTINCT unnest(w) AS term FROM bench UNION SELECT DISTINCT w[i] || ' ' || w[i + 1] FROM bench, unnest(range(1, len(w))) r(i)),
    docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}+#]+') AS w FROM documents),
    one AS (SELECT doc_id, i, w[i] AS g FROM docs, unnest(range(1, len(w) + 1)) r(i)),
    two AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] AS g FROM docs, unnest(range(1, len(w))) r(i)),
    hit2 AS (SELECT doc_id, i, g FROM two WHERE g IN (SELECT term FROM terms)),
    covered AS (SELECT doc_id, i FROM hit2 UNION SELECT doc_id, i + 1 FROM hit2),
    hit1 AS (SELECT o.doc_id, o.g FROM one o ANTI JOIN covered c ON c.doc_id = o.doc_id AND c.i = o.i WHERE g IN (SELECT term FROM terms))
    SELECT g AS term, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, g FROM hit2 UNION ALL SELECT doc_id, g FROM hit1) GROUP BY 1""")
def matched_terms(t: Tables):
    words = F.regexp_extract_all(F.lower("text"), F.lit(m.TOKEN), F.lit(0))
    pairs = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get("w", i + 1)))
    terms = t.benchmark.select(words.alias("w")).select(F.explode(F.concat("w", pairs)).alias("form")).distinct().withColumn("term", F.col("form"))
    return m.match_terms(t.documents, "doc_id", "text", terms).groupBy("term").agg(F.count(F.lit(1)).alias("docs"))


@query("I8 I9", f"""
    WITH {MATCHED}, flags AS (SELECT m.doc_id, CASE WHEN quality IS NOT NULL THEN quality = 1 END AS label, any_that AS baseline, e.hit AS proposed
                              FROM matched m LEFT JOIN labels USING (doc_id) WHERE e.s = 'that'),
    long AS (SELECT 'baseline' AS variant, label, baseline AS p FROM flags WHERE label IS NOT NULL UNION ALL SELECT 'proposed', label, proposed FROM flags WHERE label IS NOT NULL)
    SELECT variant, s.skill, count(*) AS n, count(*) FILTER (label AND p) AS tp, count(*) FILTER (NOT label AND p) AS fp, count(*) FILTER (label AND NOT p) AS fn, count(*) FILTER (NOT label AND NOT p) AS tn,
           round(count(*) FILTER (label AND p) / nullif(count(*) FILTER (p), 0), 6) AS precision, round(count(*) FILTER (label AND p) / nullif(count(*) FILTER (label), 0), 6) AS recall
    FROM long, (VALUES ('all'), ('that')) s(skill) GROUP BY ALL""")
def extraction_scores(t: Tables):
    rows = t.documents.join(t.labels.select("doc_id", (F.col("quality") == 1).alias("label")), "doc_id", "left").select("doc_id", "text", "label", F.lit("that").alias("skill"))
    compared = m.extraction_comparison(rows, "text", "skill", word_matcher(t, {}), word_matcher(t, m.merged_exclusions({}, EXCLUSIONS)))
    long = compared.select("label", "skill", F.explode(F.array(F.struct(F.lit("baseline").alias("variant"), F.col("baseline").alias("p")),
                                                               F.struct(F.lit("proposed").alias("variant"), F.col("proposed").alias("p")))).alias("e")).select("label", "skill", "e.*")
    out = None
    for variant in ("baseline", "proposed"):
        part = m.label_scores(long.filter(F.col("variant") == variant), "label", "p", "skill").select(F.lit(variant).alias("variant"), "*")
        out = part if out is None else out.unionByName(part)
    return out.withColumns({"precision": r6("precision"), "recall": r6("recall")})


@query("I10", f"""
    WITH {BASKET}, c AS (SELECT item, count(*) AS n FROM basket GROUP BY 1)
    SELECT job_id, string_agg(item, '; ' ORDER BY item = 'Brand#11', item NOT LIKE '%#2%', n, item) AS items FROM basket JOIN c USING (item) GROUP BY 1""")
def items_ranked_for_display(t: Tables):
    counts = basket_rows(t).join(t.orders, F.col("job_id") == F.col("o_orderkey"), "left_semi").groupBy(F.col("item").alias("skill")).agg(F.count(F.lit(1)).alias("job_count"))
    listed = baskets(t).filter(F.size("items") > 0)
    ranked = m.rank_for_display(listed, "items", counts.withColumn("forced", F.col("skill").contains("#2")), ["Brand#11"])
    return ranked.select("job_id", join_items("items").alias("items"))


@query("I11", f"""
    WITH {BASKET}, o AS (SELECT o_orderkey, count(item) AS n, count(item) FILTER (item IN ('Brand#1', 'Brand#2')) AS tech FROM orders LEFT JOIN basket ON job_id = o_orderkey GROUP BY 1)
    SELECT count(*) AS postings, round(avg(n), 6) AS mean_items, round(avg(CAST(n > 0 AS INTEGER)), 6) AS share_any, round(avg(CAST(tech > 0 AS INTEGER)), 6) AS share_technical FROM o""")
def item_coverage(t: Tables):
    return m.coverage(baskets(t), "items", ["Brand#1", "Brand#2"]).withColumns({c: r6(c) for c in ("mean_items", "share_any", "share_technical")})


@query("I11", r"""
    SELECT DISTINCT skill FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}+#]+')) AS skill FROM benchmark)
    WHERE skill NOT IN (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}+#]+')) FROM documents)""")
def words_never_matched(t: Tables):
    words = F.regexp_extract_all(F.lower("text"), F.lit(m.TOKEN), F.lit(0))
    lists = t.documents.select(F.array_distinct(words).alias("items"))
    return m.never_matched(lists, "items", t.benchmark.select(F.explode(words).alias("skill")).distinct())


@query("I12")
def word_contexts(t: Tables):
    matched = m.match_skills(t.documents.select("doc_id", "text"), "text", word_matcher(t), "items")
    return m.context_audit(matched, "doc_id", "text", "items", word_vocabulary(t), top=8, samples=5)


@query("I12", r"""
    WITH docs AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}+#]+') AS w FROM documents), place AS (SELECT w, i FROM docs, unnest(range(1, len(w) + 1)) r(i) WHERE w[i] = 'the')
    SELECT side, word, count(*) AS n FROM (SELECT 'before' AS side, w[i - 1] AS word FROM place WHERE i > 1 UNION ALL SELECT 'after', w[i + 1] FROM place WHERE i < len(w)) GROUP BY ALL""")
def words_around(t: Tables):
    return m.neighbour_words(t.documents, "text", "the")


@query("I13", """
    WITH b AS (SELECT DISTINCT l_orderkey AS j, p_brand AS s FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R'),
    a AS (SELECT DISTINCT l_orderkey AS j, p_brand AS s FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N')
    SELECT coalesce(b.s, a.s) AS skill, count(b.s) AS before, count(a.s) AS after, count(*) FILTER (a.s IS NULL) AS dropped, count(*) FILTER (b.s IS NULL) AS added
    FROM b FULL JOIN a ON a.j = b.j AND a.s = b.s GROUP BY 1""")
def match_changes(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    lists = lambda flag: lines.filter(F.col("l_returnflag") != flag).groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))
    return m.match_changes(lists("R"), lists("N"), "l_orderkey", "items")
