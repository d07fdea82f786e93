"""Sources, sinks, snapshots and streaming: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.warehouse import check_star_schema, job_view
from ..scale import materialise
from ..session import scratch_path
from ..sources import readers, sinks
from ..sources import snapshots as s
from ..streaming.snapshots import ingest_pages
from .base import EVENT_POSTS, POSTINGS, RAW_PAY, event_posts, postings, r6, raw_pay
from .registry import Tables, query
from .starschema import star


def text_rows(t: Tables):
    """Raw pay fields as text, with a spelled-out missing value in one column."""
    return raw_pay(t).select(F.col("job_id").cast("string").alias("job_id"), F.concat(F.lit('a "'), "title", F.lit('",\nb')).alias("title"),
                             F.coalesce("currency", F.lit("N/A")).alias("currency"), F.when(F.col("normalized_salary").isNotNull(), F.format_string("%.3f", "normalized_salary")).alias("normalized_salary"))


CSV_SCHEMA = T.StructType([T.StructField("job_id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("currency", T.StringType()), T.StructField("normalized_salary", T.DoubleType())])


def write_csv(t: Tables, compression: str = "none") -> str:
    """Write the text rows as CSV; returns the path."""
    path = scratch_path(t.spark, "csv")
    text_rows(t).write.options(header=True, quote='"', escape='"', quoteAll=True, compression=compression, nullValue="").csv(path)
    return path


@query("A1 S-23 B1", f"""
    WITH {RAW_PAY} SELECT currency, count(*) AS n, count(normalized_salary) AS known, CAST(sum(CAST(normalized_salary AS DECIMAL(18,2))) AS DOUBLE) AS total FROM raw_pay GROUP BY 1""")
def csv_round_trip(t: Tables):
    df = readers.scan_csv(t.spark, write_csv(t), CSV_SCHEMA, ["currency", "normalized_salary"])
    return df.groupBy("currency").agg(F.count(F.lit(1)).alias("n"), F.count("normalized_salary").alias("known"), F.sum(F.col("normalized_salary").cast("decimal(18,2)")).cast("double").alias("total"))


@query("A14 C3", f"WITH {RAW_PAY} SELECT job_id, 'a \"' || title || '\",' || chr(10) || 'b' AS title, currency FROM raw_pay")
def gzip_csv_round_trip(t: Tables):
    return readers.scan_csv(t.spark, write_csv(t, "gzip"), CSV_SCHEMA, ["job_id", "title", "currency"])


@query("A5 S-23", f"""
    WITH {RAW_PAY} SELECT CAST(job_id AS VARCHAR) AS job_id, coalesce(currency, 'N/A') AS currency, coalesce(CAST(CAST(normalized_salary AS DECIMAL(18,3)) AS VARCHAR), '') AS normalized_salary FROM raw_pay""")
def lexical_round_trip(t: Tables):
    # A missing amount is written as an empty text.
    rows = text_rows(t).fillna("", ["normalized_salary"])
    path = scratch_path(t.spark, "csv")
    rows.write.options(header=True, quote='"', escape='"', quoteAll=True, emptyValue="").csv(path)
    return readers.scan_strings(t.spark, path, ["job_id", "title", "currency", "normalized_salary"]).drop("title")


@query("A2 D10", """
    SELECT 'orders' AS name, count(*) AS n, 'o_orderkey' AS found FROM orders UNION ALL SELECT 'nation', count(*), 'n_nationkey' FROM nation""")
def registry_scan(t: Tables):
    from ..operators.contracts import missing_columns

    entry = lambda name, keys: readers.Table(f"{t.folder}/{name}.parquet", getattr(t, name).schema, keys, format="parquet")
    registry = {"orders": entry("orders", ("o_orderkey", "o_lost")), "nation": entry("nation", ("n_nationkey",)), "absent": readers.Table(f"{t.folder}/absent.csv", CSV_SCHEMA, ("job_id",))}
    opened = readers.scan_registry(t.spark, registry)
    drift = missing_columns(opened, {n: e.keys for n, e in registry.items()})
    out = None
    for name, df in opened.items():
        found = ",".join(k for k in registry[name].keys if k not in drift.get(name, []))
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n", F.lit(found).alias("found"))
        out = row if out is None else out.unionByName(row)
    return out


def write_pages(t: Tables) -> str:
    """Orders as nested result pages of at most fifty postings; returns the path."""
    p = postings(t)
    named = lambda *cols: F.array(*[F.struct(c.alias("name")) for c in cols])
    company = F.when(F.col("status") != "P", F.struct(F.col("company_name").alias("name")))
    posting = F.struct(F.col("job_id").cast("string").alias("id"), F.col("title").alias("name"), company.alias("company"), named(F.col("city"), F.col("region")).alias("locations"),
                       F.concat(F.lit("<p>"), "industry", F.lit(" &amp; <b>"), "region", F.lit("</b></p>")).alias("contents"), named(F.col("experience_level")).alias("levels"),
                       named(F.col("industry")).alias("categories"), F.concat(F.date_format("posted", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("publication_date"),
                       F.struct(F.concat(F.lit("https://example.org/"), F.col("job_id").cast("string")).alias("landing_page")).alias("refs"))
    path = scratch_path(t.spark, "pages")
    pages = p.groupBy(F.floor(F.col("job_id") / 50)).agg(F.collect_list(posting).alias("results")).select("results", F.lit(1).alias("page_count"), F.size("results").alias("total"))
    pages.write.json(path)
    return path


@query("A6 C43", f"""
    WITH {POSTINGS} SELECT CAST(job_id AS VARCHAR) AS id, title AS name, CASE WHEN status <> 'P' THEN company_name END AS company, city || '; ' || region AS locations, industry || ' & ' || region AS description,
      experience_level AS levels, industry AS categories, strftime(posted, '%Y-%m-%d') AS published, 'https://example.org/' || job_id AS landing_page, len(string_split(industry || ' & ' || region, ' ')) AS description_words FROM postings""")
def flattened_pages(t: Tables):
    flat = readers.flatten_postings(readers.scan_json_pages(t.spark, write_pages(t), multi_line=False))
    joined = sinks.join_lists(flat, ["locations", "levels", "categories"])
    return joined.select("id", "name", "company", "locations", "description", "levels", "categories", F.substring("publication_date", 1, 10).alias("published"), "landing_page", "description_words")


@query("A7 A9", f"WITH {EVENT_POSTS} SELECT id, mean_salary FROM posts WHERE fetch_date = (SELECT max(fetch_date) FROM posts)")
def latest_snapshot(t: Tables):
    return s.scan_snapshot(event_posts(t)).select("id", "mean_salary")


@query("A7 A9", f"WITH {EVENT_POSTS} SELECT id, mean_salary FROM posts WHERE fetch_date = '2024-01-17'")
def chosen_snapshot(t: Tables):
    return s.scan_snapshot(event_posts(t), "2024-01-17").select("id", "mean_salary")


@query("A8", f"WITH {EVENT_POSTS} SELECT DISTINCT fetch_date FROM posts")
def snapshot_dates(t: Tables):
    return s.list_snapshots(event_posts(t))


SNAPSHOT_SCHEMA = "id bigint, company_name string, mean_salary double, fetch_date string"


@query("B3 S-28", f"""
    WITH {EVENT_POSTS} SELECT fetch_date, count(*) AS n, CAST(sum(CAST(mean_salary AS DECIMAL(18,2))) AS DOUBLE) AS total FROM posts WHERE fetch_date < '2024-01-20' OR job_title <> 'click' GROUP BY 1""")
def replaced_snapshots(t: Tables):
    posts = event_posts(t).select("id", "company_name", "mean_salary", "fetch_date", "job_title")
    path = scratch_path(t.spark, "snapshots")
    s.replace_snapshot(posts.drop("job_title"), path)
    newer = posts.filter((F.col("fetch_date") >= "2024-01-20") & (F.col("job_title") != "click")).drop("job_title")
    for _ in range(2):  # the second run must change nothing
        s.replace_snapshot(newer, path)
    stored = s.open_snapshots(t.spark, path, SNAPSHOT_SCHEMA)
    return stored.groupBy("fetch_date").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("mean_salary").cast("decimal(18,2)")).cast("double").alias("total"))


@query("B4", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def replaced_table(t: Tables):
    path = scratch_path(t.spark, "table")
    sinks.replace_table(t.orders, path)
    sinks.replace_table(t.orders.filter("o_orderpriority <> '5-LOW'"), path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("B5", f"WITH {EVENT_POSTS} SELECT id, company_name, CAST(NULL AS VARCHAR) AS state, '2024-01-01' AS fetch_date FROM posts")
def migrated_table(t: Tables):
    old = event_posts(t).select("id", "company_name", "k")
    return s.migrate_key(old, {"id": "bigint", "company_name": "string", "state": "string", "fetch_date": "string"}, default_date="2024-01-01")


@query("B2 D2 D3", f"""
    WITH {POSTINGS}, b AS (SELECT job_id, count(DISTINCT p_brand) + count(DISTINCT p_type) AS k FROM postings LEFT JOIN lineitem ON l_orderkey = job_id LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT count(*) AS jobs, CAST(sum(greatest(k, 1)) AS BIGINT) AS fact_rows FROM b""")
def stored_star_schema(t: Tables):
    _, items, places, fact = star(t)
    check_star_schema(fact, {"dim_skills": (items, "skill_id"), "dim_location": (places, "location_id")})
    root = scratch_path(t.spark, "star")
    sinks.write_star_schema({"job_postings": fact, "dim_skills": items, "dim_location": places}, root)
    stored = t.spark.read.parquet(f"{root}/job_postings")
    jobs = job_view(stored).agg(F.count(F.lit(1))).scalar()
    return stored.agg(F.count(F.lit(1)).alias("fact_rows")).select(jobs.alias("jobs"), "fact_rows")


@query("B8 D14", f"WITH {RAW_PAY} SELECT CAST(1 AS BIGINT) AS manifests, count(*) AS n_rows, true AS sorted FROM raw_pay")
def sorted_gzip_export(t: Tables):
    path = scratch_path(t.spark, "export")
    rows = materialise(text_rows(t).drop("title").withColumn("job_id", F.lpad("job_id", 20, "0")))
    sinks.write_sorted_gzip(rows, path, "job_id", files=4)
    again = t.spark.read.options(header=True).csv(path).select("job_id", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
    ranges = again.groupBy("file").agg(F.min("job_id").alias("lo"), F.max("job_id").alias("hi"))
    by_file = ranges.withColumn("before", F.lag("hi").over(Window.orderBy("file")))  # one row per file
    in_order = by_file.agg(F.count_if(F.col("before") >= F.col("lo")) == 0).scalar()
    manifest = sinks.file_manifest(t.spark, path, again)
    return manifest.groupBy().agg(F.count(F.lit(1)).alias("manifests"), F.max("rows").alias("n_rows")).select("*", in_order.alias("sorted"))


@query("B9", f"WITH {POSTINGS} SELECT industry, count(*) AS n, count(*) FILTER (status <> 'P') AS known FROM postings GROUP BY 1")
def facts_json_round_trip(t: Tables):
    path = scratch_path(t.spark, "facts")
    sinks.write_facts_json(postings(t).select("industry", F.when(F.col("status") == "P", float("nan")).otherwise(F.col("salary")).alias("salary")), path)
    return t.spark.read.schema("industry string, salary double").json(path).groupBy("industry").agg(F.count(F.lit(1)).alias("n"), F.count("salary").alias("known"))


@query("S1 A6 B3", f"WITH {EVENT_POSTS} SELECT fetch_date, count(*) AS n, round(avg(k), 6) AS mean_k FROM posts GROUP BY 1")
def streamed_snapshots(t: Tables):
    source, target, progress = (scratch_path(t.spark, x) for x in ("incoming", "target", "progress"))
    posts = event_posts(t).select("id", "company_name", "k", "fetch_date")
    schema = posts.schema
    posts.filter("fetch_date < '2024-01-20'").write.json(f"{source}/a")
    ingest_pages(t.spark, f"{source}/*", schema, target, progress=progress)
    # Later files repeat some postings and add the rest; only these files are read.
    posts.filter("fetch_date >= '2024-01-18'").write.json(f"{source}/b")
    ingest_pages(t.spark, f"{source}/*", schema, target, progress=progress)
    return s.open_snapshots(t.spark, target, SNAPSHOT_SCHEMA.replace("mean_salary double", "k int")).groupBy("fetch_date").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("k")).alias("mean_k"))


