"""Sources, sinks, snapshots, star schema and streaming."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysift.operators import warehouse as w
from paysift.operators.contracts import ContractError
from paysift.session import scratch_path
from paysift.sources import readers, sinks
from paysift.sources import snapshots as s
from paysift.streaming.snapshots import ingest_pages, merge_pages


def test_csv_reads_quotes_breaks_and_missing_tokens(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([("id,text,n",), ('1,"a ""b"",',), ('c",2.5',), ("2,N/A,",), ("3,,NaN",)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.DoubleType())])
    rows = {r["id"]: r for r in readers.scan_csv(spark, path, schema).collect()}
    assert rows[1]["text"] == 'a "b",\nc' and rows[1]["n"] == 2.5 and rows[2]["text"] is None and rows[3]["text"] is None
    texts = {r["id"]: (r["text"], r["n"]) for r in readers.scan_strings(spark, path, ["id", "text", "n"]).collect()}
    assert texts["2"] == ("N/A", "") and texts["3"] == ("", "NaN")


def test_replace_snapshot_is_idempotent(spark):
    path = scratch_path(spark, "t-snap")
    make = lambda rows: spark.createDataFrame(rows, "id string, v int, fetch_date string")
    s.replace_snapshot(make([("1", 1, "D1"), ("2", 2, "D1"), ("1", 3, "D2"), ("2", 4, "D2")]), path)
    for _ in range(2):
        s.replace_snapshot(make([("3", 9, "D2")]), path)
        stored = s.open_snapshots(spark, path, "id string, v int, fetch_date string")
        assert sorted((r["id"], r["v"], r["fetch_date"]) for r in stored.collect()) == [("1", 1, "D1"), ("2", 2, "D1"), ("3", 9, "D2")]
    assert s.resolve_snapshot(stored) == "D2" and s.scan_snapshot(stored, "D1").count() == 2
    with pytest.raises(ValueError):
        s.resolve_snapshot(stored, "D9")
    assert s.open_snapshots(spark, path + "-none", "id string").count() == 0


def test_merge_pages_replaces_only_named_postings(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, v int, fetch_date string")
    got = merge_pages(make([("1", 5, "D1"), ("1", 6, "D1"), ("4", 7, "D2")]), make([("1", 1, "D1"), ("2", 2, "D1"), ("9", 9, "D3")]), "id", "fetch_date")
    assert sorted(tuple(r) for r in got.select("id", "v", "fetch_date").collect()) == [("1", 5, "D1"), ("2", 2, "D1"), ("4", 7, "D2")]


def test_stream_reads_each_file_once(spark):
    source, target, progress = (scratch_path(spark, x) for x in ("t-in", "t-out", "t-progress"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("fetch_date", T.StringType())])
    put = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{source}/{name}")
    state = lambda: sorted((r["id"], r["v"]) for r in s.open_snapshots(spark, target, "id string, v bigint, fetch_date string").collect())
    put([("1", 1, "D1"), ("2", 2, "D1")], "a")
    ingest_pages(spark, f"{source}/*", schema, target, progress=progress)
    assert state() == [("1", 1), ("2", 2)]
    put([("2", 5, "D1"), ("3", 3, "D2")], "b")
    ingest_pages(spark, f"{source}/*", schema, target, progress=progress)
    assert state() == [("1", 1), ("2", 5), ("3", 3)]


def test_writes_refuse_existing_paths(spark):
    path = scratch_path(spark, "t-fresh")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_table(spark.range(3), path)


def test_gzip_export_is_sorted_and_reproducible(spark):
    df = spark.range(500).select(F.format_string("%05d", F.col("id") * 37 % 500).alias("k"), F.lit("x").alias("v")).repartition(7)
    hashes = []
    for _ in range(2):
        path = scratch_path(spark, "t-gz")
        sinks.write_sorted_gzip(df, path, "k", files=3)
        hashes.append(sorted(r["sha256"] for r in sinks.file_fingerprints(spark, path).filter("file like 'part%'").collect()))
        text = [r["value"] for r in spark.read.text(path).collect() if not r["value"].startswith("k,")]
        assert sorted(text) == [f"{i:05d},x" for i in range(500)]
    assert hashes[0] == hashes[1]


def test_market_export_statuses(spark):
    base = "id string, job_title string, company_name string, location string, fetch_date string, matched_skills array<string>"
    paid = spark.createDataFrame([("1", "t", None, "x", "d", ["a"], 5.0, True, "Low"), ("2", "t", "c", "x", "d", [], None, False, None), ("3", "t", "c", "x", "d", [], 7.0, False, "Mid")],
                                 base + ", mean_salary double, salary_is_predicted boolean, salary_tier string")
    plain = spark.createDataFrame([("1", "t", "c", None, "d", ["b"])], base)
    got = sorted((r["source"], r["id"], r["salary_status"], r["tier"]) for r in sinks.export_market(paid, plain).collect())
    assert got == [("salaried", "1", "estimated", "Low"), ("salaried", "2", "unavailable", None), ("salaried", "3", "advertised", "Mid"), ("unsalaried", "1", "unavailable", None)]


def test_star_schema_keeps_jobs_without_items(spark):
    jobs = spark.createDataFrame([(1, "Austin, TX", ["sql", "python"], ["IT"], 7, "High", "Associate", 9.0), (2, "Texas, United States", [], [], None, "Low", "Unknown", 5.0)],
                                 "job_id long, location string, matched_skills array<string>, skills_list array<string>, company_id long, salary_tier string, experience_level string, normalized_salary double"
                                 ).withColumn("date", F.to_date(F.lit("2024-03-02")))
    kinds = {"matched_skills": "extracted", "skills_list": "category"}
    items, places = w.build_dim_items(jobs, kinds), w.build_dim_location(jobs)
    fact = w.build_fact(jobs, items, places, kinds).cache()
    assert [(r["skill_id"], r["skill_name"]) for r in items.orderBy("skill_id").collect()] == [(1, "python"), (2, "sql"), (3, "IT")]
    assert fact.count() == 4 and fact.filter("skill_id is null").count() == 1 and w.job_view(fact).count() == 2
    assert fact.filter("job_id = 2").first()["company_id"] == 0 and fact.first()["time_id"] == 20240302
    w.check_star_schema(fact, {"items": (items, "skill_id"), "places": (places, "location_id")})
    with pytest.raises(ContractError):
        w.check_star_schema(fact, {"items": (items.filter("skill_id > 1"), "skill_id")})


def test_flattened_postings_tolerate_missing_parts(spark):
    path = scratch_path(spark, "t-pages")
    page = '{"results":[{"id":7,"name":"Dev","company":{"name":"A"},"locations":[{"name":"X"},{"name":"Y"}],"contents":"<p>Hi &amp; bye</p>"},{"id":8}],"page_count":1,"total":2}'
    spark.createDataFrame([(page,)], "value string").write.text(path)
    rows = {r["id"]: r for r in readers.flatten_postings(readers.scan_json_pages(spark, path)).collect()}
    assert rows["7"]["locations"] == ["X", "Y"] and rows["7"]["description"] == "Hi & bye" and rows["7"]["description_words"] == 3
    assert rows["8"]["company"] is None and rows["8"]["levels"] == [] and rows["8"]["description_words"] == 0


def test_fingerprints_are_those_of_the_bytes(spark, tmp_path):
    """Odd names, files of many chunks, empty files left out; whether streamed or read whole."""
    contents = {"a b.bin": bytes(range(256)) * 40, "empty": b"", "50%25é.csv.gz": b"\x1f\x8b no gzip at all\n", "sub/a b.bin": b"\xef\xbb\xbfx\n"}
    (tmp_path / "sub").mkdir()
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    expected = sorted((name.split("/")[-1], len(data), hashlib.sha256(data).hexdigest()) for name, data in contents.items() if data)
    for streamed in (("file",), ("other",)):
        got = sinks.file_fingerprints(spark, str(tmp_path), streamed, chunk=100)
        assert sorted((r["file"], r["bytes"], r["sha256"]) for r in got.collect()) == expected
    manifest = sinks.file_manifest(spark, str(tmp_path), spark.range(7)).first()
    assert manifest["sha256"] == hashlib.sha256("".join(x[2] for x in expected).encode()).hexdigest()
    assert (manifest["files"], manifest["bytes"], manifest["rows"]) == (3, sum(x[1] for x in expected), 7)
