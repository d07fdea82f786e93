"""Writers.  Text formats are exports; Parquet is the working format."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import NativeFile
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import join_items
from ..functions.values import safe_json_number, salary_status
from ..scale import materialise

CHUNK = 1 << 22


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Save a table; by default only to a path that does not exist yet."""
    writer = df.write.mode(mode)
    (writer.option("header", True).csv if fmt == "csv" else writer.format(fmt).save)(path)


def write_star_schema(tables: Mapping[str, DataFrame], root: str) -> None:
    """Replace all tables of a star schema."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and recreate one table."""
    df.write.mode("overwrite").parquet(path)


def join_lists(df: DataFrame, columns: Sequence[str], separator: str = "; ") -> DataFrame:
    """Array columns as delimited text, for CSV exports."""
    return df.withColumns({c: join_items(c, separator) for c in columns})


def write_sorted_gzip(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Key-sorted gzip CSV: a range per file, so names and contents are in key order."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (ranged.sortWithinPartitions(key).write.mode("errorifexists")
     .options(header=True, compression="gzip", nullValue="", emptyValue="").csv(path))


def open_uri(path: str) -> NativeFile:
    """A file as a stream, by the path that Spark lists (not percent-encoded)."""
    scheme, rest = path.split(":", 1)
    system, place = FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/@:')}")
    return system.open_input_stream(place, compression=None)


def file_fingerprints(spark, path: str, streamed: Sequence[str] = ("file",), chunk: int = CHUNK) -> DataFrame:
    """Path, name, bytes and SHA-256 of each file.

    Spark lists the files without reading them and deals them to tasks.  Files of the `streamed` schemes, which workers open
    themselves through Arrow, pass through the hash `chunk` bytes at a time, so memory is constant whatever their size; add
    `hdfs`, `s3` or `gs` where workers have their libraries and credentials.  Files of stores that only Spark reads are one
    row each, which Spark limits to 2 GB.  Spark does not list empty files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    own = F.substring_index("path", ":", 1).isin(*streamed)

    def stream(batches):
        for batch in batches:
            hashes = []
            for name in batch["path"]:
                digest = hashlib.sha256()
                with open_uri(name) as source:
                    while data := source.read(chunk):
                        digest.update(data)
                hashes.append(digest.hexdigest())
            yield batch.assign(sha256=hashes)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = files.filter(own).select("path", "length").repartition(parts, "path")
    hashed = listed.mapInPandas(stream, "path string, length long, sha256 string")
    # A reader of contents loads every file before it filters, so it is left out where no file needs it.
    if files.filter(~own).select("path").isEmpty():
        found = hashed
    else:
        found = hashed.unionByName(files.filter(~own).select("path", "length", F.sha2("content", 256).alias("sha256")))
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "sha256")


def file_manifest(spark, path: str, rows: DataFrame) -> DataFrame:
    """One manifest row: files, bytes, rows and a hash over the files' hashes in name order.

    The sorted hashes stream through one SHA-256 in one task; no list of them is built.
    """
    prints = materialise(file_fingerprints(spark, path))

    def fold(batches):
        digest, files, size = hashlib.sha256(), 0, 0
        for batch in batches:
            digest.update("".join(batch["sha256"]).encode())
            files, size = files + len(batch), size + int(batch["bytes"].sum())
        yield pd.DataFrame({"files": [files], "bytes": [size], "sha256": [digest.hexdigest()]})

    in_order = prints.select("file", "bytes", "sha256").repartition(1).sortWithinPartitions("file", "sha256")
    return (in_order.mapInPandas(fold, "files long, bytes long, sha256 string")
            .withColumn("rows", rows.agg(F.count(F.lit(1))).scalar()))


def null_safe_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities as NULL in every float column."""
    floats = (T.DoubleType, T.FloatType)
    return df.select([safe_json_number(f.name).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
                      for f in df.schema.fields])


def write_facts_json(df: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls and no NaN."""
    null_safe_numbers(df).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def to_facts_json(df: DataFrame, name: str = "fact") -> DataFrame:
    """Each row as one JSON text, nulls kept."""
    clean = null_safe_numbers(df)
    return clean.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def export_market(salaried: DataFrame, unsalaried: DataFrame, id: str = "id", title: str = "job_title",
                  company: str = "company_name", location: str = "location", date: str = "fetch_date",
                  skills: str = "matched_skills", salary: str = "mean_salary", predicted: str = "salary_is_predicted",
                  tier: str = "salary_tier") -> DataFrame:
    """Postings of a salaried and an unsalaried source in one schema with a salary status."""
    def common(df: DataFrame, source: str, has_salary: bool) -> DataFrame:
        amount = F.col(salary) if has_salary else F.lit(None).cast("double")
        status = salary_status(salary, predicted) if has_salary else F.lit("unavailable")
        label = F.col(tier) if has_salary else F.lit(None).cast("string")
        return df.select(F.lit(source).alias("source"), F.col(id).alias("id"), F.col(title).alias("title"),
                         F.col(company).alias("company"), F.col(location).alias("location"),
                         F.col(date).alias("date"), F.col(skills).alias("skills"), amount.alias("salary"),
                         status.alias("salary_status"), label.alias("tier"))
    return common(salaried, "salaried", True).unionByName(common(unsalaried, "unsalaried", False))


def export_titles(jobs: DataFrame, export: DataFrame, id: str = "job_id", title: str = "job_title",
                  company: str = "company_name") -> DataFrame:
    """Id, title and company per exported row, with a flag when either side lacks the id or the title is blank."""
    meta = jobs.select(F.col(id), F.col(title), F.col(company), F.lit(True).alias("__in_jobs"))
    rows = export.select(F.col(id), F.lit(True).alias("__in_export"))
    joined = meta.join(rows, id, "full_outer")
    ok = F.col("__in_jobs").isNotNull() & F.col("__in_export").isNotNull() & (F.trim(F.coalesce(title, F.lit(""))) != "")
    return joined.select(id, title, company, ok.alias("valid"))
