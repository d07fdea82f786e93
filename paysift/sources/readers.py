"""Scans: CSV, JSON pages, list columns, SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import html_to_text, word_count
from ..functions.values import blank_missing
from ..scale import col

# CSV as written by dataframe libraries: header, quoted line breaks, doubled quotes.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
               "enforceSchema": "false"}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a declared schema (plain or gzip); only the selected columns are parsed.

    Text columns turn the usual missing-value tokens into NULL, as a dataframe reader does.
    """
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    wanted = [f for f in schema.fields if columns is None or f.name in columns]
    clean = [blank_missing(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
             for f in wanted]
    return df.select(clean)


def scan_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV as exact text: every column a string, blanks kept, nothing taken as missing."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.options(**CSV_OPTIONS, emptyValue="", nullValue="\u0000").schema(schema).csv(path)
    return df.select([F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


@dataclass(frozen=True)
class Table:
    """An entry of the table registry."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    about: str = ""
    format: str = "csv"


def scan_registry(spark: SparkSession, registry: dict[str, Table]) -> dict[str, DataFrame]:
    """Open every registered table whose files exist; missing ones are left out."""
    out = {}
    for name, table in registry.items():
        if not path_exists(spark, table.path):
            continue
        if table.format == "csv":
            out[name] = scan_csv(spark, table.path, table.schema)
        else:
            out[name] = spark.read.schema(table.schema).format(table.format).load(table.path)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (or glob) matches something on its file system."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    matches = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def scan_for_keys(df: DataFrame, keys: DataFrame, key: str, light: Sequence[str],
                  heavy: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Light columns of every row, and heavy columns only for wanted keys.

    The two results read disjoint column sets of the same files.
    """
    wanted = keys.select(key).distinct()
    return df.select(key, *light), df.select(key, *heavy).join(wanted, key, "left_semi")


PAGE_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("company", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("locations", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        T.StructField("contents", T.StringType()),
        T.StructField("levels", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        T.StructField("categories", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        T.StructField("publication_date", T.StringType()),
        T.StructField("refs", T.StructType([T.StructField("landing_page", T.StringType())])),
    ]))),
    T.StructField("page_count", T.LongType()),
    T.StructField("total", T.LongType()),
])


def scan_json_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE_SCHEMA,
                    multi_line: bool = True) -> DataFrame:
    """Saved result pages: one row per posting with its file, position in the page and payload."""
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return (pages.select(F.col("_metadata.file_path").alias("file"), F.posexplode("results"))
            .withColumnRenamed("col", "posting"))


def flatten_postings(pages: DataFrame, posting: str = "posting") -> DataFrame:
    """Nested postings as columns: struct fields, lists of names, visible text of the contents and its word count."""
    p = F.col(posting)
    names = lambda field: F.coalesce(F.transform(p[field], lambda x: x["name"]), F.array().cast("array<string>"))
    rest = [c for c in pages.columns if c != posting]
    flat = pages.select(*rest, p["id"].alias("id"), p["name"].alias("name"), p["company"]["name"].alias("company"), names("locations").alias("locations"),
                        html_to_text(p["contents"]).alias("description"), names("levels").alias("levels"), names("categories").alias("categories"),
                        p["publication_date"].alias("publication_date"), p["refs"]["landing_page"].alias("landing_page"))
    return flat.withColumn("description_words", word_count("description"))


def parse_list_column(text: Column | str) -> Column:
    """A list literal or JSON array as an array; both quote styles are accepted."""
    return F.from_json(col(text), "array<string>")


def read_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over the given tables, bound by name."""
    return spark.sql(query, **tables)
