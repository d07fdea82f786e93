"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, classifier, licenses, lmscore, mixing, nearjoin, packing, pages, personal, prefixtrie, rules, simhash, topk
from .common import begin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of (spark, folder) under its own name."""
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = build
        if sql:
            ORACLE_SQL[build.__name__] = textwrap.dedent(sql).strip()
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return begin(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file; by default the one of the packing query."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query()
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@query()
def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return lmscore.score_texts(table(spark, folder, "documents"), good)


@query()
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return nearjoin.near_duplicates(table(spark, folder, "documents"))


@query("""
    WITH parts AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda c: isfinite(c)))),
    v AS (SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
               FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
    placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= 10""")
def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge_quality(table(spark, folder, "documents"))


@query()
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query()
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.find_personal(table(spark, folder, "documents"))


@query()
def op10_page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages"))


@query()
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return alignment.align_tokenizers(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


@query()
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, folder, "conversations"))


@query()
def op13_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, folder, "documents"))
