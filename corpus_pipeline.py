"""From raw documents to training sequences: quality, near duplicates, personal data, source mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of `docs`, but for the last one, which
returns pieces.  A stage keeps extra columns as they are, whatever their names, and handles NULLs, empty and repeated rows
as its operator does; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.llm.classifier import score_quality
from paysift.llm.mixing import mix_sources
from paysift.llm.nearjoin import near_duplicates
from paysift.llm.packing import pack
from paysift.llm.personal import sanitise
from paysift.llm.queries import table, tokenizer_path
from paysift.scale import discard, materialise, sweep


def slotted(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under neutral column names, so no extra column clashes with what an operator adds; and the names by column.

    What earlier stages left and nothing reads any more is deleted first.
    """
    sweep(docs.sparkSession)
    slots = {c: f"slot{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*slots.values()), slots


def restored(rows: DataFrame, slots: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(s).alias(c) for c, s in slots.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A score depends on the text alone, so scores are stored by a 128-bit hash of it and rows are chosen by that: the texts
    themselves are not stored twice.
    """
    rows, slots = slotted(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(slots["doc_id"]), "quality")
    text = F.coalesce(F.col(slots["text"]).cast("string"), F.lit(""))
    keyed = rows.withColumns({"text_key": F.xxhash64(text), "text_key2": F.xxhash64(F.lit(1), text)})
    scored = score_quality(keyed, labels, ["text_key", "text_key2"], slots["text"], slots["doc_id"])
    accepted = scored.where("predicted = 1").select("text_key", "text_key2").distinct()
    return restored(keyed.join(accepted, ["text_key", "text_key2"], "left_semi"), slots)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    rows, slots = slotted(docs)
    return restored(near_duplicates(rows, slots["doc_id"], slots["text"], rows.columns).where("keeper"), slots)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data generalised; n_chars follows the text."""
    sweep(spark)
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of source weights takes it."""
    rows, slots = slotted(docs)
    taken = mix_sources(rows, rows.columns, slots["source"], slots["text"], slots["doc_id"])
    return restored(taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), slots)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of a power-of-two length."""
    sweep(spark)
    return pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("near duplicates", deduplicated), ("personal data", private), ("source mix", mixed), ("packing", packed)]

# Learned scores, corpus statistics and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each result stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
