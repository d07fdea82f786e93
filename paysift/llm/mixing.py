"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scale import materialise, ordinal
from .common import begin

WEIGHTS = (5, 2, 1)
MOST = 3
# Keys have 48 bits and are searched eight bits at a time, until a source's open part has at most so many keys.
KEY_BITS, DIGIT_BITS, FEW = 48, 8, 64
DIGITS = 1 << DIGIT_BITS


def word_count(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A document's quality weight: one less the share of ASCII digits and marks among its visible characters, at least 0.05."""
    visible = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""))
    marks = F.regexp_count(text, F.lit(r"[!-@\[-`{-~]"))
    return F.greatest(F.lit(0.05), F.when(visible > 0, 1 - marks / visible).otherwise(0.05))


def sampling_key(weight: Column, *parts: Column) -> Column:
    """An exponential key -ln(u) / weight as an integer of 48 bits in the same order; u comes from a hash of the parts."""
    u = (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    exponential = -F.log(u) / F.greatest(weight.cast("double"), F.lit(1e-6))
    return F.least(F.floor(exponential / (1 + exponential) * float(1 << KEY_BITS)), F.lit((1 << KEY_BITS) - 1)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Targets per source from `s_key`, `s_name`, `source_size`: the whole size shared by weight, `most` times the own size at most.

    Sources in code-point order, NULL last, take the weights in turn.  What is above a cap is shared anew among the
    others: one small aggregation a round, until a round caps no further source.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s_place") % len(weights) + 1).cast("int"))
    ranked = materialise(ordinal(sizes, [F.col("s_name").asc_nulls_last()], "s_place").withColumn("s_weight", pick))
    cap, level, capped = F.col("source_size") * float(most), 0.0, -1
    while True:
        full = F.col("s_weight") * level >= cap
        row = ranked.agg(F.sum("source_size").alias("total"), F.sum(F.when(full, cap).otherwise(0.0)).alias("used"),
                         F.sum(F.when(full, 0.0).otherwise(F.col("s_weight"))).alias("open"), F.count_if(full).alias("capped")).first()
        if not row["total"] or not row["open"] or row["capped"] == capped:
            break
        capped, level = row["capped"], (float(row["total"]) - row["used"]) / row["open"]
    return ranked.withColumn("target", F.least(cap, F.col("s_weight") * level))


def cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the whole epochs and the largest key that the rest of its target still takes (-1: none).

    The key where the running size meets the rest is found digit by digit: a round adds up sizes per source and digit
    below the prefix found so far (256 sums a source), so no source is sorted or gathered as a whole.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    found = materialise(targets.select("s_key", "source_size", "target", whole.alias("epochs"), (F.col("target") - whole * F.col("source_size")).alias("rest"),
                                       F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("under")))
    bits = KEY_BITS
    while bits:
        bits -= DIGIT_BITS
        open_rows = rows.join(found.select("s_key", "prefix"), "s_key").where(F.shiftright("key", bits + DIGIT_BITS) == F.col("prefix"))
        digits = (open_rows.groupBy("s_key", F.shiftright("key", bits).bitwiseAND(F.lit(DIGITS - 1)).alias("digit"))
                  .agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("rows")))
        running = F.sum("w").over(Window.partitionBy("s_key").orderBy("digit"))  # at most 256 rows a source
        placed = digits.withColumn("upto", running).join(found, "s_key").where(F.col("under") + F.col("upto") >= F.col("rest"))
        first = placed.groupBy("s_key").agg(F.min_by(F.struct("digit", "upto", "w", "rows"), "digit").alias("hit"))
        found = materialise(found.join(first, "s_key", "left").select(
            "s_key", "source_size", "target", "epochs", "rest",
            (F.col("prefix") * DIGITS + F.coalesce("hit.digit", F.lit(DIGITS - 1))).alias("prefix"),
            (F.col("under") + F.coalesce(F.col("hit.upto") - F.col("hit.w"), F.lit(0))).alias("under"), F.coalesce("hit.rows", F.lit(0)).alias("open")))
        if (found.agg(F.max("open")).first()[0] or 0) <= FEW:
            break
    # What is left has few rows a source, or one key: rows of one key are taken or left together.
    tail = (rows.join(found.select("s_key", "prefix"), "s_key").where(F.shiftright("key", bits) == F.col("prefix"))
            .groupBy("s_key", "key").agg(F.sum("size").alias("w")))
    running = F.sum("w").over(Window.partitionBy("s_key").orderBy("key"))
    near = tail.withColumn("upto", running).join(found, "s_key").where(F.col("under") + F.col("upto") - F.col("w") / 2 <= F.col("rest"))
    last = near.groupBy("s_key").agg(F.max("key").alias("key"))
    before = F.col("prefix") * F.lit(1 << bits) - 1
    return found.join(last, "s_key", "left").select("s_key", "source_size", "target", "epochs",
                                                    F.when(F.col("rest") > 0, F.coalesce("key", before)).otherwise(-1).alias("cut"))


def mix_sources(df: DataFrame, keep: Sequence[str] = ("doc_id",), source: str = "source", text: str = "text", id: str = "doc_id",
                weights: Sequence[float] = WEIGHTS, most: float = MOST, quality: Column | None = None, seed: int = 0) -> DataFrame:
    """How many words a mix of target weights takes from every document.

    Sources share the whole size by weight, capped at `most` times their own size.  Each gives whole epochs of all its
    documents first; the rest of its target is an Efraimidis-Spirakis sample: exponential keys over the documents' quality
    weights, taken in order until the rest is met as nearly as whole documents allow (the document at the border is taken
    when more than half of it fits).  Returns columns `keep`, size, source_size, target, copies and taken (words, repeats
    counted).  Keys are hashes of id, text and seed, so reruns agree.

    NULL text has size 0 and is never counted; NULL is a source of its own, the last; equal rows have equal keys and are
    taken or left together; a source without words has target 0; an empty table gives an empty one; columns not in `keep`
    are not read, so names cannot clash.
    """
    begin(df.sparkSession)
    made = ["size", "source_size", "target", "copies", "taken"]
    if clash := set(keep) & set(made):
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    words, name = F.col(f"`{text}`").cast("string"), F.col(f"`{source}`").cast("string")
    weight = letter_share(F.coalesce(words, F.lit(""))) if quality is None else quality
    rows = materialise(df.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], name.alias("s_name"), F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("s_key"),
        word_count(words).alias("size"), sampling_key(weight, F.col(f"`{id}`"), words, F.lit(seed)).alias("key")))
    slim = rows.select("s_key", "s_name", "size", "key")
    targets = source_targets(slim.groupBy("s_key", "s_name").agg(F.sum("size").alias("source_size")), weights, most)
    per_source = materialise(cuts(slim, targets))
    copies = F.col("epochs") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    return (rows.join(per_source, "s_key").withColumn("copies", copies)
            .select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))
