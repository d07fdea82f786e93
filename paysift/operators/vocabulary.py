"""Vocabulary building from raw item lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import clean_form, form_pattern, is_ascii, item_key, split_clean
from ..functions.values import lookup
from ..scale import first_per_key, materialise, with_group_stats


def plain_key(text: str) -> str:
    """The same key as `functions.text.item_key`, for literal word lists."""
    return "".join(ch for ch in text.lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789+#")


def load_item_lists(df: DataFrame, key: str, text: str, order: str, into: str = "skills_list") -> DataFrame:
    """Comma-separated lists cleaned, one row per key (the first), without missing or empty lists."""
    present = df.filter(F.col(text).isNotNull())
    firsts = first_per_key(present, [key], [F.col(order)])
    return firsts.withColumn(into, split_clean(text)).filter(F.size(into) > 0).select(key, into)


def spelling_groups(lists: DataFrame, items: str, synonyms: Mapping[str, str] = K.SYNONYMS,
                    excluded: Sequence[str] = tuple(K.EXCLUDED_TERMS)) -> DataFrame:
    """Count per group and spelling, with the spelling's share of its group and whether it is searched for."""
    raw = lists.select(F.explode(items).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    keyed = raw.withColumn("form", clean_form("raw")).withColumn("key", item_key("form")).filter(F.col("key") != "")
    merged = {plain_key(k): plain_key(v) for k, v in synonyms.items()}
    group = F.coalesce(lookup("key", merged), F.col("key")) if merged else F.col("key")
    keyed = keyed.withColumn("group", group)
    if excluded:
        keyed = keyed.filter(~F.col("group").isin([plain_key(t) for t in excluded]))
    # Distinct spellings only from here on; the lists are read once.
    forms = materialise(keyed.groupBy("group", "form").agg(F.sum("n").alias("job_count")))
    shared = with_group_stats(forms, ["group"], group_count=F.sum("job_count"))
    return shared.withColumn("searched", (F.col("job_count") >= F.col("group_count") * K.MIN_VARIANT_SHARE) & is_ascii("form"))


def merge_spellings(groups: DataFrame, synonyms: Mapping[str, str] = K.SYNONYMS) -> DataFrame:
    """One row per group: name, count, number of spellings, searched spellings (most frequent first).

    A searched spelling holds at least 1 % of its group, so its list has at most 100 entries.
    """
    by_count = F.struct(F.col("job_count"), F.col("form"))
    frequent = F.struct((-F.col("job_count")).alias("c"), F.col("form").alias("f"))
    merged = groups.groupBy("group").agg(
        F.min_by("form", F.struct((-F.col("job_count")).alias("c"), F.col("form").alias("f"))).alias("top_form"),
        F.sum("job_count").alias("job_count"), F.count(by_count).alias("n_variants"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("searched"), frequent))), lambda x: x["f"]).alias("forms"))
    named = {plain_key(v): v for v in synonyms.values()}
    name = F.coalesce(lookup("group", named), F.col("top_form")) if named else F.col("top_form")
    return merged.withColumn("skill", name).drop("top_form")


def add_forced(vocabulary: DataFrame, top_n: int, forced: Sequence[str] = tuple(K.TECHNICAL_SKILLS),
               extra: Mapping[str, Sequence[str]] = K.EXTRA_FORMS) -> DataFrame:
    """The `top_n` groups plus every forced skill with its own count (0 if unseen) and extra spellings.

    `position` orders the result: top groups by count, then the added skills by count.
    """
    top = (vocabulary.orderBy(F.col("job_count").desc(), "skill").limit(top_n)
           .select("group", F.lit(True).alias("in_top")))
    empty = F.array().cast("array<string>")
    marked = vocabulary.join(top, "group", "left").withColumn("in_top", F.coalesce("in_top", F.lit(False)))
    if forced:
        rows = [(plain_key(s), s, list(extra.get(s, []))) for s in forced]
        wanted = vocabulary.sparkSession.createDataFrame(rows, "`group` string, f_skill string, f_extra array<string>")
        marked = marked.join(wanted, "group", "full_outer")
    else:
        marked = marked.withColumns({"f_skill": F.lit(None).cast("string"), "f_extra": empty})
    is_forced = F.col("f_skill").isNotNull()
    forms = F.coalesce("forms", empty)
    chosen = (marked.filter(F.coalesce("in_top", F.lit(False)) | is_forced)
              .select(F.coalesce("f_skill", "skill").alias("skill"), F.coalesce("job_count", F.lit(0)).alias("job_count"),
                      F.coalesce("n_variants", F.lit(0)).alias("n_variants"),
                      F.when(is_forced, F.array_distinct(F.concat(F.array("f_skill"), forms, F.coalesce("f_extra", empty))))
                      .otherwise(forms).alias("forms"),
                      is_forced.alias("forced"), F.coalesce("in_top", F.lit(False)).alias("in_top")))
    # At most top_n + len(forced) rows are ordered here.
    order = Window.orderBy(F.col("in_top").desc(), F.col("job_count").desc(), F.col("skill"))
    return chosen.withColumn("position", F.row_number().over(order) - 1)


def with_patterns(vocabulary: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Add the regex of each skill: the override, else one built from its spellings."""
    overrides = K.SENSE_PATTERNS if overrides is None else overrides
    built = form_pattern("forms")
    return vocabulary.withColumn("pattern", F.coalesce(lookup("skill", overrides), built) if overrides else built)


def build_vocabulary(lists: DataFrame, items: str, top_n: int = K.TOP_VOCABULARY, synonyms: Mapping[str, str] = K.SYNONYMS,
                     excluded: Sequence[str] = tuple(K.EXCLUDED_TERMS), forced: Sequence[str] = tuple(K.TECHNICAL_SKILLS),
                     extra: Mapping[str, Sequence[str]] = K.EXTRA_FORMS,
                     overrides: Mapping[str, str] | None = None) -> DataFrame:
    """The skill vocabulary: merged spellings, the most frequent groups and the forced skills."""
    merged = merge_spellings(spelling_groups(lists, items, synonyms, excluded), synonyms)
    return with_patterns(add_forced(merged, top_n, forced, extra), overrides)
