"""Grouped splits, leakage checks and connected groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import masked_template, normalise_text, normalised_description, pair_key
from ..functions.values import share
from ..scale import col, discard, grouped_quantiles, materialise, md5_number, null_safe, split_join, value_positions, with_row
from .aggregates import overlap_report


def employer_group(company: Column | str, id: Column | str) -> Column:
    """Normalised employer; a missing one is a group of its own."""
    name = normalise_text(F.coalesce(col(company), F.lit("")))
    return F.when(name == "", F.concat(F.lit("missing:"), col(id).cast("string"))).otherwise(F.concat(F.lit("employer:"), name))


def description_group(key: Column | str, id: Column | str) -> Column:
    """Description key; a blank one is a group of its own."""
    blank = F.trim(F.coalesce(col(key), F.lit(""))) == ""
    return F.when(blank, F.concat(F.lit("singleton-job:"), col(id).cast("string"))).otherwise(col(key))


def stratified_split(df: DataFrame, id: str, label: str, seed: int, test_share: float = 0.2) -> DataFrame:
    """`role` train or test: the smallest hashes of each class up to its share.

    The cut per class is an exact quantile position, found without ordering a class in one task.
    """
    hashed = df.withColumn("__h", md5_number(id, F.lit(seed)))
    places = value_positions(hashed, "__h", [label])
    cut = (places.filter((F.col("before") + F.col("w")) <= F.round(F.col("total") * test_share))
           .groupBy(label).agg(F.max("value").alias("__cut")))
    joined = null_safe(hashed, cut, [label])
    return joined.withColumn("role", F.when(F.col("__h") <= F.col("__cut"), "test").otherwise("train")).drop("__h", "__cut")


def stratified_folds(df: DataFrame, id: str, label: str, k: int, seed: int, fold: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row, equal class shares: hash position within the class, modulo k."""
    hashed = df.withColumn("__h", md5_number(id, F.lit(seed)))
    places = value_positions(hashed, "__h", [label]).select(label, F.col("value").alias("__v"), F.col("before").alias("__at"))
    joined = null_safe(hashed.withColumn("__v", F.col("__h").cast("double")), places, [label, "__v"])
    return joined.withColumn(fold, F.pmod(F.col("__at"), F.lit(k)).cast("int")).drop("__h", "__v", "__at")


def hash_folds(df: DataFrame, group: str, k: int, seed: int, fold: str = "fold") -> DataFrame:
    """Fold by hash of the group: never splits a group, needs no shuffle."""
    return df.withColumn(fold, F.pmod(md5_number(group, F.lit(seed)), F.lit(k)).cast("int"))


def stratified_group_folds(df: DataFrame, group: str, label: str, k: int, seed: int, labels: Sequence[str] = tuple(K.TIER_LABELS),
                           fold: str = "fold") -> DataFrame:
    """Whole groups into k folds with balanced class counts.

    Groups with the same class mix and size are interchangeable, so they are dealt out in
    snake order: large mixes first, each next one to the following fold.  Positions within a
    mix come from hashes and are found by `value_positions`, so no task orders all groups.
    """
    sizes = df.groupBy(group).agg(*[F.count_if(F.col(label) == c).alias(f"__c{i}") for i, c in enumerate(labels)])
    mix = F.array(*[F.col(f"__c{i}") for i in range(len(labels))])
    main = F.array_position(mix, F.array_max(mix))
    total = reduce(lambda a, b: a + b, [F.col(f"__c{i}") for i in range(len(labels))])
    keyed = materialise(sizes.select(group, F.concat_ws("-", main, total).alias("__mix"), main.alias("__main"), total.alias("__size"),
                                     md5_number(group, F.lit(seed)).alias("__h")))
    # Strata are (main class, size) pairs: few, and ordered by size within a class.
    strata = keyed.groupBy("__mix", "__main", "__size").agg(F.count(F.lit(1)).alias("__g"))
    before = Window.partitionBy("__main").orderBy(F.col("__size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("__start", F.coalesce(F.sum("__g").over(before), F.lit(0))).select("__mix", "__start")
    places = value_positions(keyed, "__h", ["__mix"]).select("__mix", F.col("value").alias("__v"), F.col("before").alias("__at"))
    dealt = (keyed.withColumn("__v", F.col("__h").cast("double")).join(places, ["__mix", "__v"]).join(strata, "__mix")
             .withColumn("__turn", F.col("__start") + F.col("__at") + F.col("__main")))
    round_, seat = F.floor(F.col("__turn") / k), F.pmod(F.col("__turn"), F.lit(k))
    snake = F.when(F.pmod(round_, F.lit(2)) == 0, seat).otherwise(F.lit(k - 1) - seat)
    return null_safe(df, dealt.select(group, snake.cast("int").alias(fold)), [group])


def grouped_design(df: DataFrame, group: str, label: str, outer: int = 5, inner: int = 3, outer_seed: int = 2026,
                   inner_seed: int = 2027, chosen: int = 0) -> DataFrame:
    """`outer_role` (test = the chosen outer fold) and `inner_fold` (training groups only, else -1)."""
    folded = stratified_group_folds(df, group, label, outer, outer_seed, fold="outer_fold")
    folded = materialise(folded.withColumn("outer_role", F.when(F.col("outer_fold") == chosen, "test").otherwise("train")))
    train = stratified_group_folds(folded.filter(F.col("outer_role") == "train"), group, label, inner, inner_seed, fold="inner_fold")
    test = folded.filter(F.col("outer_role") == "test").withColumn("inner_fold", F.lit(-1))
    return train.unionByName(test)


def split_statistics(df: DataFrame, role: str, group: str, label: str, description: str | None = None,
                     labels: Sequence[str] = tuple(K.TIER_LABELS)) -> DataFrame:
    """Rows, classes, groups, shared groups and group-size quantiles of a split."""
    test, train = F.col(role) == "test", F.col(role) == "train"
    rows = df.agg(F.count_if(train).alias("train_rows"), F.count_if(test).alias("test_rows"),
                  *[F.count_if(side & (F.col(label) == c)).alias(f"{name}_{c.lower()}")
                    for name, side in (("train", train), ("test", test)) for c in labels])
    groups = df.groupBy(group).agg(F.count(F.lit(1)).alias("c"), F.count_if(train).alias("tr"), F.count_if(test).alias("te"))
    stats = groups.agg(F.count_if(F.col("tr") > 0).alias("train_groups"), F.count_if(F.col("te") > 0).alias("test_groups"),
                       F.count_if((F.col("tr") > 0) & (F.col("te") > 0)).alias("shared_groups"),
                       F.count(F.lit(1)).alias("groups_total"), F.max("c").alias("largest_group"))
    sizes = grouped_quantiles(groups, "c", [0.5, 0.9, 0.99, 1.0], names=[f"group_size_{q}" for q in ("q50", "q90", "q99", "q100")])
    out = with_row(with_row(rows, stats), sizes)
    out = out.withColumn("largest_group_share", share("largest_group", F.col("train_rows") + F.col("test_rows")))
    if description is None:
        return out
    shared = df.groupBy(description).agg(F.count_if(train).alias("tr"), F.count_if(test).alias("te")).filter((F.col("tr") > 0) & (F.col("te") > 0))
    return with_row(out, shared.agg(F.count(F.lit(1)).alias("shared_description_groups"),
                                    F.coalesce(F.sum("te"), F.lit(0)).alias("test_rows_sharing_description")))


def compare_splits(df: DataFrame, old_role: str, new_role: str) -> DataFrame:
    """How the test rows of two splits of the same table overlap."""
    old, new = F.col(old_role) == "test", F.col(new_role) == "test"
    return df.agg(F.count_if(old).alias("old_test_rows"), F.count_if(new).alias("new_test_rows"),
                  F.count_if(old & new).alias("shared_test_rows"), F.count_if(old & ~new).alias("old_test_now_training"),
                  F.count_if(new & ~old).alias("new_test_previously_training"))


def class_coverage(df: DataFrame, fold: str, label: str, classes: int = len(K.TIER_LABELS)) -> DataFrame:
    """Distinct classes per fold and whether all are present."""
    present = df.select(fold, label).distinct().groupBy(fold).agg(F.count(label).alias("n_classes"))
    return present.withColumn("complete", F.col("n_classes") == classes)


def leakage_report(df: DataFrame, text: str, company: str, title: str, is_train: Column) -> DataFrame:
    """Overlap across a split under four keys: exact, normalised and masked description, company and title."""
    normalised = normalised_description(text)
    keyed = materialise(df.select(
        is_train.alias("train"), F.coalesce(F.col(text), F.lit("")).alias("exact_description"), normalised.alias("normalized_description"),
        pair_key(company, title).alias("company_title")).withColumn("masked_template", masked_template("normalized_description"))
        .select("train", *[F.when(F.col(k) != "", F.sha2(k, 256)).otherwise("").alias(k)
                           for k in ("exact_description", "normalized_description", "masked_template", "company_title")]))
    parts = [overlap_report(keyed, k, F.col("train")).select(F.lit(k).alias("key"), "*")
             for k in ("exact_description", "normalized_description", "masked_template", "company_title")]
    return reduce(DataFrame.unionByName, parts)


def connected_groups(df: DataFrame, id: str, keys: Sequence[str], component: str = "component") -> DataFrame:
    """Rows that share any (non-NULL) key value, directly or through others, get the smallest id as component.

    Rows with the same key are linked to that key's smallest id (a star, never all pairs).
    `star_components` then shrinks paths to stars in few rounds.
    """
    parts = []
    for i, key in enumerate(keys):
        held = materialise(df.filter(F.col(key).isNotNull()).select(F.col(id).alias("u"), F.col(key).alias("k")))
        firsts = materialise(held.groupBy("k").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("n")))
        parts.append(split_join(held, firsts, "k", "n").select("u", "v"))
    edges = reduce(DataFrame.unionByName, parts)
    labels = star_components(edges)
    return (df.join(labels.select(F.col("u").alias(id), F.col("root").alias(component)), id, "left")
            .withColumn(component, F.coalesce(F.col(component), F.col(id))))


def star_components(edges: DataFrame, least: int = 100_000) -> DataFrame:
    """Component root (smallest node) of every node of an undirected edge list (`u`, `v`).

    Alternating large-star and small-star steps: each links neighbours to the smallest node around, until all links are stars.
    A step is one shuffle by node; where a node has more than `least` edges, it is partial minima and a join in which its edges
    stay where they lie (`split_join`), so the hub of a star is no hot key.  Each round is stored and the one before it deleted.
    """
    loose, upward = F.col("u") != F.col("v"), F.col("v") > F.col("u")
    pairs = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links, alone = materialise(pairs.filter(loose)), materialise(pairs.filter(F.col("u").eqNullSafe(F.col("v"))).select("u"))
    discard(pairs)
    around = Window.partitionBy("u")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stars: no node has both smaller and larger neighbours, or two smaller ones.
        below = F.when(~upward, F.col("v"))
        shape = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min(below).alias("low"), F.max(below).alias("high"), F.count_if(upward).alias("above"))
        most, moving = shape.agg(F.max("n"), F.count_if(F.col("low").isNotNull() & ((F.col("low") < F.col("high")) | (F.col("above") > 0)))).first()
        if not moving:
            break
        stored = []
        # Large star: every larger neighbour is linked to the smallest node around.
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        if most > least:
            raised = lambda joined: joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(loose).distinct()
            lowest = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"), F.count_if(upward).alias("n"))
            stored = [both := materialise(both), lowest := materialise(lowest)]
            large = materialise(raised(split_join(both.filter(upward), lowest.filter("n > 0"), "u", "n", least)))
            stored += [large, least_of := materialise(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))]
            small = split_join(large, least_of, "u", "n", least)
        else:  # no node has more than `least` edges, and none gets more by a step
            large = (both.withColumn("m", F.least(F.min("v").over(around), F.col("u"))).filter(upward)
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))
            small = large.withColumn("m", F.min("v").over(around))
        # One row of each node has its smallest neighbour: it links the node, the others link its other neighbours.
        top = F.col("v") == F.col("m")
        before, links = links, materialise(small.select(F.when(top, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct())
        discard(before, *stored)
    tops = links.select(F.col("v").alias("u")).unionByName(alone).distinct().join(links.select("u"), "u", "left_anti")
    return links.select("u", F.col("v").alias("root")).unionByName(tops.select("u", F.col("u").alias("root")))
