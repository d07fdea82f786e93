"""Joins: fill, collect, latest value, lookups, containment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_items
from ..scale import first_per_key, null_safe
from .contracts import require_unique


def fill_from(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str],
              order: Sequence[Column] | None = None) -> DataFrame:
    """Fill missing values from the first matching row of `other`; `filled_values` counts fills per row."""
    right = first_per_key(other, [key], order or [F.col(c).asc_nulls_last() for c in columns])
    right = right.select(key, *[F.col(c).alias(f"__o_{c}") for c in columns])
    joined = df.join(right, key, "left")
    fills = [F.when(F.col(c).isNull() & F.col(f"__o_{c}").isNotNull(), 1).otherwise(0) for c in columns]
    return (joined.withColumn("filled_values", reduce(lambda a, b: a + b, fills))
            .withColumns({c: F.coalesce(F.col(c), F.col(f"__o_{c}")) for c in columns})
            .drop(*[f"__o_{c}" for c in columns]))


def attach_item_lists(df: DataFrame, links: DataFrame, names: DataFrame, key: str, code: str, name: str,
                      order: str, into: str = "skills_list") -> DataFrame:
    """Item names per key through a code table, clean and in source order; no items gives an empty list.

    Repeats are removed before lists are built, so a list is at most as long as the code table.
    """
    named = links.join(names, code, "left").filter(F.col(name).isNotNull())
    firsts = named.groupBy(key, name).agg(F.min(order).alias("__order"))
    lists = firsts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__order", F.col(name).alias("n")))).alias("__l"))
    lists = lists.select(key, clean_items(F.transform("__l", lambda x: x["n"])).alias(into))
    return (df.join(lists, key, "left")
            .withColumn(into, F.coalesce(F.col(into), F.array().cast("array<string>"))))


def attach_joined_names(df: DataFrame, links: DataFrame, names: DataFrame, key: str, code: str, name: str,
                        into: str = "industry", unknown: str = "Unknown") -> DataFrame:
    """Sorted distinct names per key as one '; '-joined text; none gives the unknown label."""
    named = links.join(names, code).filter(F.col(name).isNotNull()).select(key, F.trim(name).alias("__n")).distinct()
    lists = named.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("__n")), "; ").alias(into))
    return df.join(lists, key, "left").withColumn(into, F.coalesce(F.col(into), F.lit(unknown)))


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in `known`."""
    return df.join(known.select(*keys), list(keys), "left_semi")


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in `known`."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def latest_value(df: DataFrame, key: str, time: str, value: str, tie: str | None = None) -> DataFrame:
    """The value of the latest row per key, by partial aggregation."""
    moment = F.struct(F.col(time), F.col(tie or value))
    return df.groupBy(key).agg(F.max_by(value, moment).alias(value))


def first_value(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The first non-NULL value per key."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(value))


def lookup_id(df: DataFrame, dim: DataFrame, pairs: dict[str, str], id: str) -> DataFrame:
    """Look up an id by one or more columns (NULL matches NULL); a repeated name takes its smallest id."""
    right = dim.select(*[F.col(d).alias(f"__k{i}") for i, d in enumerate(pairs.values())], F.col(id).alias("__id"))
    right = right.groupBy(*[f"__k{i}" for i in range(len(pairs))]).agg(F.min("__id").alias(id))
    condition = reduce(lambda a, b: a & b, [df[c].eqNullSafe(right[f"__k{i}"]) for i, c in enumerate(pairs)])
    return df.join(right, condition, "left").drop(*[f"__k{i}" for i in range(len(pairs))])


def checked_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", one_to_one: bool = False) -> DataFrame:
    """Join after checking that the right key (and for 1:1 the left key) is unique."""
    require_unique(right, [key])
    if one_to_one:
        require_unique(left, [key])
    return left.join(right, key, how)


def outer_status(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str],
                 labels: tuple[str, str, str] = ("both", "only_left", "only_right")) -> DataFrame:
    """Full outer join of two value tables with a membership status."""
    a = left.select(*keys, *[F.col(v).alias(f"{v}_left") for v in values], F.lit(True).alias("__l"))
    b = right.select(*keys, *[F.col(v).alias(f"{v}_right") for v in values], F.lit(True).alias("__r"))
    joined = null_safe_outer(a, b, keys)
    status = (F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), labels[0])
              .when(F.col("__l").isNotNull(), labels[1]).otherwise(labels[2]))
    return joined.withColumn("status", status).drop("__l", "__r")


def null_safe_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on NULL-safe keys, with merged key columns."""
    r = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    joined = left.join(r, condition, "full_outer")
    return joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys}).drop(*[f"__r_{k}" for k in keys])


def item_pairs(items: Column | str) -> Column:
    """All unordered pairs of a distinct item list as an array of structs (a < b).

    A list is no longer than its vocabulary; restrict it to frequent items first.
    """
    listed = F.array_sort(F.array_distinct(F.col(items) if isinstance(items, str) else items))
    return F.flatten(F.transform(listed, lambda a, i: F.transform(
        F.slice(listed, i + 2, F.size(listed)), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def containing(baskets: DataFrame, itemsets: DataFrame, items: str, itemset: str) -> DataFrame:
    """Rows of `baskets` joined to each itemset they contain in full.

    Baskets meet an itemset only through its first item (an equi-join), and the rest is
    checked in the row, so neither pairs of all rows nor item counts are shuffled.
    """
    sets = itemsets.withColumn("__anchor", F.get(F.array_sort(itemset), 0)).filter(F.col("__anchor").isNotNull())
    exploded = baskets.withColumn("__anchor", F.explode(F.array_distinct(items)))
    return (exploded.join(sets, "__anchor")
            .filter(F.size(F.array_except(F.col(itemset), F.col(items))) == 0).drop("__anchor"))
