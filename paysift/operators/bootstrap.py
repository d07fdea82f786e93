"""Cluster bootstraps: whole groups are resampled, predictions and rules stay fixed.

Rows are first summed per group; replicates then only redraw these sums.  Draws come
from hashes, so a rerun (or another engine) repeats them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import parse_itemset
from ..scale import materialise, md5_number, ordinal
from .metrics import LABELS, cell_names, confusion_cells, metrics_of_cells
from .joins import containing
from .rules import basket_items, with_metrics

# Groups whose sums lie in one row of the second step of a draw.
BLOCK = 256
# Weights of groups in replicates that are sent along with a function; more of them travel with the rows.
SENT_WEIGHTS = 1_000_000
# Rows that a task weighs at a time.
WEIGHED = 2_000


def index_groups(sums: DataFrame, group: str) -> tuple[DataFrame, int]:
    """Group sums with a dense index `__g` in group order, and the number of groups."""
    indexed = materialise(ordinal(sums, [group], "__g"))
    return indexed, indexed.count()


def block_draws(df: DataFrame, groups: int, replicates: int, seed: int) -> DataFrame:
    """How many of a replicate's `groups` draws with replacement fall on each block of BLOCK groups.

    Counted where the draws are made, so only replicate and block counts shuffle.
    """
    draws = df.sparkSession.range(replicates * groups)
    replicate = F.floor(F.col("id") / groups).cast("int")
    drawn = F.pmod(md5_number(F.lit(seed), replicate, F.col("id") % groups, digits=15), F.lit(groups))
    return (draws.select(replicate.alias("replicate"), F.floor(drawn / BLOCK).alias("__block"))
            .groupBy("replicate", "__block").agg(F.count(F.lit(1)).alias("__k")))


def resampled(sums: DataFrame, group: str, replicates: int, seed: int) -> DataFrame:
    """One row per draw: `replicate`, the drawn group's index `__g` and its columns of `sums`, drawn with replacement.

    Two steps of one exact multinomial: draws are counted per block of groups, then a block's draws are dealt to its groups
    in the row that holds the block.  Nothing shuffles after that, so sums per replicate form before any shuffle.
    """
    indexed, groups = index_groups(sums, group)
    payload = [c for c in sums.columns if c != group]
    blocks = indexed.groupBy(F.floor(F.col("__g") / BLOCK).alias("__block")).agg(F.array_sort(F.collect_list(F.struct("__g", *payload))).alias("__members"))
    dealt = blocks.join(block_draws(sums, groups, replicates, seed), "__block").withColumn("__j", F.explode(F.sequence(F.lit(1), F.col("__k"))))
    at = F.pmod(md5_number(F.lit(seed), F.lit("in"), "replicate", "__block", "__j", digits=15), F.size("__members")).cast("int")
    return dealt.select("replicate", F.get("__members", at).alias("__m")).select("replicate", "__m.*")


def draw_weights(df: DataFrame, groups: int, replicates: int, seed: int) -> DataFrame:
    """How often each replicate draws each of `groups` groups (`__g` from 0 on)."""
    drawn = resampled(df.sparkSession.range(groups).select(F.col("id").alias("g")), "g", replicates, seed)
    return drawn.groupBy("replicate", "__g").agg(F.count(F.lit(1)).alias("__w"))


def interval_rows(values: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """2.5 % and 97.5 % points per metric over replicates; undefined replicates are counted out.

    One value per replicate: few hundred per group, so the built-in exact percentile is safe.
    """
    parts = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics]
    long = values.select(*by, F.explode(F.array(*parts)).alias("r")).select(*by, "r.*")
    return long.groupBy(*by, "metric").agg(F.percentile("v", F.lit(0.025)).alias("low"), F.percentile("v", F.lit(0.975)).alias("high"),
                                           F.count("v").alias("defined_replicates"))


def prediction_replicates(df: DataFrame, group: str, actual: str, predicted: str, replicates: int = 200, seed: int = 42,
                          labels: Sequence[str] = LABELS, prefix: str = "") -> DataFrame:
    """Accuracy, macro and per-class F1 of every replicate."""
    sums = df.groupBy(group).agg(*confusion_cells(actual, predicted, labels))
    weighted = resampled(sums, group, replicates, seed).groupBy("replicate").agg(*[F.sum(c).alias(c) for _, _, c in cell_names(labels)])
    chosen = {k: v for k, v in metrics_of_cells(labels).items() if k in ("accuracy", "macro_f1") or k.startswith("f1_")}
    return weighted.select("replicate", *[v.alias(prefix + k) for k, v in chosen.items()])


def prediction_bootstrap(df: DataFrame, group: str, actual: str, predicted: str, replicates: int = 200, seed: int = 42,
                         labels: Sequence[str] = LABELS) -> DataFrame:
    """Percentile intervals of accuracy, macro F1 and per-class F1."""
    values = prediction_replicates(df, group, actual, predicted, replicates, seed, labels)
    return interval_rows(values, [c for c in values.columns if c != "replicate"])


def paired_bootstrap(df: DataFrame, group: str, actual: str, baseline: str, candidate: str, replicates: int = 200,
                     seed: int = 42, labels: Sequence[str] = LABELS) -> DataFrame:
    """Intervals of candidate minus baseline, both scored on the same draws."""
    a = prediction_replicates(df, group, actual, baseline, replicates, seed, labels, "b_")
    b = prediction_replicates(df, group, actual, candidate, replicates, seed, labels, "c_")
    names = [c[2:] for c in a.columns if c.startswith("b_")]
    return interval_rows(a.join(b, "replicate").select(*[(F.col(f"c_{m}") - F.col(f"b_{m}")).alias(m) for m in names]), names)


def auc_bootstrap(df: DataFrame, group: str, actual: str, scores: Mapping[str, str], replicates: int = 200, seed: int = 42) -> DataFrame:
    """Interval of the macro one-versus-rest AUC, from weighted ranks per replicate and class.

    Scores are sorted once.  A row brings its group's number, or its weights in all replicates where groups are many; each range
    of scores adds up weight, positive weight and the area under its own part, and ranges are put together from these sums.
    """
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(s).cast("double").alias("value"),
                                        (F.col(actual) == c).cast("int").alias("pos")) for c, s in scores.items()]))
    long = df.select(group, rows.alias("r")).groupBy(group, "r.label", "r.value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("r.pos").alias("p"))
    indexed, groups = index_groups(df.select(group).distinct(), group)
    drawn = draw_weights(df, groups, replicates, seed)
    sent = None
    if groups * replicates <= SENT_WEIGHTS:
        sent = np.zeros((groups, replicates))
        for r in drawn.collect():
            sent[r["__g"], r["replicate"]] = r["__w"]
        rates = indexed.select(group, F.col("__g").alias("__weights"))
    else:
        held = drawn.groupBy("__g").agg(F.map_from_entries(F.collect_list(F.struct("replicate", "__w"))).alias("__weights"))
        rates = indexed.join(held, "__g").select(group, "__weights")  # a group that is never drawn adds nothing
    ranged = long.join(rates, group).select("label", "value", "n", "p", "__weights").repartitionByRange("label", "value").sortWithinPartitions("label", "value")

    def matrix(weights: pd.Series) -> np.ndarray:
        """One row of weights per row."""
        if sent is not None:
            return sent[weights.to_numpy(np.int64)]
        out = np.zeros((len(weights), replicates))
        for i, w in enumerate(weights):
            out[i, np.fromiter(w.keys(), np.int64, len(w))] = np.fromiter(w.values(), float, len(w))
        return out

    def areas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums over a range of ordered scores; equal scores lie in one range, and their rows may come in several batches."""
        held: dict[str, list] = {}

        def add(state: list, n: np.ndarray, p: np.ndarray) -> None:
            """Closed scores in order: their weights and positive weights, a row each."""
            upto = np.cumsum(n, axis=0)
            state[2] += (p * (state[0] + upto - n / 2)).sum(0)
            state[0] += upto[-1]
            state[1] += p.sum(0)

        for batch in batches:
            for start in range(0, len(batch), WEIGHED):
                for label, rows in batch.iloc[start:start + WEIGHED].groupby("label", sort=False):
                    value, w = rows["value"].to_numpy(float), matrix(rows["__weights"])
                    n, p = w * rows["n"].to_numpy(float)[:, None], w * rows["p"].to_numpy(float)[:, None]
                    state = held.setdefault(label, [np.zeros(replicates) for _ in range(5)] + [value[0], value[0]])
                    if value[0] == state[6]:
                        n[0] += state[3]
                        p[0] += state[4]
                    else:
                        add(state, state[3][None], state[4][None])
                    first = np.concatenate([[0], 1 + np.flatnonzero(value[1:] != value[:-1])])
                    n, p = np.add.reduceat(n, first, axis=0), np.add.reduceat(p, first, axis=0)
                    if len(first) > 1:
                        add(state, n[:-1], p[:-1])
                    state[3], state[4], state[6] = n[-1], p[-1], value[-1]
        for label, state in held.items():
            add(state, state[3][None], state[4][None])
            yield pd.DataFrame({"label": label, "first": state[5], "replicate": np.arange(replicates), "n": state[0], "p": state[1], "area": state[2]})

    parts = ranged.mapInPandas(areas, "label string, first double, replicate int, n double, p double, area double")
    earlier = Window.partitionBy("label", "replicate").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    placed = parts.withColumn("area", F.col("area") + F.col("p") * F.coalesce(F.sum("n").over(earlier), F.lit(0.0)))
    p, t = F.sum("p"), F.sum("n")
    per_class = placed.groupBy("replicate", "label").agg(F.try_divide(F.sum("area") - p * p / 2, p * (t - p)).alias("auc"))
    macro = per_class.groupBy("replicate").agg(F.when(F.count("auc") == len(scores), F.avg("auc")).alias("roc_auc_ovr"))
    return interval_rows(macro, ["roc_auc_ovr"])


def rule_replicates(df: DataFrame, items: str, group: str, rules: DataFrame, replicates: int = 200, seed: int = 42) -> DataFrame:
    """Metrics of every fixed rule in every replicate; undefined ones are NULL."""
    baskets = basket_items(df, items)
    sets = rules.select("antecedents", "consequents", parse_itemset("antecedents").alias("__a"), parse_itemset("consequents").alias("__c"))
    sides = sets.select("antecedents", "consequents", F.explode(F.array(
        F.struct(F.lit("a").alias("side"), F.col("__a").alias("set")), F.struct(F.lit("c").alias("side"), F.col("__c").alias("set")),
        F.struct(F.lit("b").alias("side"), F.array_union("__a", "__c").alias("set")))).alias("s")).select("antecedents", "consequents", "s.*")
    held = containing(baskets.select(group, items), sides.select("set").distinct(), items, "set").groupBy(group, "set").agg(
        F.count(F.lit(1)).alias("c"))
    counts = held.groupBy(group).agg(F.collect_list(F.struct("set", "c")).alias("counts"))  # one entry per set of the rules
    sums = baskets.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).join(counts, group, "left")
    drawn = resampled(sums, group, replicates, seed)
    totals = drawn.groupBy("replicate").agg(F.sum("rows").alias("n"))
    counted = drawn.select("replicate", F.explode("counts").alias("e")).groupBy("replicate", "e.set").agg(F.sum("e.c").alias("c"))
    grid = sides.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    side = lambda s, name: F.coalesce(F.max(F.when(F.col("side") == s, F.col("c"))), F.lit(0)).alias(name)
    wide = grid.join(counted, ["replicate", "set"], "left").groupBy("antecedents", "consequents", "replicate").agg(
        side("a", "antecedent_count"), side("c", "consequent_count"), side("b", "itemset_count"))
    return with_metrics(wide.join(totals, "replicate"))


def rule_bootstrap(df: DataFrame, items: str, group: str, rules: DataFrame, replicates: int = 200, seed: int = 42) -> DataFrame:
    """Intervals of support, confidence, lift, consequent support and maximal lift per rule."""
    values = rule_replicates(df, items, group, rules, replicates, seed)
    return interval_rows(values, ["support", "confidence", "lift", "consequent_support", "max_lift"], ["antecedents", "consequents"])


def rule_pass_fraction(values: DataFrame, supports: Mapping[str, float], min_confidence: float = K.MIN_CONFIDENCE,
                       min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Share of replicates in which a rule passes all thresholds; undefined metrics fail."""
    passes = lambda s: F.coalesce((F.col("support") >= s) & (F.col("confidence") > min_confidence) & (F.col("lift") > min_lift), F.lit(False))
    return values.groupBy("antecedents", "consequents").agg(*[F.avg(passes(s).cast("int")).alias(f"pass_fraction_{name}")
                                                              for name, s in supports.items()])


def pair_lift_bounds(df: DataFrame, items: str, group: str, pairs: DataFrame, replicates: int = 500, seed: int = 42,
                     alpha: float = 0.05) -> DataFrame:
    """Lower lift bound per pair, simultaneous over the family (Bonferroni-corrected percentile)."""
    rules = pairs.select(F.col("a").alias("antecedents"), F.col("b").alias("consequents"))
    values = rule_replicates(df, items, group, rules, replicates, seed)
    level = alpha / max(rules.count(), 1)
    return values.groupBy("antecedents", "consequents").agg(F.percentile("lift", F.lit(level)).alias("lift_lower_bound"),
                                                            F.count("lift").alias("defined_replicates"))

