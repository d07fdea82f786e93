"""Frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import parse_itemset
from ..functions.values import share
from ..scale import materialise, null_safe, one_row
from .aggregates import both_ends, item_shares
from .joins import containing, item_pairs, outer_status


def rule_order() -> list[Column]:
    """Lift, support, then the item texts: a total order over rules."""
    return [F.col("lift").desc(), F.col("support").desc(), F.col("antecedents"), F.col("consequents")]


def itemset_text(items: Column | str) -> Column:
    """Sorted items as `'a, b'`."""
    return F.array_join(F.array_sort(items), ", ")


def basket_items(df: DataFrame, items: str) -> DataFrame:
    """The distinct sorted item list of every row; missing lists are empty and stay in the denominator."""
    listed = F.array_sort(F.array_distinct(F.coalesce(F.col(items), F.array().cast("array<string>"))))
    return df.withColumn(items, listed)


def frequent_itemsets(df: DataFrame, items: str, min_support: float) -> DataFrame:
    """All itemsets with support >= `min_support` over all rows (empty lists included).

    Columns: itemset (sorted), freq, n, support, length.
    """
    baskets = basket_items(df, items).select(items)
    n = baskets.count()
    columns = [F.array_sort("items").alias("itemset"), F.col("freq").cast("bigint").alias("freq"),
               F.lit(n).cast("bigint").alias("n"), (F.col("freq") / F.lit(float(max(n, 1)))).alias("support"),
               F.size("items").alias("length")]
    if n == 0:
        return df.sparkSession.createDataFrame([], "items array<string>, freq bigint").select(*columns)
    model = FPGrowth(itemsCol=items, minSupport=max(min_support - 1e-9, 0.0), minConfidence=1.0).fit(baskets)
    return model.freqItemsets.select(*columns).filter(F.col("support") >= min_support)


def generate_rules(itemsets: DataFrame, min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Every split of every frequent itemset into antecedent and consequent above both (strict) thresholds.

    Consequents grow by one item a level: a larger consequent leaves a smaller, more frequent antecedent, so only confident
    splits are extended, by items that are confident consequents themselves.  A level is one join with the itemset table,
    which must hold every subset of its itemsets, as `frequent_itemsets` does.
    """
    held = lambda side: itemsets.select(F.col("itemset").alias(side), F.col("freq").alias(f"{side}_count"))

    def confident(splits: DataFrame) -> DataFrame:
        scored = splits.withColumn("antecedent", F.array_except("itemset", "consequent")).join(held("antecedent"), "antecedent")
        return materialise(scored.filter(F.try_divide(F.col("freq").cast("double"), F.col("antecedent_count").cast("double")) > min_confidence))

    longer = itemsets.filter(F.col("length") > 1).select("itemset", "freq", "n")
    first = confident(longer.select("*", F.explode(F.transform("itemset", lambda x: F.array(x))).alias("consequent")))
    singles = first.groupBy("itemset").agg(F.array_sort(F.flatten(F.collect_list("consequent"))).alias("singles"))  # at most the items of the set
    found, level = [first], first.join(singles, "itemset")
    while True:
        later = F.filter("singles", lambda x: x > F.element_at("consequent", -1))
        grown = level.select("itemset", "freq", "n", "singles", "consequent", F.explode(later).alias("x")).withColumn("consequent", F.concat("consequent", F.array("x")))
        level = confident(grown.drop("x").filter(F.size("consequent") < F.size("itemset")))
        if level.isEmpty():
            break
        found.append(level.drop("singles"))
    splits = reduce(DataFrame.unionByName, found)
    scored = splits.join(held("consequent"), "consequent").select(
        itemset_text("antecedent").alias("antecedents"), itemset_text("consequent").alias("consequents"), "itemset",
        "antecedent_count", "consequent_count", F.col("freq").alias("itemset_count"), "n")
    return with_metrics(scored).filter((F.col("confidence") > min_confidence) & (F.col("lift") > min_lift))


def with_metrics(df: DataFrame) -> DataFrame:
    """Supports, confidence, lift, leverage and conviction from counts; undefined ones are NULL."""
    a, c, both, n = (F.col(x).cast("double") for x in ("antecedent_count", "consequent_count", "itemset_count", "n"))
    confidence = F.try_divide(both, a)
    return df.withColumns({
        "antecedent_support": F.try_divide(a, n), "consequent_support": F.try_divide(c, n),
        "support": F.try_divide(both, n), "confidence": confidence,
        "lift": F.try_divide(both * n, a * c), "leverage": F.try_divide(both, n) - F.try_divide(a * c, n * n),
        "conviction": F.try_divide(1 - F.try_divide(c, n), 1 - confidence),
        "max_lift": F.try_divide(n, c)})


def itemset_counts(df: DataFrame, items: str, itemsets: DataFrame, itemset: str, high: Column | None = None) -> DataFrame:
    """Rows (and `high` rows) holding each itemset."""
    high = F.lit(False) if high is None else high
    marked = df.select(items, high.alias("__high"))
    return containing(marked, itemsets.select(itemset).distinct(), items, itemset).groupBy(itemset).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("__high").alias("high_rows"))


def population(df: DataFrame, high: Column | None = None) -> Column:
    """Struct (n, high): all rows and the `high` ones."""
    high = F.lit(False) if high is None else high
    return one_row(df.agg(F.count(F.lit(1)).alias("n"), F.count_if(high).alias("high")), "n", "high")


def score_rules(rules: DataFrame, df: DataFrame, items: str, high: Column | None = None) -> DataFrame:
    """Recompute counts and metrics of given rules (`antecedents`, `consequents` texts) on a population.

    One containment pass serves both sides and the whole itemset.  Absent items give count 0
    and undefined metrics.
    """
    baskets = basket_items(df, items)
    sets = rules.withColumns({"__a": parse_itemset("antecedents"), "__c": parse_itemset("consequents")})
    sets = sets.withColumn("__b", F.array_sort(F.array_union("__a", "__c")))
    every = sets.select(F.explode(F.array("__a", "__c", "__b")).alias("set")).distinct()
    counted = materialise(itemset_counts(baskets, items, every, "set", high))
    for side, name in (("__a", "antecedent_count"), ("__c", "consequent_count")):
        sets = sets.join(counted.select(F.col("set").alias(side), F.col("rows").alias(name)), side, "left")
    sets = sets.join(counted.select(F.col("set").alias("__b"), F.col("rows").alias("itemset_count"), "high_rows"), "__b", "left")
    total = population(baskets, high)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = sets.withColumns({c: zero(c) for c in ("antecedent_count", "consequent_count", "itemset_count", "high_rows")}
                           | {"n": total["n"], "__high": total["high"]})
    out = with_metrics(out)
    if high is not None:
        rate = share("high_rows", "itemset_count")
        out = out.withColumns({"high_tier_rate": rate, "high_tier_lift": F.try_divide(rate, share("__high", "n"))})
    return out.drop("__a", "__c", "__b", "__high", *([] if high is not None else ["high_rows"]))


def add_tier_metrics(rules: DataFrame, df: DataFrame, items: str, high: Column) -> DataFrame:
    """Postings holding the whole rule, their High share and its ratio to the overall High share."""
    baskets = basket_items(df, items)
    counted = itemset_counts(baskets, items, rules, "itemset", high)
    total = population(baskets, high)
    rate = share("high_rows", "rows")
    return (rules.join(counted, "itemset", "left")
            .withColumns({"jobs_with_itemset": F.coalesce("rows", F.lit(0)), "high_tier_rate": rate,
                          "high_tier_lift": F.try_divide(rate, share(total["high"], total["n"]))})
            .drop("rows", "high_rows"))


def mine_rules(df: DataFrame, items: str, min_support: float = K.MIN_SUPPORT, min_confidence: float = K.MIN_CONFIDENCE,
               min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Itemsets and rules in one step."""
    return generate_rules(materialise(frequent_itemsets(df, items, min_support)), min_confidence, min_lift)


def mine_high_tier(df: DataFrame, items: str, high: Column, min_support: float = K.MIN_SUPPORT,
                   min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Rules mined among High postings only, their High share measured over all postings."""
    return add_tier_metrics(mine_rules(df.filter(high), items, min_support, min_confidence, min_lift), df, items, high)


def format_rules(rules: DataFrame, metrics: Sequence[str], places: int = 4) -> DataFrame:
    """Metrics rounded half-even for export; thresholds are always applied before this."""
    return rules.withColumns({m: F.bround(m, places) for m in metrics})


def rule_key() -> Column:
    """`'a, b -> c'`."""
    return F.concat_ws(" -> ", "antecedents", "consequents")


def technical_rules(df: DataFrame, items: str, high: Column, technical: Sequence[str], known_high: DataFrame,
                    min_support: float = K.LOW_SUPPORT, main_support: float = K.MIN_SUPPORT,
                    min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Low-support rules naming a technical item, flagged as new below the main support and as known High itemsets."""
    wanted = F.array(*[F.lit(t) for t in technical])
    rules = mine_rules(df, items, min_support, min_confidence, min_lift).filter(F.arrays_overlap("itemset", wanted))
    scored = add_tier_metrics(rules, df, items, high)
    known = known_high.select("itemset", F.lit(True).alias("__known")).distinct()
    return (scored.join(known, "itemset", "left")
            .withColumns({"new_below_main_support": F.col("support") < main_support,
                          "in_high_tier_rules": F.coalesce("__known", F.lit(False))}).drop("__known"))


def technical_support_bands(df: DataFrame, items: str, technical: Sequence[str], rules: DataFrame,
                            upper: float = K.LOW_SUPPORT, lower: float = 0.01) -> DataFrame:
    """Support, band ('frequent', 'rare', 'below') and use in rules of each technical item."""
    wanted = df.sparkSession.createDataFrame([(t,) for t in technical], "item string")
    counts = df.select(F.explode(F.array_distinct(items)).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    used = rules.select(F.explode("itemset").alias("item")).distinct().withColumn("__used", F.lit(True))
    support = F.coalesce(share("c", df.agg(F.count(F.lit(1))).scalar()), F.lit(0.0))
    return (wanted.join(counts, "item", "left").join(used, "item", "left")
            .select("item", F.coalesce("c", F.lit(0)).alias("jobs"), support.alias("support"), F.coalesce("__used", F.lit(False)).alias("in_rules"))
            .withColumn("band", F.when(F.col("support") >= upper, "frequent").when(F.col("support") >= lower, "rare").otherwise("below")))


def strict_technical_rules(df: DataFrame, items: str, technical: Sequence[str], min_support: float = K.LOW_SUPPORT,
                           min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Rules among technical items only; every posting stays in the denominator."""
    wanted = F.array(*[F.lit(t) for t in technical])
    return mine_rules(df.withColumn(items, F.array_intersect(items, wanted)), items, min_support, min_confidence, min_lift)


def pair_metrics(df: DataFrame, items: str, high: Column | None = None, within: Sequence[str] | None = None) -> DataFrame:
    """Postings, support, lift and High metrics of every co-occurring item pair (a < b).

    Pairs are formed inside each list and counted before anything is shuffled; `within`
    restricts lists first.
    """
    flag = F.lit(False) if high is None else high
    baskets = basket_items(df, items)
    if within is not None:
        baskets = baskets.withColumn(items, F.array_intersect(items, F.array(*[F.lit(w) for w in within])))
    marked = baskets.select(items, flag.alias("__high"))
    pairs = (marked.select("__high", F.explode(item_pairs(items)).alias("p")).groupBy("p.a", "p.b")
             .agg(F.count(F.lit(1)).alias("jobs"), F.count_if("__high").alias("high_jobs")))
    singles = marked.select(F.explode(items).alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("c"))
    total = population(marked, F.col("__high"))
    out = (pairs.join(singles.select(F.col("i").alias("a"), F.col("c").alias("a_jobs")), "a")
           .join(singles.select(F.col("i").alias("b"), F.col("c").alias("b_jobs")), "b").withColumn("n", total["n"]))
    j, ca, cb, n = (F.col(x).cast("double") for x in ("jobs", "a_jobs", "b_jobs", "n"))
    rate = share("high_jobs", "jobs")
    return out.withColumns({"support": j / n, "lift": j * n / (ca * cb), "jaccard": j / (ca + cb - j), "high_tier_rate": rate,
                            "high_tier_lift": F.try_divide(rate, share(total["high"], total["n"]))})


def rank_general(rules: DataFrame, n: int = 10) -> DataFrame:
    """Top rules by lift."""
    return rules.orderBy(*rule_order()).limit(n)


def rank_high(rules: DataFrame, n: int = 5) -> DataFrame:
    """Top rules by High share."""
    return rules.orderBy(F.col("high_tier_rate").desc(), F.col("lift").desc(), F.col("jobs_with_itemset").desc(),
                         "antecedents", "consequents").limit(n)


def adaptive_rules(df: DataFrame, items: str, min_items: int, min_rules: int, support: float = K.MIN_SUPPORT,
                   fallback: float = K.LOW_SUPPORT, min_confidence: float = K.MIN_CONFIDENCE,
                   min_lift: float = K.MIN_LIFT) -> tuple[DataFrame, float]:
    """Mine postings with enough items; with too few rules, once more at the lower support."""
    eligible = basket_items(df, items).filter(F.size(items) >= min_items)
    rules = materialise(mine_rules(eligible, items, support, min_confidence, min_lift))
    if rules.count() >= min_rules:
        return rules, support
    return materialise(mine_rules(eligible, items, fallback, min_confidence, min_lift)), fallback


def compare_rules(train: DataFrame, live: DataFrame, live_baskets: DataFrame, items: str) -> DataFrame:
    """Rules of both sources, new in live or gone from live; the gone ones get their live metrics computed."""
    metrics = ["support", "confidence", "lift"]
    merged = outer_status(train.select("antecedents", "consequents", *metrics), live.select("antecedents", "consequents", *metrics),
                          ["antecedents", "consequents"], metrics, ("both", "disappeared_in_live", "new_in_live"))
    direct = score_rules(train.select("antecedents", "consequents"), live_baskets, items).select(
        "antecedents", "consequents", *[F.col(m).alias(f"__{m}") for m in metrics])
    joined = null_safe(merged, direct, ["antecedents", "consequents"])
    return joined.select("status", "antecedents", "consequents", *[F.col(f"{m}_left").alias(f"{m}_train") for m in metrics],
                         *[F.coalesce(f"{m}_right", f"__{m}").alias(f"{m}_live") for m in metrics])


def threshold_checks(min_support: float, min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> dict[str, Column]:
    """Per-criterion results, the list of failures and whether the lift ceiling alone blocks a rule."""
    holds = {"support": F.col("support") >= min_support, "confidence": F.col("confidence") > min_confidence,
             "lift": F.col("lift") > min_lift}
    holds = {name: F.coalesce(test, F.lit(False)) for name, test in holds.items()}
    measurable = F.col("support").isNotNull() & F.col("confidence").isNotNull() & F.col("lift").isNotNull()
    failures = F.concat_ws(", ", *[F.when(~test, F.lit(name)) for name, test in holds.items()])
    passes = holds["support"] & holds["confidence"] & holds["lift"]
    return {"support_holds": holds["support"], "confidence_holds": holds["confidence"], "lift_threshold_holds": holds["lift"],
            "passes": passes & measurable, "failure_reasons": F.when(measurable, failures).otherwise("not measurable"),
            "lift_holds": holds["confidence"] & holds["lift"],
            "lift_ceiling_blocks_threshold": F.coalesce(F.col("max_lift") <= min_lift, F.lit(False))}


def validate_rules(train: DataFrame, sample: DataFrame, items: str, min_items: int = K.MIN_SKILLS,
                   min_support: float = K.MIN_SUPPORT, min_confidence: float = K.MIN_CONFIDENCE,
                   min_lift: float = K.MIN_LIFT, capped: DataFrame | None = None) -> DataFrame:
    """Check fixed rules on another sample, and again on its company-capped version.

    A rule is validated when it passes support, confidence and lift there, which is exactly
    when mining that sample would find it.
    """
    metrics = ["support", "confidence", "lift"]
    given = train.select("antecedents", "consequents", *[F.col(m).alias(f"training_{m}") for m in metrics])
    eligible = lambda df: basket_items(df, items).filter(F.size(items) >= min_items)
    checks = threshold_checks(min_support, min_confidence, min_lift)
    scored = score_rules(given, eligible(sample), items).withColumns(checks).withColumnRenamed("passes", "validated")
    if capped is None:
        return scored
    again = score_rules(given.select("antecedents", "consequents"), eligible(capped), items).select(
        "antecedents", "consequents", "lift", checks["passes"].alias("validated_company_capped"))
    return null_safe(scored, again.withColumnRenamed("lift", "lift_company_capped"), ["antecedents", "consequents"])


def evaluate_fixed_rules(rules: DataFrame, sample: DataFrame, items: str, min_items: int = K.MIN_SKILLS,
                         primary: float = K.MIN_SUPPORT, sensitivity: float = K.LOW_SUPPORT,
                         min_confidence: float = K.MIN_CONFIDENCE, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Counts, metrics and results of fixed rules at the primary and the sensitivity support."""
    eligible = basket_items(sample, items).filter(F.size(items) >= min_items)
    scored = score_rules(rules.select("antecedents", "consequents"), eligible, items)
    for name, support in (("primary", primary), ("sensitivity", sensitivity)):
        checks = threshold_checks(support, min_confidence, min_lift)
        scored = scored.withColumns({f"passes_{name}": checks["passes"], f"failure_reasons_{name}": checks["failure_reasons"],
                                     "lift_ceiling_blocks_threshold": checks["lift_ceiling_blocks_threshold"]})
    return scored


def eligibility_report(sample: DataFrame, items: str, min_items: int = K.MIN_SKILLS) -> DataFrame:
    """Postings, eligible and excluded ones, and empty lists."""
    n = F.size(F.array_distinct(items))
    return sample.agg(F.count(F.lit(1)).alias("postings"), F.count_if(n >= min_items).alias("eligible"),
                      F.count_if(n < min_items).alias("excluded"), F.count_if(n == 0).alias("empty"))


def source_comparison(live: DataFrame, train: DataFrame, train_group: DataFrame, items: str, technical: Sequence[str],
                      capped: DataFrame | None = None) -> DataFrame:
    """Item shares of a live source, all training postings and a training group side by side."""
    sides = {"live_share": live, "train_share": train, "train_group_share": train_group}
    if capped is not None:
        sides["live_share_capped"] = capped
    shares = [item_shares(df, items, "skill").select("skill", F.lit(name).alias("side"), "share") for name, df in sides.items()]
    stacked = shares[0]
    for part in shares[1:]:
        stacked = stacked.unionByName(part)
    pick = lambda name: F.coalesce(F.max(F.when(F.col("side") == name, F.col("share"))), F.lit(0.0)).alias(name)
    wide = stacked.groupBy("skill").agg(*[pick(name) for name in sides])
    return wide.withColumns({"is_technical": F.col("skill").isin(list(technical)),
                             "change_vs_group_pp": 100 * (F.col("live_share") - F.col("train_group_share")),
                             "ratio_vs_group": F.try_divide("live_share", "train_group_share")})


def demand_shifts(comparison: DataFrame, n: int = 3, min_share: float = 0.05) -> DataFrame:
    """The largest rises and drops among items common in either source."""
    common = comparison.filter((F.col("live_share") >= min_share) | (F.col("train_group_share") >= min_share))
    return both_ends(common, "change_vs_group_pp", n, "skill")


def template_concentration(df: DataFrame, items: str, itemset: Sequence[str], company: str) -> DataFrame:
    """Companies whose postings hold a whole itemset, with count and share."""
    wanted = F.array(*[F.lit(i) for i in itemset])
    holding = df.filter(F.size(F.array_except(wanted, F.col(items))) == 0)
    counts = holding.groupBy(company).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", share("n", counts.agg(F.sum("n")).scalar()))


def shares_by_date(df: DataFrame, items: str, date: str, top: int) -> DataFrame:
    """Share per snapshot of the items most frequent in the latest snapshot."""
    exploded = df.select(date, F.explode(F.array_distinct(items)).alias("skill"))
    counts = exploded.groupBy(date, "skill").agg(F.count(F.lit(1)).alias("n"))
    latest = counts.filter(F.col(date) == df.agg(F.max(date)).scalar())
    chosen = latest.orderBy(F.col("n").desc(), "skill").limit(top).select("skill")
    totals = df.groupBy(date).agg(F.count(F.lit(1)).alias("total"))
    return counts.join(chosen, "skill", "left_semi").join(totals, date).select(date, "skill", "n", share("n", "total").alias("share"))


def employer_concentration(df: DataFrame, company: str, top: int) -> DataFrame:
    """The largest companies and their share of all postings."""
    counts = df.groupBy(company).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.orderBy(F.col("n").desc(), company).limit(top).withColumn("share", share("n", total))


def replicate_pairs(df: DataFrame, items: str, group: str, employer: str, is_validation: Column, min_pair_employers: int,
                    min_item_employers: int, support_range: tuple[float, float], min_lift: float,
                    max_pairs: int = 10, min_confidence: float = K.MIN_CONFIDENCE) -> DataFrame:
    """Discovery pairs under the support, lift, confidence and employer rules, and their validation metrics."""
    baskets = basket_items(df, items)
    found = pair_metrics(baskets.filter(~is_validation), items)
    low, high = support_range
    best = F.greatest(share("jobs", "a_jobs"), share("jobs", "b_jobs"))
    found = found.filter((F.col("support") >= low) & (F.col("support") < high) & (F.col("lift") >= min_lift) & (best > min_confidence))
    discovery = baskets.filter(~is_validation)
    pair_employers = (discovery.select(employer, F.explode(item_pairs(items)).alias("p")).select("p.a", "p.b", employer).distinct()
                      .groupBy("a", "b").agg(F.count(employer).alias("pair_employers")))
    item_employers = (discovery.select(employer, F.explode(items).alias("i")).distinct()
                      .groupBy("i").agg(F.count(employer).alias("e")))
    kept = (found.join(pair_employers, ["a", "b"])
            .join(item_employers.select(F.col("i").alias("a"), F.col("e").alias("a_employers")), "a")
            .join(item_employers.select(F.col("i").alias("b"), F.col("e").alias("b_employers")), "b")
            .filter((F.col("pair_employers") >= min_pair_employers) & (F.col("a_employers") >= min_item_employers)
                    & (F.col("b_employers") >= min_item_employers)))
    chosen = kept.orderBy(F.col("lift").desc(), F.col("jobs").desc(), "a", "b").limit(max_pairs)
    checked = pair_metrics(baskets.filter(is_validation), items).select(
        "a", "b", F.col("jobs").alias("validation_jobs"), F.col("support").alias("validation_support"), F.col("lift").alias("validation_lift"))
    return chosen.select("a", "b", "jobs", "a_jobs", "b_jobs", "n", "support", "lift", "pair_employers", "a_employers", "b_employers"
                         ).join(checked, ["a", "b"], "left")


def holm(df: DataFrame, p_value: str, alpha: float = 0.05) -> DataFrame:
    """Holm step-down over a fixed family of tests: adjusted p-values and rejections."""
    order = Window.orderBy(p_value)
    m = F.count(F.lit(1)).over(Window.partitionBy())
    stepped = F.least(F.lit(1.0), F.col(p_value) * (m - F.row_number().over(order) + 1))
    ranked = df.withColumn("__step", stepped)
    adjusted = F.max("__step").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn("adjusted_p", adjusted).withColumn("rejected", F.col("adjusted_p") <= alpha).drop("__step")
