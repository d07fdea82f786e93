"""Building blocks against plain numpy, on skewed data."""

import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysift import scale


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows; values repeat, are negative, tiny and huge."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.choice([rng.gauss(0, 1), rng.expovariate(1e-6), 5.0, -1e-9, 1.7e9 + rng.random()])) for i in range(4000)]
    rows += [("one", 3.0), ("none", None), (None, 2.0), (None, 4.0)]
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(5)


def test_grouped_quantiles_match_numpy(skewed):
    rows, df = skewed
    probs = [0.0, 0.025, 1 / 3, 0.5, 2 / 3, 0.975, 1.0]
    got = {r["k"]: r for r in scale.grouped_quantiles(df, "v", probs, ["k"], count="n").collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        if not values:
            assert key not in got
            continue
        assert got[key]["n"] == len(values)
        np.testing.assert_allclose([got[key][f"q{i}"] for i in range(len(probs))], np.quantile(values, probs), rtol=1e-12, atol=1e-12)


def test_global_quantiles_and_exact_thirds(spark):
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("v"))
    row = scale.grouped_quantiles(df, "v", [1 / 3, 2 / 3]).first()
    assert (row["q0"], row["q1"]) == pytest.approx((4.0, 7.0))


def test_value_positions(skewed):
    rows, df = skewed
    got = {(r["k"], r["value"]): r for r in scale.value_positions(df, "v", ["k"]).collect()}
    for (key, value), r in got.items():
        group = [v for k, v in rows if k == key and v is not None]
        assert r["before"] == sum(v < value for v in group) and r["w"] == group.count(value) and r["total"] == len(group)


def test_ordinal_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"x{i * 7919 % 1000:04d}",) for i in range(1000)], "s string").repartition(9)
    rows = scale.ordinal(df, ["s"], "i", 1).collect()
    assert [r["s"] for r in sorted(rows, key=lambda r: r["i"])] == sorted(r["s"] for r in rows)
    assert sorted(r["i"] for r in rows) == list(range(1, 1001))


def test_top_per_key_limits_before_the_shuffle(skewed):
    _, df = skewed
    top = scale.top_per_key(df, ["k"], [F.col("v").desc_nulls_last()], 2, "rank")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.filter("k = 'hot'").count() == 2


def test_with_group_stats_joins_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, v int")
    rows = {(r["k"], r["v"]): r["s"] for r in scale.with_group_stats(df, ["k"], s=F.sum("v")).collect()}
    assert rows == {(None, 1): 4, (None, 3): 4, ("a", 5): 5}


def test_checkpoint_folder_is_the_configured_one(spark):
    from paysift.session import scratch_path, shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert (named is None) or shared_dir(spark) == named
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_split_join_and_discarded_tables(spark):
    rows = scale.materialise(spark.createDataFrame([(1, i) for i in range(50)] + [(2, 50), (3, 51)], "k int, x int"))
    found = scale.materialise(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("top")))
    joined = scale.split_join(rows, found, "k", "n", least=10)
    assert "n" not in joined.columns and "BroadcastHashJoin" in joined._jdf.queryExecution().toString()
    assert sorted((r["k"], r["x"], r["top"]) for r in joined.collect()) == [(1, i, 49) for i in range(50)] + [(2, 50, 50), (3, 51, 51)]
    path = Path(found.stored_at)
    assert path.exists()
    scale.discard(found, found, rows)
    assert not path.exists()


def test_sweep_deletes_only_tables_out_of_reach(spark):
    kept = scale.materialise(spark.range(5))
    lost = scale.materialise(spark.range(6))
    derived, paths = kept.where("id > 1").select("id"), (Path(kept.stored_at), Path(lost.stored_at))
    del kept, lost
    for _ in range(20):  # the JVM learns of dropped frames a moment later
        scale.sweep(spark)
        if not paths[1].exists():
            break
        time.sleep(0.5)
    assert paths[0].exists() and not paths[1].exists() and derived.count() == 3
