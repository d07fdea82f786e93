"""Building blocks that keep operators whole and even under skew.

None of them gathers a group in one task: each first reduces rows where they lie
(partial aggregation, per-task top-k) and only moves the reduced rows.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import scratch_path

# Stored tables of this process, each with a weak reference to its file list.
_TABLES: dict = {}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Buckets per factor e in the order-preserving bucket of a number.
BUCKETS_PER_E = 16_384
# Rows that a task of `distinct_rows` holds.
DISTINCT_ROWS = 500_000


def col(value: Column | str) -> Column:
    """Accept a column name or an expression."""
    return F.col(value) if isinstance(value, str) else value


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared checkpoint folder and continue from there.

    A lost executor then costs a re-read, a plan used twice is computed once, later steps
    read only their columns, and the optimiser knows the table's size.  Spark deletes the
    shuffle files of the step when the table is written, since nothing reads them again.
    """
    session, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    kept = session.conf.get(SHUFFLE_CLEANUP, "false")
    session.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        session.conf.set(SHUFFLE_CLEANUP, kept)
    stored = session.read.schema(df.schema).parquet(path)
    stored.__dict__["stored_at"] = path
    relation = stored._jdf.queryExecution().analyzed().relation().location()
    _TABLES[path] = session._jvm.java.lang.ref.WeakReference(relation)
    return stored


def sweep(session: SparkSession) -> None:
    """Delete stored tables that no DataFrame can read any more.

    Every DataFrame made from a stored table holds the table's file list in the JVM; once that is collected, nothing in this
    session reaches the table.  For steps of a long job whose results are written: what they left goes before the next begins.
    """
    gc.collect()
    session._jvm.System.gc()
    for path in [p for p, held in _TABLES.items() if held.get() is None]:
        _delete(session, path)


def _delete(session: SparkSession, path: str) -> None:
    _TABLES.pop(path, None)
    folder = session._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `materialise` that nothing reads any more: call it once what was made of them is stored."""
    for table in tables:
        if path := table.__dict__.pop("stored_at", None):
            _delete(table.sparkSession, path)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; the right copies of the keys are dropped.

    Catalyst turns `<=>` into an equi-join, so both sides still hash or broadcast.
    """
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def split_join(rows: DataFrame, found: DataFrame, key: str, count: str, least: int = 100_000) -> DataFrame:
    """Inner join of stored `rows` to one row per key, where `count` in `found` tells how many rows have the key.

    A key with more than max(`least`, a thousandth of all rows) rows is hot.  There are at most a thousand of them, so they
    are broadcast and their rows stay where they lie; all other keys shuffle.  `count` is dropped.
    """
    if clash := (set(rows.columns) & set(found.columns)) - {key}:
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    total, most = found.agg(F.sum(count), F.max(count)).first()
    limit = max(least, (total or 0) // 1000)
    hot = found.filter(F.col(count) > limit).drop(count)
    cold = found.filter(F.col(count) <= limit).drop(count)
    if (most or 0) <= limit:
        return rows.join(cold, key)
    beside = rows.join(F.broadcast(hot), key)
    apart = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return beside.unionByName(apart)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                rank: str | None = None) -> DataFrame:
    """The first `n` rows of each key under a total order.

    `row_number <= n` is planned with a group limit below the shuffle, so a key that
    holds a third of the rows still sends at most `n` rows per task.
    """
    name = rank or "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under `order`.  NULL keys form one group."""
    return top_per_key(df, keys, order, 1)


def distinct_rows(df: DataFrame, columns: Sequence[str], held: int = DISTINCT_ROWS) -> DataFrame:
    """Distinct rows of stored `df`, dealt by their hash to as many tasks as keep about `held` rows in each.

    A plain `distinct` also reduces rows before it deals them: a task that reads a large file would hold all its rows.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // held))
    return df.select(*columns).repartition(parts, *columns).groupBy(*columns).agg(F.lit(1).alias("__one")).drop("__one")


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Attach group aggregates to every row by aggregate-then-join.

    The same result as an aggregate window, without sending a whole group to one task.
    """
    grouped = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in stats.items()])
    return null_safe(df, grouped, keys)


def ordinal(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 0) -> DataFrame:
    """Add a gap-free position under a total order, for inputs of any size.

    Rows are range-sorted once and stored; each range learns how many rows lie before
    it from one count per range (as many numbers as partitions).
    """
    ranged = df.orderBy(*order)
    ranged = ranged.select("*", F.spark_partition_id().alias("__range"),
                           F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__offset"))
    ranged = materialise(ranged)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
              .select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")))
    return (ranged.join(F.broadcast(starts), "__range")  # one row per partition
            .withColumn(name, F.col("__start") + F.col("__offset") + F.lit(start))
            .drop("__range", "__offset", "__start"))


def _bucket(value: str) -> str:
    """SQL for an order-preserving bucket: relative width 1/16384, so some half a million per group at most."""
    return f"CAST(floor(signum({value}) * log1p(abs({value}) * 1e4D) * {BUCKETS_PER_E}) AS BIGINT)"


def _names(columns: Sequence[str], prefix: str = "") -> list[str]:
    return [f"{prefix}`{c}`" for c in columns]


def _over(keys: Sequence[str], order: str) -> str:
    partition = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"({partition}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def grouped_quantiles(df: DataFrame, value: Column | str, probs: Sequence[float], by: Sequence[str] = (),
                      names: Sequence[str] | None = None, count: str | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation) per group, NULL values ignored.

    A selection instead of a sort or a per-group buffer: count values per order-preserving
    bucket, find the buckets that hold the wanted ranks, and order only the distinct values
    of those.  Both passes combine on the map side, so one group may hold most of the rows.
    """
    base = df.select(*by, col(value).cast("double").alias("__v"))
    keys, names = _names(by), list(names or [f"q{i}" for i in range(len(probs))])
    listed = lambda columns: "".join(f"{c}, " for c in columns)
    matched = " AND ".join([f"b.{k} <=> h.{k}" for k in keys] + ["b.__b = h.__b"])
    whole = f"(PARTITION BY {', '.join(keys)})" if keys else "()"
    positions = [f"({float(p)!r}D * (__n - 1))" for p in probs]
    ranks = ", ".join(f"floor({p}), ceil({p})" for p in positions)
    pick = lambda rank: f"max(CASE WHEN {rank} >= __at AND {rank} < __at + __c THEN __v END)"
    outputs = [f"{pick(f'floor({p})')} + ({pick(f'ceil({p})')} - {pick(f'floor({p})')}) * max({p} - floor({p})) AS `{name}`"
               for name, p in zip(names, positions)]
    if count:
        outputs.append(f"max(__n) AS `{count}`")
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    # Without groups the hit list has at most two rows per probability; with groups Spark sizes the join itself.
    hint = "" if keys else "/*+ BROADCAST(h) */"
    return df.sparkSession.sql(f"""
        WITH base AS (SELECT {listed(keys)} __v, {_bucket('__v')} AS __b FROM {{base}} WHERE __v IS NOT NULL),
        counted AS (SELECT {listed(keys)} __b, count(*) AS __c FROM base GROUP BY {listed(keys)} __b),
        placed AS (SELECT *, sum(__c) OVER {whole} AS __n, coalesce(sum(__c) OVER {_over(keys, '__b')}, 0) AS __before FROM counted),
        hits AS (SELECT {listed(keys)} __b, __n, __before FROM placed
                 WHERE exists(array({ranks}), r -> r >= __before AND r < __before + __c)),
        valued AS (SELECT {hint} {listed(_names(by, 'b.'))} b.__b, b.__v, count(*) AS __c, first(h.__n) AS __n, first(h.__before) AS __before
                   FROM base b JOIN hits h ON {matched} GROUP BY {listed(_names(by, 'b.'))} b.__b, b.__v),
        ordered AS (SELECT *, __before + coalesce(sum(__c) OVER {_over([*keys, '__b'], '__v')}, 0) AS __at FROM valued)
        SELECT {listed(keys)} {', '.join(outputs)} FROM ordered {group}""", base=base)


def value_positions(df: DataFrame, value: Column | str, by: Sequence[str] = (),
                    weight: Column | str | None = None) -> DataFrame:
    """Distinct values per group with their weight `w`, the weight `before` them and the group's `total`.

    The running total is split by bucket: one window orders buckets, another the distinct
    values of each bucket, never all rows of a group.
    """
    base = df.select(*by, col(value).cast("double").alias("value"), (F.lit(1) if weight is None else col(weight)).alias("w"))
    keys = _names(by)
    listed = lambda columns: "".join(f"{c}, " for c in columns)
    matched = " AND ".join([f"d.{k} <=> s.{k}" for k in keys] + ["d.__b = s.__b"])
    whole = f"(PARTITION BY {', '.join(keys)})" if keys else "()"
    return df.sparkSession.sql(f"""
        WITH distinct_values AS (SELECT {listed(keys)} value, sum(w) AS w, {_bucket('value')} AS __b FROM {{base}}
                                 WHERE value IS NOT NULL GROUP BY {listed(keys)} value),
        buckets AS (SELECT {listed(keys)} __b, sum(w) AS __w FROM distinct_values GROUP BY {listed(keys)} __b),
        starts AS (SELECT {listed(keys)} __b, sum(__w) OVER {whole} AS total, coalesce(sum(__w) OVER {_over(keys, '__b')}, 0) AS __start FROM buckets)
        SELECT {listed(_names(by, 'd.'))} value, w, total, __start + coalesce(sum(w) OVER {_over([*_names(by, 'd.'), 'd.__b'], 'value')}, 0) AS before
        FROM distinct_values d JOIN starts s ON {matched}""", base=base)


def one_row(df: DataFrame, *columns: str) -> Column:
    """A one-row result as a struct column (a scalar subquery, computed once per plan)."""
    return df.select(F.struct(*columns)).scalar()


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row (one scalar subquery)."""
    kept = [c for c in df.columns if c not in row.columns]
    return df.select(*kept, row.select(F.struct(*row.columns)).scalar().alias("__row")).select(*kept, "__row.*")


def md5_number(*parts: Column | str, digits: int = 8) -> Column:
    """A reproducible number of 4 * `digits` bits (60 at most) from the parts; the same formula works in any SQL engine."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")
