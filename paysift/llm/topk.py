"""Exact top-k search: M-trees with covering radii and parent distances, searched best first."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scale import materialise
from .common import begin

# Entries of a page, rows of a tree, queries of a block, routing objects that deal rows out to trees.
PAGE, TREE_ROWS, QUERY_ROWS, ROUTES = 32, 2048, 512, 64
LARGEST = 1 << 26  # scaled components beyond it would not fit the sums


class MTree:
    """A paged metric tree over integer vectors in which a larger inner product is a smaller distance.

    Every vector gets one more component, sqrt(m - |x|^2) with m the largest |x|^2, and a query gets 0 there; then
    d(q, x)^2 = |q|^2 + m - 2 q.x.  A page holds entries: an object, its distance to the page's routing object, and for
    inner pages a covering radius and a child page.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order].astype(np.int64), vectors[order].astype(np.int64)
        self.norms = (self.vectors.astype(float) ** 2).sum(axis=1)
        self.m = float(self.norms.max(initial=0.0))
        largest = float(np.abs(self.vectors).max(initial=0))
        self.exact = largest * largest * max(1, self.vectors.shape[1]) < 2 ** 52  # floats then hold every product sum
        self.lifted = np.concatenate([self.vectors.astype(float), np.sqrt(np.maximum(0.0, self.m - self.norms))[:, None]], axis=1)
        self.pages: list[tuple] = []  # (leaf, objects, distances to the routing object, radii, children)
        self.root_object = int(np.argmin(((self.lifted - self.lifted.mean(axis=0)) ** 2).sum(axis=1))) if len(ids) else 0
        self.root, self.radius = self._grow(np.arange(len(ids)), self.root_object, page)

    def dump(self) -> bytes:
        """The tree as bytes, without what only growing needs."""
        return pickle.dumps({**self.__dict__, "lifted": None})

    @classmethod
    def load(cls, body: bytes) -> MTree:
        tree = cls.__new__(cls)
        tree.__dict__.update(pickle.loads(body))
        return tree

    def _from(self, rows: np.ndarray, one: int) -> np.ndarray:
        return np.sqrt(((self.lifted[rows] - self.lifted[one]) ** 2).sum(axis=1))

    def _grow(self, rows: np.ndarray, routing: int, page: int) -> tuple[int, float]:
        """The page over `rows` and its covering radius around `routing`."""
        away = self._from(rows, routing)
        radius = float(away.max(initial=0.0))
        if len(rows) <= page:
            self.pages.append((True, rows, away, None, None))
            return len(self.pages) - 1, radius
        if radius == 0:  # equal vectors: any even cut will do
            groups = np.array_split(rows, min(page, -(-len(rows) // page)))
            chosen = [int(g[0]) for g in groups]
        else:
            fan = min(page, -(-len(rows) // page) + 1)
            chosen, least = [int(rows[np.argmax(away)])], self._from(rows, int(rows[np.argmax(away)]))
            while len(chosen) < fan and least.max() > 0:  # farthest first
                chosen.append(int(rows[np.argmax(least)]))
                least = np.minimum(least, self._from(rows, chosen[-1]))
            nearest = np.argmin(np.stack([self._from(rows, c) for c in chosen]), axis=0)
            groups = [rows[nearest == i] for i in range(len(chosen))]
        grown = [self._grow(g, c, page) for g, c in zip(groups, chosen)]
        self.pages.append((False, np.array(chosen), self._from(np.array(chosen), routing), np.array([r for _, r in grown]), np.array([p for p, _ in grown])))
        return len(self.pages) - 1, radius

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> list[tuple[int, int]]:
        """The k best (score, id) of one query with a score of at least `least`; ties to smaller ids; the own id takes no part."""
        _, ids, scores = self.search_all(np.reshape(query, (1, -1)), np.array([own], np.int64), k, np.array([least]))
        return list(zip(scores.tolist(), ids.tolist()))

    def search_all(self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score): the k best of every query with a score of at least its `least` (-inf: any), best first.

        Ties go to smaller ids; a query's own id takes no part.  Pages wait in a queue by the smallest distance that they may
        hold for one of the queries that wait there, and are read once for all of them.  |d(q, parent) - d(object, parent)| -
        radius is known without a computation and spares queries and entries beyond the k-th distance; the others are measured
        together, as products of matrices.
        """
        count = len(queries)
        if not len(self.ids) or not count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        q = np.asarray(queries).astype(np.int64)
        qf = q.astype(float)
        square = (qf ** 2).sum(axis=1) + self.m
        exact = self.exact and float(np.abs(q).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, q.shape[1]) < 2 ** 52
        ids, scores = np.zeros((count, k), np.int64), np.zeros((count, k), np.int64)
        held = np.zeros(count, np.int64)  # how many of the k places are taken, best first
        floor = np.asarray(least, float).copy()
        asked = np.asarray(own, np.int64)

        def limit(at: np.ndarray) -> np.ndarray:
            """The distance within which a row can still be among the k best."""
            reach = np.sqrt(np.maximum(0.0, square[at] - 2 * np.where(floor[at] == -np.inf, 0.0, floor[at])))
            return np.where(floor[at] == -np.inf, np.inf, reach * (1 + 1e-9) + 1e-3)

        def measure(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            dots = qf[at] @ self.vectors[rows].astype(float).T if exact else q[at] @ self.vectors[rows].T
            return dots, np.sqrt(np.maximum(0.0, square[at][:, None] - 2 * dots.astype(float)))

        def keep(at: np.ndarray, rows: np.ndarray, dots: np.ndarray, open_: np.ndarray) -> None:
            found = self.ids[rows]
            some, which = np.nonzero(open_ & (dots >= floor[at][:, None]) & (asked[at][:, None] != found[None, :]))
            if not len(some):
                return
            touched, first = np.unique(some, return_index=True)
            for i, a, b in zip(at[touched].tolist(), first.tolist(), [*first[1:].tolist(), len(some)]):
                n = int(held[i])
                score = np.concatenate([scores[i, :n], dots[some[a:b], which[a:b]].astype(np.int64)])
                id = np.concatenate([ids[i, :n], found[which[a:b]]])
                best = np.lexsort((id, -score))[:k]
                held[i] = n = len(best)
                scores[i, :n], ids[i, :n] = score[best], id[best]
                if n == k:
                    floor[i] = max(floor[i], float(score[best[-1]]))

        every = np.arange(count)
        to_root = measure(every, np.array([self.root_object]))[1][:, 0]
        bound = np.maximum(0.0, to_root - self.radius)
        queue = [(float(bound.min()), 0, self.root, every, bound, to_root)]
        pushed = 1
        while queue:
            _, _, number, at, bound, parent = heapq.heappop(queue)
            reach = limit(at)
            alive = bound <= reach
            at, parent, reach = at[alive], parent[alive], reach[alive]
            if not len(at):
                continue
            leaf, rows, away, radii, children = self.pages[number]
            open_ = np.abs(parent[:, None] - away[None, :]) - (0.0 if leaf else radii[None, :]) <= reach[:, None]
            some, entries = open_.any(axis=1), np.flatnonzero(open_.any(axis=0))
            if not len(entries):
                continue
            at, reach, open_ = at[some], reach[some], open_[np.ix_(some, entries)]
            dots, distances = measure(at, rows[entries])
            if leaf:
                keep(at, rows[entries], dots, open_)
                continue
            low = np.maximum(0.0, distances - radii[entries][None, :])
            near = open_ & (low <= reach[:, None])
            for e in np.flatnonzero(near.any(axis=0)).tolist():
                w = np.flatnonzero(near[:, e])
                heapq.heappush(queue, (float(low[w, e].min()), pushed, int(children[entries[e]]), at[w], low[w, e], distances[w, e]))
                pushed += 1
        place = np.repeat(every, held)
        taken = np.arange(k)[None, :] < held[:, None]
        return place, ids[taken], scores[taken]


def scaled_vectors(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): integer vectors of rows that take part."""
    v = F.col(f"`{vector}`")
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * scale) < LARGEST))
    valid = df.where(F.col(f"`{id}`").isNotNull() & v.isNotNull() & plain)
    return valid.select(F.col(f"`{id}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
                        F.size(v).alias("dim"))


def grow_trees(vectors: DataFrame, tree_rows: int, routes: int) -> DataFrame:
    """One row per M-tree: (tree, dim, cell, salt, body).

    Rows go to the nearest of a few routing vectors (a bounded number, taken in hash order), so a tree holds vectors that
    lie together; a cell with many rows, or many copies of one vector, is cut by a hash of the row.
    """
    chosen = vectors.orderBy(F.xxhash64("id", "v")).limit(routes).select("dim", "v").collect()
    by_dim: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in chosen}:
        by_dim[dim] = np.array([r["v"] for r in chosen if r["dim"] == dim], float).reshape(-1, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, dims = np.zeros(batch.num_rows, np.int64), batch.column(2).to_numpy(zero_copy_only=False)
            for dim in set(dims[dims > 0].tolist()) & by_dim.keys():
                at = np.flatnonzero(dims == dim)
                own, routing = batch.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim).astype(float), by_dim[dim]
                cells[at] = np.argmin((routing ** 2).sum(axis=1)[None, :] - 2 * own @ routing.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=["id", "v", "dim", "cell"])

    celled = materialise(vectors.mapInArrow(assign, "id long, v array<long>, dim int, cell long").withColumn("row", F.monotonically_increasing_id()))
    cells = celled.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / tree_rows).cast("long").alias("salts"))
    salted = celled.join(cells, ["dim", "cell"]).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = MTree(group["id"].to_numpy(), np.array(group["v"].tolist(), np.int64).reshape(len(group), -1))
        first = group.iloc[0]
        return pd.DataFrame({"dim": [first["dim"]], "cell": [first["cell"]], "salt": [first["salt"]], "body": [tree.dump()]})

    grown = materialise(salted.groupBy("dim", "cell", "salt").applyInPandas(grow, "dim int, cell long, salt long, body binary"))
    return grown.select(F.monotonically_increasing_id().alias("tree"), "*")


def search_blocks(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score): the k best of each query in each tree it meets; rows hold a tree and a block of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, queries in zip(batch.column(0).to_pylist(), batch.column(1)):
                asked = queries.values.field  # the structs of the block, as columns
                ids = asked("id").to_numpy(zero_copy_only=False)
                least = [-np.inf if x is None else x for x in asked("least").to_pylist()]
                vectors = asked("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                place, found, scores = MTree.load(body).search_all(vectors, ids, k, np.array(least, float))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids[place], found, scores)], names=["query_id", "id", "score"])

    return pairs.select("body", "queries").mapInArrow(run, "query_id long, id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024,
          tree_rows: int = TREE_ROWS, query_rows: int = QUERY_ROWS, routes: int = ROUTES) -> DataFrame:
    """Each query's k largest integer inner products floor(scale * q) . floor(scale * x) over all vectors but those of its own id.

    Returns query_id, rank (from 1), vec_id, score; ties go to smaller ids.  Every query first searches one tree; its k-th
    score there bounds the search of all other trees, in blocks of queries.

    Vectors that are NULL, hold NULL or non-finite components, or scaled components of 2^26 and more, take no part, nor do
    rows without an id; vectors of different lengths are never compared; rows that repeat an id are candidates of their own
    (as queries they count once, with their smallest vector); fewer than k candidates give fewer rows; an empty table gives an empty one.
    """
    begin(vectors.sparkSession)
    rows = materialise(scaled_vectors(vectors, id, vector, scale))
    asked = scaled_vectors(queries, id, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = materialise(asked.withColumn("dim", F.size("v")))
    trees = materialise(grow_trees(rows, tree_rows, routes))
    routing = materialise(trees.groupBy("dim").agg(F.min("tree").alias("tree")))
    number = materialise(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-asked.count() // query_rows))))))
    packed = lambda frame: frame.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v", "least")).alias("queries"))
    first = packed(number.withColumn("least", F.lit(None).cast("long"))).join(routing, "dim").join(trees.select("tree", "body"), "tree")
    near = materialise(search_blocks(first, k))
    bound = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    bounded = number.join(bound.select(F.col("query_id").alias("id"), "least"), "id", "left")
    others = packed(bounded).join(trees, "dim").join(routing.select(F.col("tree").alias("first")), F.col("tree") == F.col("first"), "left_anti")
    far = search_blocks(others.repartition("tree", "block"), k)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (near.unionByName(far).withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))
