"""Prefix trie of conversations: Z-fast tries per range of conversations, merged by prefix hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scale import discard, materialise
from .common import begin

WORD = r"[^\x20\x09-\x0D]+"
# Turns a task's trie holds before it is handed on, rows of an output batch, ids of one chunk of a node's ends.
HELD, ROWS, CHUNK = 400_000, 20_000, 4_096
ROOT = bytes(16)
PARTIAL = "h1 long, h2 long, p1 long, p2 long, depth long, n long, conv_id long, words long, ends string"


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & -1 << (low ^ high).bit_length() - 1


class Compacted:
    """A compacted node: the depths (low, high] of a path, the conversations that end at `high`, and what lies below."""

    __slots__ = ("path", "words", "low", "high", "ends", "below", "n", "first")

    def __init__(self, path: list[bytes], words: list[int], low: int, high: int):
        self.path, self.words, self.low, self.high = path, words, low, high
        self.ends: list[int] = []
        self.below: dict[bytes, Compacted] = {}
        self.n = self.first = 0


class ZFastTrie:
    """Compacted nodes by the prefix hash at the two-fattest depth of their edge (the handle).

    A path is the list of a conversation's prefix hashes, so equal hashes at a depth mean equal prefixes.
    """

    def __init__(self) -> None:
        self.root = Compacted([ROOT], [0], -1, 0)
        self.handles: dict[bytes, Compacted] = {}
        self.held = 0

    def handle(self, node: Compacted) -> bytes:
        return node.path[fattest(node.low, node.high)]

    def locate(self, path: list[bytes]) -> tuple[Compacted, Compacted | None]:
        """(node, exit): a node whose whole edge lies on `path`, and the node further down in whose edge the path ends or leaves; None if it ends or leaves at the first.

        Fat binary search: a handle that is missing at the fattest depth of an interval rules out all depths from it on.
        """
        last = len(path) - 1
        node, low, high = self.root, 0, last
        while low < high:
            middle = fattest(low, high)
            found = self.handles.get(path[middle])
            if found is None:
                high = middle - 1
            elif found.high <= last and found.path[found.high] == path[found.high]:
                node, low = found, found.high
            else:
                return node, found
        return node, node.below.get(path[node.high + 1]) if node.high < last else None

    def insert(self, conversation: int, path: list[bytes], words: list[int]) -> None:
        last = len(path) - 1
        node, leaves = self.locate(path)
        if leaves is not None:
            low, high = leaves.low + 1, min(leaves.high, last)  # the first turn of the edge is shared
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if leaves.path[middle] == path[middle] else (low, middle - 1)
            node = self.split(leaves, low) if low < leaves.high else leaves
        if node.high < last:
            leaf = Compacted(path, words, node.high, last)
            node.below[path[node.high + 1]] = leaf
            self.handles[self.handle(leaf)] = leaf
            self.held += leaf.high - leaf.low
            node = leaf
        node.ends.append(conversation)
        self.held += 1

    def split(self, node: Compacted, depth: int) -> Compacted:
        """Cut an edge at `depth`: the upper part is a new node, which keeps the place above; the lower part gets a new handle."""
        del self.handles[self.handle(node)]
        upper, lower = node, Compacted(node.path, node.words, depth, node.high)
        lower.ends, lower.below = node.ends, node.below
        upper.ends, upper.below, upper.high = [], {node.path[depth + 1]: lower}, depth
        self.handles[self.handle(upper)], self.handles[self.handle(lower)] = upper, lower
        return upper

    def expanded(self) -> Iterator[tuple]:
        """A row per depth of every edge (the conversations of a depth are those below its node), and the ends of every node in chunks."""
        order, at = [self.root], 0
        while at < len(order):
            order.extend(order[at].below.values())
            at += 1
        for node in reversed(order):
            below = node.below.values()
            node.n = len(node.ends) + sum(b.n for b in below)
            node.first = min([*node.ends[:1], *(b.first for b in below)], default=0)
        for node in order:
            for depth in range(node.low + 1, node.high + 1):
                yield node.path[depth], node.path[depth - 1] if depth else ROOT, depth, node.n, node.first, node.words[depth], None
            for i in range(0, len(node.ends), CHUNK):
                yield node.path[node.high], ROOT, None, None, node.ends[i], None, ",".join(map(str, node.ends[i:i + CHUNK]))


def digests(turns: list[tuple[bytes, int]]) -> tuple[list[bytes], list[int]]:
    """Hash and last text's words of every prefix."""
    path, words = [ROOT], [0]
    for turn, count in turns:
        path.append(hashlib.blake2b(path[-1] + turn, digest_size=16).digest())
        words.append(count)
    return path, words


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = PARTIAL.replace(" long", "").replace(" string", "").split(", ")
    halves = lambda b: (int.from_bytes(b[:8], "little", signed=True), int.from_bytes(b[8:], "little", signed=True))
    columns = list(zip(*((*halves(r[0]), *halves(r[1]), *r[2:]) for r in rows)))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if name == "ends" else pa.int64()) for name, c in zip(names, columns)], names=names)


def local_tries(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows PARTIAL from turns (base, conv_id, taken, t1, t2, words) that come sorted by conversation and turn.

    Conversations are rebuilt as they pass: the first `taken` turns of the base, then their own after as many.
    """
    def turns() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        held = []
        for row in trie.expanded():
            held.append(row)
            if len(held) == ROWS:
                yield as_batch(held)
                held = []
        if held:
            yield as_batch(held)

    trie, base, start = ZFastTrie(), None, []
    for (of, conversation, taken), group in groupby(turns(), itemgetter(0, 1, 2)):
        own = [(t1.to_bytes(8, "little", signed=True) + t2.to_bytes(8, "little", signed=True), count) for *_, t1, t2, count in group]
        if of == conversation:
            base, start = of, own[:most]
        elif of != base:
            base, start = of, []
        rebuilt = own if of == conversation else start[:taken] + own[taken:]
        trie.insert(conversation, *digests(rebuilt))
        if trie.held >= HELD:
            yield from rows(trie)
            trie = ZFastTrie()
    if trie.held:
        yield from rows(trie)


def end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, ends_sha256) from chunks of ids (h1, h2, ends) sorted by node and id; a node's ids stream through one hash."""
    def chunks() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def batched(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["h1", "h2", "ends_sha256"])

    done: list[tuple] = []
    for (h1, h2), group in groupby(chunks(), itemgetter(0, 1)):
        digest, separator = hashlib.sha256(), b""
        for *_, ends in group:
            digest.update(separator + ends.encode())
            separator = b","
        done.append((h1, h2, digest.hexdigest()))
        if len(done) == ROWS:
            yield batched(done)
            done = []
    if done:
        yield batched(done)


def chain_totals(chains: DataFrame) -> DataFrame:
    """(conv_id, leaves, saved): each chain's own sums and those of all chains that hang from it, directly or not.

    Pointer doubling: after round k a chain has the sums of those fewer than 2^k steps below, and points 2^k steps up.
    """
    state = materialise(chains.select("conv_id", F.col("up").alias("jump"), "leaves", "saved"))
    while state.where("jump IS NOT NULL").limit(1).count():
        given = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        further = state.where("jump IS NOT NULL").select(F.col("conv_id").alias("jump"), F.col("jump").alias("further"))
        stepped = (state.join(given, "conv_id", "left").join(further, "jump", "left")
                   .select("conv_id", F.col("further").alias("jump"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                           (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")))
        before, state = state, materialise(stepped)
        discard(before)
    return state.select("conv_id", "leaves", "saved")


def conversation_trie(conversations: DataFrame, period: int = 20, most: int = 3) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens` and `ends_sha256`.

    Conversation c takes the first crc32(c) mod (`most` + 1) turns of conversation c - c mod `period`, then its own after as
    many; with `period` 1 conversations stay as they are.  Turns are ordered by `turn`, NULL first, ties by a hash of role and text.
    NULL roles and texts count as empty; rows without conv_id take no part; ids below zero use the remainder that is never
    negative.  Repeated rows are turns of their own.  Only conv_id, turn, role and text are read.  An empty table has no nodes,
    not even a root.  Texts of any length are hashed (128 bits) and counted in Spark; what a task holds of a conversation is 16
    bytes and a count for each turn.

    Ranges of conversations go through tasks in order of their ids.  A task inserts them into a Z-fast trie and hands on its
    expanded nodes, one row per prefix and range however many conversations share it; nodes of all ranges merge by prefix
    hash.  Nodes with the same smallest conversation form a chain down one path, so what lies below a node is the rest of its
    chain and the chains that hang from it.
    """
    begin(conversations.sparkSession)
    id, text, role = F.col("conv_id").cast("long"), F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    light = materialise(conversations.where("conv_id IS NOT NULL").select(
        (id - F.pmod(id, F.lit(period))).alias("base"), id.alias("conv_id"), F.pmod(F.crc32(id.cast("string")), F.lit(most + 1)).cast("int").alias("taken"),
        "turn", F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))
    order = ["base", "conv_id", "taken", F.asc_nulls_first("turn"), "t1", "t2"]
    ranged = light.repartitionByRange("base").sortWithinPartitions(*order).select("base", "conv_id", "taken", "t1", "t2", "words")
    partial = materialise(ranged.mapInArrow(lambda batches: local_tries(batches, most), PARTIAL))
    discard(light)
    merged = partial.where("depth IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("depth"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words"))
    nodes = materialise(merged)
    ended = (partial.where("ends IS NOT NULL").select("h1", "h2", "conv_id", "ends").repartition("h1", "h2").sortWithinPartitions("h1", "h2", "conv_id")
             .select("h1", "h2", "ends").mapInArrow(end_hashes, "h1 long, h2 long, ends_sha256 string"))
    # Chains: where each begins and ends, and the chain its first node hangs from.
    heads = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "p1", "p2")).alias("top"), F.max("depth").alias("last"), F.sum((F.col("n") - 1) * F.col("words")).alias("saved"))
    heads = heads.select("conv_id", F.col("top.depth").alias("start"), "top.p1", "top.p2", "last", "saved")
    above = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("up"))
    hung = materialise(heads.where("start > 0").join(above, ["p1", "p2"]).select("conv_id", "start", "last", "saved", "up")
                       .unionByName(heads.where("start = 0").select("conv_id", "start", "last", "saved", F.lit(None).cast("long").alias("up"))))
    places = hung.where("up IS NOT NULL").select(F.col("up").alias("conv_id"), (F.col("start") - 1).alias("last")).distinct().withColumn("inner", F.lit(True))
    totals = chain_totals(hung.join(places, ["conv_id", "last"], "left").withColumn("leaves", F.when(F.col("inner"), 0).otherwise(1).cast("long")))
    hanging = (hung.where("up IS NOT NULL").join(totals.select("conv_id", "leaves", F.col("saved").alias("total")), "conv_id")
               .groupBy(F.col("up").alias("conv_id"), (F.col("start") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("sides"), F.sum("leaves").alias("leaves"), F.sum("total").alias("total")))
    ends = hung.select("conv_id", "start", "last", "up")
    joined = nodes.join(hanging, ["conv_id", "depth"], "left").join(ends, "conv_id").join(ended, ["h1", "h2"], "left")
    sides, further = F.coalesce("sides", F.lit(0)), F.col("depth") < F.col("last")
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaf = F.coalesce("leaves", F.lit(0)) + F.when(further | (sides > 0), 0).otherwise(1)
    return joined.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("start"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (sides + further.cast("long")).alias("n_children"), F.sum(leaf).over(below).alias("n_leaves"),
        F.sum((F.col("n") - 1) * F.col("words") + F.coalesce("total", F.lit(0))).over(below).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
