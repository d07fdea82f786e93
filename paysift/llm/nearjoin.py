"""N-gram Jaccard join by signature trees: exact links and components of near-duplicate texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.splits import star_components
from ..scale import discard, materialise
from .common import Words, begin, chunk_row, mix, over_texts, sum_chunks, widened

SHINGLE, SIMILARITY = 5, 75  # words; percent
# A token is a hash of 48 bits of a shingle, kept in six bytes.
TOKEN_BITS, TOKEN_BYTES = 48, 6
# Counters of how often tokens occur, in a table of a fixed size; a token that lies HOT standard deviations of rare tokens above
# the mean load is frequent, so the least number of sets that tells grows as the root of the input.
COUNTERS, COUNTER_CHUNK, HOT = 1 << 20, 1 << 14, 4
# Classes of sizes between a size and its double, and the most classes that lie between two sets that link.
SIZE_CLASSES = 16
SIZE_GAP = int(np.ceil(SIZE_CLASSES * np.log2(100 / SIMILARITY)))
# Bits of the smallest signature, sets below a node of a signature tree, sets of a block that meet in one task, rounds of star pairs.
LEAST_BITS, FANOUT, BLOCK, ROUNDS = 1024, 16, 512, 2
# Pairs a task holds to tell those that come again.
HELD_PAIRS = 1 << 18
# Joining turns go on while at least one in so many compared pairs links.
SETTLED = 20
# A table of a fixed size that tells which sets are wanted; false hits are dropped by the join that follows.
WANTED_BITS = 1 << 23
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def token_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct tokens of each text: its shingles of five words, or all its words when it has fewer."""
    words = Words(pc.ascii_lower(texts))
    hashed, sets = words.hashes(), []
    total = np.zeros(len(hashed), np.uint64)
    for j in range(SHINGLE):
        total[:len(hashed) - j] += mix(hashed[j:] + STEPS[j])
    for start, count in zip(words.starts[:-1], words.counts):
        if count >= SHINGLE:
            sets.append(np.unique(mix(total[start:start + count - SHINGLE + 1]) >> np.uint64(64 - TOKEN_BITS)))
        elif count:
            whole = mix(hashed[start:start + count] + STEPS[:count]).sum(keepdims=True) + np.uint64(count)
            sets.append(mix(whole) >> np.uint64(64 - TOKEN_BITS))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def packed(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]).tobytes()


def unpacked(body: bytes) -> np.ndarray:
    wide = np.zeros((len(body) // TOKEN_BYTES, 8), np.uint8)
    wide[:, :TOKEN_BYTES] = np.frombuffer(body, np.uint8).reshape(-1, TOKEN_BYTES)
    return wide.view("<u8").ravel()


def as_sets(texts: pa.Array) -> dict[str, object]:
    bodies = [packed(s) for s in token_sets(texts)]
    digests = [int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True) if b else None for b in bodies]
    return {"n_shingles": pa.array([len(b) // TOKEN_BYTES for b in bodies], pa.int64()), "set_id": pa.array(digests, pa.int64()), "tokens": pa.array(bodies, pa.binary())}


def fresh_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Batches of (set ids, tokens), each set once per task."""
    met: set[int] = set()
    for batch in batches:
        ids, sets = [], []
        for id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if id is not None and id not in met:
                met.add(id)
                ids.append(id)
                sets.append(unpacked(body))
        if ids:
            yield ids, sets


def token_classes(sets: DataFrame) -> np.ndarray:
    """Per counter 0 for rare tokens, else 1, 2, ... by how often its tokens occur among all sets.

    Every task counts its tokens in a table of a fixed size; the tables are added up in Spark.  Any order of tokens gives
    exact joins; putting frequent ones last keeps shared passages out of the prefixes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for _, own in fresh_sets(batches):
            counts += np.bincount((np.concatenate(own) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        rows = counts.reshape(-1, COUNTER_CHUNK)
        part = int(counts.sum() % 16)  # any even spread will do
        for chunk in np.flatnonzero(rows.any(axis=1)):
            yield chunk_row(chunk, part, rows[chunk])

    parts = sets.select("set_id", "tokens").mapInArrow(run, "chunk long, part long, body binary")
    counts = np.zeros((COUNTERS // COUNTER_CHUNK, COUNTER_CHUNK), np.int64)
    for row in sum_chunks(parts, COUNTER_CHUNK).collect():
        counts[row["chunk"]] = widened(row["body"], COUNTER_CHUNK)
    return classed(counts.ravel())


def classed(counts: np.ndarray) -> np.ndarray:
    """The class of each counter: 0 up to what rare tokens alone would make of it, then one more for each doubling."""
    mean = counts.mean()
    above = (counts - mean) / (HOT * max(1.0, mean ** 0.5))
    return np.where(above >= 1, np.log2(np.maximum(above, 1)) + 1, 0).astype(np.uint8)


def prefix(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The first tokens of a set, rare ones first: two sets similar enough share one of them."""
    size = len(tokens)
    keep = size - -(-SIMILARITY * size // 100) + 1
    order = np.argsort(classes[(tokens % np.uint64(COUNTERS)).astype(np.int64)], kind="stable")
    return tokens[order[:keep]]


def size_classes(sizes: np.ndarray) -> np.ndarray:
    """A byte for each size; those of two sets that link differ by SIZE_GAP at most."""
    return np.minimum(np.floor(SIZE_CLASSES * np.log2(sizes)), 255).astype(np.uint8)


def shared_blocks(sets: DataFrame, classes: np.ndarray, parts: int) -> DataFrame:
    """(block, set_id, other): the sets of a prefix token are a block, cut where sizes leave a gap over which no sets link; two sets are a pair, without block.

    Tokens of one passage have the same sets.  A block is known by the sum of its mixed set ids, so it comes once, however
    many tokens name it; should two sums be equal, their blocks are one larger block and lose no pair.

    Prefix tokens travel packed, one row per batch and part of the token range; a part holds a share of them that does not
    grow with the input, since the number of parts does.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in fresh_sets(batches):
            heads = [prefix(s, classes) for s in own]
            tokens, counts = np.concatenate(heads), [len(h) for h in heads]
            owners, widths = np.repeat(np.array(ids, np.int64), counts), np.repeat(size_classes(np.array([len(s) for s in own])), counts)
            where = (tokens % np.uint64(parts)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(parts + 1))
            filled = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays([
                pa.array(filled, pa.int64()), pa.array([packed(tokens[order[edges[p]:edges[p + 1]]]) for p in filled], pa.binary()),
                pa.array([owners[order[edges[p]:edges[p + 1]]].tobytes() for p in filled], pa.binary()),
                pa.array([widths[order[edges[p]:edges[p + 1]]].tobytes() for p in filled], pa.binary())], names=["part", "tokens", "owners", "widths"])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], [], []]
        for batch in batches:
            for bodies, column in zip(held, batch.columns[1:]):
                bodies += column.to_pylist()
        if not held[0]:
            return
        tokens, sets_, widths = unpacked(b"".join(held[0])), np.frombuffer(b"".join(held[1]), np.int64), np.frombuffer(b"".join(held[2]), np.uint8)
        del held
        order = np.lexsort((sets_, widths, tokens))
        tokens, sets_, widths = tokens[order], sets_[order], widths[order].astype(np.int64)
        first = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (sets_[1:] != sets_[:-1])])  # one row per token and set
        tokens, sets_, widths = tokens[first], sets_[first], widths[first]
        starts = np.flatnonzero(np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (widths[1:] - widths[:-1] > SIZE_GAP)]))
        sizes = np.diff(np.concatenate([starts, [len(tokens)]]))
        at = starts[sizes == 2]
        duos = np.unique(np.sort(np.stack([sets_[at], sets_[at + 1]], axis=1), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(duos), pa.int64()), pa.array(np.ascontiguousarray(duos[:, 0])), pa.array(np.ascontiguousarray(duos[:, 1]))], names=["block", "set_id", "other"])
        named = np.add.reduceat(mix(sets_), starts)
        _, once = np.unique(named, return_index=True)
        kept = np.zeros(len(starts), bool)
        kept[once] = True
        kept &= sizes > 2
        many, named = np.flatnonzero(np.repeat(kept, sizes)), np.repeat(named, sizes).view(np.int64)
        for at in range(0, len(many), 100_000):
            cut = many[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(named[cut]), pa.array(sets_[cut]), pa.nulls(len(cut), pa.int64())], names=["block", "set_id", "other"])

    dealt = sets.select("set_id", "tokens").mapInArrow(deal, "part long, tokens binary, owners binary, widths binary")
    return dealt.repartition("part").mapInArrow(share, "block long, set_id long, other long").distinct()


def signature(tokens: np.ndarray) -> bytes:
    """A bitmap with at least one bit per token, its size a power of two."""
    bits = max(LEAST_BITS, 1 << (len(tokens) - 1).bit_length())
    marked = np.zeros(bits, np.uint8)
    marked[(tokens % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(marked, bitorder="little").tobytes()


def folded(body: bytes, words: int) -> np.ndarray:
    """A signature as `words` 64-bit words; a longer one is folded by OR, so a token keeps its bit modulo the width."""
    return np.bitwise_or.reduce(np.frombuffer(body, "<u8").reshape(-1, words), axis=0)


def may_link(common: np.ndarray, excess: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets of `sizes` in sum can link: the overlap is at most the common bits and the tokens that share a bit with others."""
    return (100 + SIMILARITY) * (common + excess) >= SIMILARITY * sizes


class SignatureTree:
    """Sets in a tree whose nodes hold the OR of their bitmaps, the range of their sizes and components, and the largest excess.

    All bitmaps are brought to the width of the smallest, so that a common token always means a common bit.  The excess of a
    set is its size less its marked bits: so many tokens hide behind others.
    """

    def __init__(self, ids: np.ndarray, components: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray):
        order = np.lexsort((sizes, components, np.floor(np.log2(np.maximum(sizes, 1)) * 4)))
        self.ids = ids[order]
        marked = np.bitwise_count(bitmaps[order]).sum(axis=1).astype(np.int64)
        level = {"bits": bitmaps[order], "least": sizes[order], "most": sizes[order], "excess": sizes[order] - marked, "low": components[order], "high": components[order]}
        self.levels = [level]
        while len(level["least"]) > 1:
            at = np.arange(0, len(level["least"]), FANOUT)
            level = {"bits": np.bitwise_or.reduceat(level["bits"], at, axis=0), "least": np.minimum.reduceat(level["least"], at), "most": np.maximum.reduceat(level["most"], at),
                     "excess": np.maximum.reduceat(level["excess"], at), "low": np.minimum.reduceat(level["low"], at), "high": np.maximum.reduceat(level["high"], at)}
            self.levels.append(level)

    def children(self, depth: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node its children one level down, and which node each child belongs to."""
        below = len(self.levels[depth - 1]["least"])
        counts = np.minimum(FANOUT, below - nodes * FANOUT)
        owner = np.repeat(np.arange(len(nodes)), counts)
        return nodes[owner] * FANOUT + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)), owner

    def pairs(self, other: SignatureTree) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs that may link, by walking both trees together from the roots; with itself each pair comes once.

        A node pair is dropped when no size in one fits a size in the other, when all sets below both are of one component, or
        when the common bits of the two ORs and the excess cannot reach the overlap that their smallest sizes would need.
        """
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        deep, wide = len(self.levels) - 1, len(other.levels) - 1
        while True:
            one, two = self.levels[deep], other.levels[wide]
            keep = ((100 * one["most"][a] >= SIMILARITY * two["least"][b]) & (100 * two["most"][b] >= SIMILARITY * one["least"][a])
                    & ~((one["low"][a] == one["high"][a]) & (two["low"][b] == two["high"][b]) & (one["low"][a] == two["low"][b])))
            if self is other:
                keep &= (a <= b) if deep else (a < b)
            a, b = a[keep], b[keep]
            hit = np.zeros(len(a), bool)
            for at in range(0, len(a), 16_384):
                s, t = a[at:at + 16_384], b[at:at + 16_384]
                common = np.bitwise_count(one["bits"][s] & two["bits"][t]).sum(axis=1).astype(np.int64)
                hit[at:at + 16_384] = may_link(common, np.minimum(one["excess"][s], two["excess"][t]), one["least"][s] + two["least"][t])
            a, b = a[hit], b[hit]
            if not deep and not wide or not len(a):
                return self.ids[a], other.ids[b]
            if deep >= wide:
                down, owner = self.children(deep, a)
                a, b, deep = down, b[owner], deep - 1
                if self is other:  # both sides step down together
                    down, owner = other.children(wide, b)
                    a, b, wide = a[owner], down, wide - 1
            else:
                down, owner = other.children(wide, b)
                a, b, wide = a[owner], down, wide - 1


def block_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) that may link among rows (block, left, right, side, set_id, component, n_shingles, signature) of one block and chunk pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            codes = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for start, end in zip(edges, edges[1:]):
                if tuple(codes[start]) != key:
                    if held:
                        yield joined_block(pa.Table.from_batches(held))
                    held, key = [], tuple(codes[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield joined_block(pa.Table.from_batches(held))

    return rows.mapInArrow(lambda batches: once(run(batches)), "a long, b long")


def once(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of a task's blocks, without most that come again: blocks that overlap name the same pairs.  At most HELD_PAIRS and one block's are held."""
    held, count = [], 0
    for batch in found:
        held.append(batch)
        count += batch.num_rows
        if count >= HELD_PAIRS:
            table = pa.Table.from_batches(held).group_by(["a", "b"]).aggregate([])
            held, count = table.to_batches(), table.num_rows
            if 2 * count >= HELD_PAIRS:
                yield from held
                held, count = [], 0
    if held:
        yield from pa.Table.from_batches(held).group_by(["a", "b"]).aggregate([]).to_batches()


def joined_block(block: pa.Table) -> pa.RecordBatch:
    """The pairs of one block: a chunk with itself, or two chunks with each other.

    Sets that link differ in size by a third at most, so their bitmaps are equally wide or one is twice the other; trees
    are grown per width, and the wider ones folded once more to meet the next narrower.
    """
    bodies = block.column("signature").to_pylist()
    widths, sides = np.array([len(b) // 8 for b in bodies]), block.column("side").to_numpy()
    columns = [block.column(c).to_numpy() for c in ("set_id", "component", "n_shingles")]
    alone = block.column("left")[0].as_py() == block.column("right")[0].as_py()

    def tree(own: int, side: int, width: int) -> SignatureTree | None:
        rows = np.flatnonzero((widths == own) & (sides == side))
        return SignatureTree(*(c[rows] for c in columns), np.stack([folded(bodies[r], width) for r in rows])) if len(rows) else None

    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for width in np.unique(widths).tolist():
        same = {side: tree(width, side, width) for side in (0, 1)}
        wide = {side: tree(2 * width, side, width) for side in (0, 1)}
        meet = [(same[0], same[0]), (same[0], wide[0])] if alone else [(same[0], same[1]), (same[0], wide[1]), (wide[0], same[1])]
        found += [one.pairs(two) for one, two in meet if one and two]
    a, b = (np.concatenate(c) for c in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def possible(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures do not rule a link out."""
    one = signatures.select(F.col("set_id").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    two = signatures.select(F.col("set_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    near = pairs.join(one, "a").join(two, "b").where((100 * F.col("na") >= SIMILARITY * F.col("nb")) & (100 * F.col("nb") >= SIMILARITY * F.col("na")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            keep = []
            for m, n, x, y in zip(na.tolist(), nb.tolist(), batch.column(3).to_pylist(), batch.column(5).to_pylist()):
                words = min(len(x), len(y)) // 8
                s, t = folded(x, words), folded(y, words)
                excess = min(m - int(np.bitwise_count(s).sum()), n - int(np.bitwise_count(t).sum()))
                keep.append(bool(may_link(int(np.bitwise_count(s & t).sum()), excess, m + n)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return near.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their exact overlap.

    Only sets that occur in a pair leave the scan: a bitmap of a fixed size, built in Spark, knows them.
    """
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    spot = F.pmod(F.xxhash64("set_id"), F.lit(WANTED_BITS))
    size = 32_768  # bits of one of Spark's bitmaps
    maps = (wanted.select(spot.alias("spot")).groupBy(F.floor(F.col("spot") / size).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("spot") % size).alias("body")).collect())
    bits = np.zeros((WANTED_BITS // size, size // 8), np.uint8)
    for row in maps:
        bits[row["bucket"]] = np.frombuffer(row["body"], np.uint8)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            at = batch.column(2).to_numpy()
            keep = (bits[at // size, at % size // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            for i in np.flatnonzero(keep):
                id = batch.column(0)[i].as_py()
                keep[i] = id not in met
                met.add(id)
            yield batch.select([0, 1]).filter(pa.array(keep))

    # Copies of a set that lie in several tasks are reduced to one before they meet the pairs.
    chosen = (sets.select("set_id", "tokens", spot.alias("spot")).mapInArrow(choose, "set_id long, tokens binary")
              .groupBy("set_id").agg(F.first("tokens").alias("tokens")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = unpacked(x), unpacked(y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= SIMILARITY * (len(s) + len(t) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = chosen.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta"))
    two = chosen.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(set_id, component): the smallest id reachable from every id that has a link."""
    return materialise(star_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("u").alias("set_id"), F.col("root").alias("component")))


def first_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): sets that share a token with each other alone, and each set with the smallest one that has the same smallest block under one of a few hashes."""
    duos = shared.where("other IS NOT NULL").select(F.col("set_id").alias("a"), F.col("other").alias("b"))
    smallest = [F.min(F.xxhash64("block", F.lit(r))).alias(f"key{r}") for r in range(ROUNDS)]
    keys = F.array(*[F.struct(F.lit(r).alias("round"), F.col(f"key{r}").alias("key")) for r in range(ROUNDS)])
    keyed = shared.where("other IS NULL").groupBy("set_id").agg(*smallest).select("set_id", F.inline(keys))
    centres = keyed.groupBy("round", "key").agg(F.min("set_id").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = keyed.join(centres, ["round", "key"]).where("set_id <> centre").select(F.least("set_id", "centre").alias("a"), F.greatest("set_id", "centre").alias("b"))
    return duos.union(pairs).distinct()


def with_components(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(block, set_id, component) of all blocks of three sets or more."""
    placed = shared.where("other IS NULL").join(labels, "set_id", "left")
    return placed.select("block", "set_id", F.coalesce("component", "set_id").alias("component"))


def joining_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """(a, b): each set with one set of the component that most sets of its block are in, for every block, if it is in another one.

    The one is drawn by a hash of block, set and turn, so a set meets many members of a large group without meeting all.
    """
    draw = F.min(F.struct(F.xxhash64("set_id", "block", F.lit(turn)).alias("draw"), F.col("set_id").alias("member")))
    counted = placed.groupBy("block", "component").agg(F.count(F.lit(1)).alias("n"), draw.alias("drawn"))
    largest = counted.groupBy("block").agg(F.max(F.struct("n", "component", "drawn.member")).alias("top")).where("top.n > 1")
    pairs = placed.join(largest, "block").where("component <> top.component")
    return pairs.select(F.least("set_id", "top.member").alias("a"), F.greatest("set_id", "top.member").alias("b")).distinct()


def open_blocks(placed: DataFrame, signatures: DataFrame) -> DataFrame:
    """Rows of `block_pairs`: the sets of every block that stands in several components.

    A large block is cut into chunks that meet in pairs.
    """
    blocks = placed.groupBy("block").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high")
    chunks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = placed.join(blocks.select("block", chunks.alias("chunks")), "block").withColumn("own", F.pmod(F.hash("set_id"), F.col("chunks")))
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sided = met.select("block", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                       F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "set_id", "component")
    return (sided.join(signatures, "set_id").select("block", F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"), "side", "set_id", "component",
                                                    "n_shingles", "signature").repartition("block", "left", "right").sortWithinPartitions("block", "left", "right"))


def near_links(sets: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """(links found, component labels) of all sets.

    Prefix tokens name the blocks of sets that may link.  Blocks of two and star pairs come first; then, while that finds links,
    sets meet members of the largest component of their blocks, which joins large groups of copies without all their pairs.
    What stays in different components meets in signature trees, block by block, and is compared exactly.
    """
    shared = materialise(shared_blocks(sets, token_classes(sets), parts))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in fresh_sets(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in own], pa.int64()), pa.array([signature(s) for s in own], pa.binary())],
                                             names=["set_id", "n_shingles", "signature"])

    signed = sets.select("set_id", "tokens").mapInArrow(sign, "set_id long, n_shingles long, signature binary")
    holders = shared.select("set_id").union(shared.where("other IS NOT NULL").select("other")).distinct()
    signatures = materialise(signed.join(holders, "set_id", "left_semi").groupBy("set_id").agg(F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    pairs = materialise(possible(first_pairs(shared), signatures))
    found = [materialise(verified(pairs, sets))]
    discard(pairs)
    labels, turn = components(found[0]), 0

    def joined(more: DataFrame) -> DataFrame:
        """Labels with more links; what is linked already is known by its label."""
        known = labels.select(F.col("set_id").alias("a"), F.col("component").alias("b"))
        now = components(known.union(more))
        discard(labels)
        return now

    while True:
        pairs = materialise(possible(joining_pairs(with_components(shared, labels), turn), signatures))
        more = materialise(verified(pairs, sets))
        met, linked, turn = pairs.count(), more.count(), turn + 1
        discard(pairs)
        if linked:
            found.append(more)
            labels = joined(more)
        if linked * SETTLED < met or not linked:
            break
    candidates = materialise(block_pairs(open_blocks(with_components(shared, labels), signatures)).distinct())
    discard(shared, signatures)
    last = materialise(verified(candidates, sets))
    discard(candidates)
    return reduce(DataFrame.union, [*found, last]).distinct(), joined(last)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The near-duplicate component of every whole text: columns `keep` (default: the id), n_shingles, component_id, keeper.

    Texts are lower-cased (A-Z) and cut into words `[^\x20\x09-\x0D]+`; a set holds the distinct shingles of five words, or
    the whole sequence of fewer.  Two sets link when their Jaccard similarity is at least 0.75; equal sets link too.
    `component_id` is the smallest id reachable by links, `keeper` marks one row of each component (with that id).

    Tokens are 48-bit hashes and sets are known by 64-bit digests, so results are exact but for hash collisions (about one in
    10^9 pairs compared; beyond 10^9 distinct sets widen the digest).  Links are exact and complete: prefixes, blocks and trees
    only skip pairs that cannot link.

    NULL and empty texts have no shingles and are linked with nothing; NULL ids take part but never name a component; rows that
    repeat an id are rows of their own; an empty table gives an empty one; columns not in `keep` are not read.
    """
    begin(df.sparkSession)
    keep = list(keep or [id])
    if clash := set(keep) & {"n_shingles", "component_id", "keeper"}:
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    slots = [f"c{i}" for i in range(len(keep))]
    named = df.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(keep, slots)], F.col(f"`{id}`").alias("own_id"), F.col(f"`{text}`").alias("whole"))
    found = over_texts(named, [*slots, "own_id"], "whole", "n_shingles long, set_id long, tokens binary", as_sets)
    sets = materialise(found.withColumn("row", F.monotonically_increasing_id()))
    rows = sets.select(*slots, "own_id", "n_shingles", "set_id", "row")
    parts = max(256, -(-sets.count() // 1000))
    _, labels = near_links(sets.select("set_id", "tokens").where("set_id IS NOT NULL"), parts)
    # The first row of each set, then of each component; NULL ids come last.
    first = F.min(F.struct(F.col("own_id").isNull().alias("none"), F.col("own_id"), F.col("row"))).alias("first")
    per_set = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(first)
    linked = per_set.join(labels, "set_id", "left").select("set_id", F.coalesce("component", "set_id").alias("component"), "first")
    named_components = linked.groupBy("component").agg(F.min("first").alias("first"))
    per_set = materialise(linked.drop("first").join(named_components, "component").select("set_id", F.col("first.own_id").alias("component_id"), F.col("first.row").alias("keeper_row")))
    out = lambda frame, component, keeper: frame.select(*[F.col(s).alias(c) for s, c in zip(slots, keep)], "n_shingles", component.alias("component_id"), keeper.alias("keeper"))
    joined = out(rows.where("set_id IS NOT NULL").join(per_set, "set_id"), F.col("component_id"), F.col("row") == F.col("keeper_row"))
    return joined.unionByName(out(rows.where("set_id IS NULL"), F.col("own_id"), F.lit(True)))
