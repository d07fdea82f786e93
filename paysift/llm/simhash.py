"""SimHash near-duplicates: fingerprints of whole texts, linked through an inverted index of byte positions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.splits import star_components
from ..scale import discard, materialise, split_join
from .common import over_texts

SHINGLE, SEED, BITS = 3, 42, 64
# Fingerprints link at so many differing bits; each lies in one byte, so at least MATCHES of the BYTES positions agree.
DISTANCE, BYTES = 3, 8
MATCHES = BYTES - DISTANCE
# Shingles hashed at once, postings of a list that meet in one task, pairs compared at once.
SLICE, CROWDED, PAIRS = 1 << 16, 2048, 1 << 21


def fingerprint(text: str) -> int:
    """Bit by bit the majority of the XXH64 hashes of a text's shingles; zero without words.

    Shingles are slices of the words joined by spaces, hashed SLICE at a time, so a very long text needs little more
    memory than its words.
    """
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array([text]))).values
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    if not sizes.sum():
        return 0
    joined = " ".join(words.to_pylist()).encode()
    ends = np.cumsum(sizes + 1) - 1
    starts, width = ends - sizes, min(SHINGLE, len(sizes))
    count, set_bits, digest = len(sizes) - width + 1, np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for low in range(0, count, SLICE):
        high = min(low + SLICE, count)
        spans = zip(starts[low:high].tolist(), ends[low + width - 1:high + width - 1].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, high - low)
        set_bits += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, BYTES), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > count).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """Columns `keep` and the fingerprint `fp` of every row's whole text, as a signed long."""
    def work(texts: pa.Array) -> dict[str, object]:
        lowered = pc.ascii_lower(texts)
        return {"fp": np.fromiter((fingerprint(t.as_py()) for t in lowered), np.uint64, len(lowered)).view(np.int64)}

    return over_texts(docs, keep, text, "fp long", work)


def byte_at(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (BYTES - 1 - position)).bitwiseAND(F.lit(255))


def index_lists() -> list[tuple[int, ...]]:
    """Byte positions that name the first lists: the threes of either half.

    MATCHES = 5 agreeing positions lie with at least three in one half, so linked fingerprints share a list.
    """
    half = BYTES // 2
    return [part for low in (0, half) for part in combinations(range(low, low + half), MATCHES - half + 2)]


def postings(fps: DataFrame, positions: list[tuple[int, ...]]) -> DataFrame:
    """(list, key, fp): for every fingerprint its bytes at the positions of each list."""
    packed = lambda part: sum((F.shiftleft(byte_at(F.col("fp"), p), 8 * i) for i, p in enumerate(part)), F.lit(0).cast("long"))
    named = F.array(*[F.struct(F.lit(i).alias("list"), packed(part).alias("key")) for i, part in enumerate(positions)])
    return fps.select("fp", F.explode(named).alias("p")).select("p.list", "p.key", "fp")


def finer_lists(part: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Lists by one byte position more that hold every linked pair of a list.

    Of the BYTES - len(part) other positions at most DISTANCE differ, so one of any DISTANCE + 1 of them agrees.
    """
    others = [p for p in range(BYTES) if p not in part]
    return [(*part, p) for p in others[:DISTANCE + 1]]


def tallied(fps: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs (positions into fps) share at least MATCHES positional bytes and then differ in at most DISTANCE bits."""
    differing = fps[left] ^ fps[right]
    shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
    kept = np.nonzero(shared >= MATCHES)[0]
    return kept[np.bitwise_count(differing[kept]) <= DISTANCE]


def forest(fps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the pairs: every fingerprint with the smallest one it reaches."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b, label = at[:len(left)], at[len(left):], np.arange(len(nodes))
    while True:
        lower = label.copy()
        np.minimum.at(lower, a, label[b])
        np.minimum.at(lower, b, label[a])
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return fps[nodes[moved]], fps[nodes[label[moved]]]


def list_pairs(sizes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside lists that follow each other; `first` gives where each list begins."""
    position = np.arange(int(sizes.sum())) - np.repeat(first - first[0], sizes)
    left = np.repeat(np.arange(len(position)), position)
    before = np.arange(len(left)) - np.repeat(np.cumsum(position) - position, position)
    return left + first[0], before + np.repeat(np.repeat(first - first[0], sizes), position) + first[0]


def list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside lists; rows (list, key, block, side, fp) come sorted, a list never holds more than 2 * CROWDED rows.

    Sides 0 and 1 of a block pair meet each other; side 2 meets itself.
    """
    def linked(held: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, fps, side = held[:, :3], held[:, 4].view(np.uint64), held[:, 3]
        new = np.r_[True, (keys[1:] != keys[:-1]).any(1)]
        first = np.nonzero(new)[0]
        sizes = np.diff(np.r_[first, len(fps)])
        pairs = np.cumsum(sizes * (sizes - 1) // 2)
        low = 0
        while low < len(first):
            done = pairs[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(pairs, done + PAIRS, "right")))
            left, right = list_pairs(sizes[low:high], first[low:high])
            across = (side[left] == 2) | (side[left] != side[right])
            left, right = left[across], right[across]
            found = tallied(fps, left, right)
            u, v = forest(fps, left[found], right[found])
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
            low = high

    tail = np.zeros((0, 5), np.int64)
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1) if batch.num_rows else tail[:0]
        held = np.concatenate([tail, rows])
        if not len(held):
            continue
        open_list = (held[:, :3] == held[-1, :3]).all(1)
        yield from linked(held[~open_list]) if (~open_list).any() else ()
        tail = held[open_list]
    if len(tail):
        yield from linked(tail)


def links(fps: DataFrame, crowded_at: int = CROWDED) -> DataFrame:
    """(u, v): links that connect all fingerprints (distinct, column `fp`) at most DISTANCE bits apart.

    The index has a list for the bytes at three positions of a half.  Lists of up to `crowded_at` fingerprints meet in one
    task, which tallies the positional bytes each pair shares and verifies pairs that reach the guaranteed number.  A longer
    list is divided by a further byte position, up to MATCHES bytes; what is still longer meets in pairs of blocks.  A task
    emits a spanning forest of what it finds, never all links of a dense list.
    """
    met, wanted = [], [(index_lists(), fps)]
    while wanted:
        positions, members = wanted.pop()
        posted = materialise(postings(members, positions))
        crowded = materialise(posted.groupBy("list", "key").agg(F.count(F.lit(1)).alias("n")).where(f"n > {crowded_at}"))
        full = sorted(r[0] for r in crowded.select("list").distinct().collect())  # at most as many as there are lists
        rest = posted.join(crowded, ["list", "key"], "left_anti") if full else posted
        met.append(rest.select("list", "key", F.lit(0).alias("block"), F.lit(2).alias("side"), "fp"))
        for i in full:
            inside = posted.where(F.col("list") == i).join(crowded, ["list", "key"])
            if len(positions[i]) < MATCHES:
                wanted.append((finer_lists(positions[i]), materialise(inside.select("fp"))))
            else:
                met.append(block_pairs(inside, crowded_at))
    found = None
    for part in met:
        spread = part.repartition("list", "key", "block").sortWithinPartitions("list", "key", "block").mapInArrow(list_links, "u long, v long")
        found = spread if found is None else found.union(spread)
    return found


def block_pairs(inside: DataFrame, crowded_at: int) -> DataFrame:
    """Members of crowded keys (with their number `n`) in blocks, every block with every block from its own on."""
    blocks = F.ceil(F.col("n") / (crowded_at / 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = inside.withColumns({"blocks": blocks, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return dealt.select("list", "key", (low * F.col("blocks") + high).alias("block"), side.alias("side"), "fp")


def simhash_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None, crowded_at: int = CROWDED) -> DataFrame:
    """Every row with its `fingerprint` (16 hex digits) and `component_id`, the smallest id reachable through fingerprints
    that differ in at most three bits.

    NULL and empty texts have fingerprint zero, which links like any other.  Rows that repeat an id or a text each get their
    row; a NULL id is no component id unless all ids of the component are NULL.  Texts of any length are hashed whole, in
    slices.  Equal fingerprints collapse before the index is built.  An empty table gives an empty result.  Only `id`,
    `text` and `keep` are read, so other columns cannot clash.
    """
    columns = list(keep or [id])
    if id not in columns:
        raise ValueError(f"{id} must be among the kept columns")
    if clash := set(columns) & {"fp", "fingerprint", "component_id", "smallest", "n"}:
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    marked = materialise(fingerprints(docs, columns, text))
    distinct = materialise(marked.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(id).alias("smallest")))
    roots = materialise(star_components(links(distinct.select("fp"), crowded_at)))
    joined = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labelled = materialise(joined)
    least = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = materialise(labelled.join(least, "root").select("fp", "n", "component_id"))
    discard(distinct, roots, labelled)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return split_join(marked, named, "fp", "n").select(*columns, digits.alias("fingerprint"), "component_id")
