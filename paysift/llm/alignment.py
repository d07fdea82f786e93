"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, and how often their ids meet."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import discard, materialise
from .common import begin, over_texts

# Id pairs looked up in the scan (the most frequent ones; a table of this size at most goes to every task), and steps of a doubling in finding them.
TABLE, STEPS = 1 << 18, 8
# Bytes of text aligned at once and links listed at once; one piece of text, or one group, may be larger.
PIECE_BYTES, LINKS = 1 << 20, 1 << 20
# Before a blank after a character that is no white space neither tokenizer joins bytes.
CUT = re.compile(r"(?<=\S)(?= )")
DIGITS = 7  # of an id


class Side(NamedTuple):
    """A tokenizer: encoder of distinct pieces (each begins with a blank), and bytes, length and decimal digits of every id."""

    encode: object
    bytes: list[bytes]
    length: np.ndarray


def byte_letters() -> dict[str, int]:
    """The byte of every letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [b for low, high in ((33, 126), (161, 172), (174, 255)) for b in range(low, high + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(path: str, pattern: str) -> Side:
    """A byte-level BPE file (json); ids order its merges, so they are the ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {t["content"] for t in described["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
    named = [b""] * (max(described["model"]["vocab"].values()) + 1)
    for token, i in ranks.items():
        named[i] = token
    coder = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Side(lambda pieces: [coder.encode_ordinary(p) for p in pieces], named, np.array([len(b) for b in named], np.int64))


@lru_cache(maxsize=2)
def pieces_model(path: str) -> tuple[Side, bool]:
    """A sentencepiece file; and whether none of its pieces holds a blank after another character, so text may be cut there."""
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
    named = [bytes([int(n[3:5], 16)]) if coder.is_byte(i) else b"" if coder.is_control(i) or coder.is_unknown(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    blank = [names.index("▁")] if "▁" in names else coder.encode(" ")

    def encode(pieces: list[str]) -> list[list[int]]:
        coded = coder.encode([p[1:] for p in pieces], num_threads=1)  # the model adds the first blank itself
        return [c if p != " " else blank for p, c in zip(pieces, coded)]

    return Side(encode, named, np.array([len(b) for b in named], np.int64)), not any(re.search("[^▁]▁", n) for n in names)


class Aligned(NamedTuple):
    """Distinct pieces of text: numbers of tokens, groups and links, `a|b;..` texts, and id pairs with their links by piece."""

    counts: np.ndarray  # columns n_a, n_b, n_groups, n_links; -1 where bytes differ
    texts: list[bytes]
    starts: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for own in lists for i in own), np.int64, int(sizes.sum())), sizes


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): intervals by start, and the group of each; a group breaks where a start reaches the running maximum of ends."""
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = starts[order][1:] >= reached[:-1]
    return order, np.concatenate([[0], np.cumsum(breaks)]) if len(order) else np.zeros(0, np.int64)


def written(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of ids, each followed by its mark, as one byte array; and where each id's bytes end."""
    powers = 10 ** np.arange(DIGITS - 1, -1, -1)
    cells = np.empty((len(ids), DIGITS + 1), np.uint8)
    cells[:, :DIGITS] = ids[:, None] // powers % 10 + 48
    cells[:, DIGITS] = marks
    shown = np.ones(cells.shape, bool)
    shown[:, :DIGITS - 1] = ids[:, None] >= powers[:-1]
    return cells[shown], np.cumsum(shown.sum(1))


def group_links(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_size: np.ndarray, b_size: np.ndarray,
                width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(group, a * width + b) of all links: every A token with every B token of its group, LINKS at a time.

    Tokens come ordered by group.  An A token of a group with more B tokens than that is a slice of its own.
    """
    b_first, per_token = np.cumsum(b_size) - b_size, b_size[a_group]
    made, low = np.cumsum(per_token), 0
    while low < len(a):
        done = made[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(made, done + LINKS, "right")))
        sizes, groups = per_token[low:high], a_group[low:high]
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield np.repeat(groups, sizes), np.repeat(a[low:high], sizes) * width + b[np.repeat(b_first[groups], sizes) + within]
        low = high


def totals(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of weights of each (whole numbers)."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0] if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def align(pieces: list[str], one: Side, two: Side) -> Aligned:
    """Align the tokens of every piece."""
    in_a, in_b = one.encode(pieces), two.encode(pieces)
    bad = [i for i, (p, x, y) in enumerate(zip(pieces, in_a, in_b)) if not b"".join(map(one.bytes.__getitem__, x)) == p.encode() == b"".join(map(two.bytes.__getitem__, y))]
    for i in bad:
        in_a[i], in_b[i] = [], []
    (a, a_sizes), (b, b_sizes) = flat(in_a), flat(in_b)
    a_ends, b_ends = np.cumsum(one.length[a]), np.cumsum(two.length[b])
    side = np.r_[np.zeros(len(a), np.int8), np.ones(len(b), np.int8)]
    order, group = coalesced(np.r_[a_ends - one.length[a], b_ends - two.length[b]], np.r_[a_ends, b_ends], side)
    ids, piece = np.r_[a, b][order], np.r_[np.repeat(np.arange(len(pieces)), a_sizes), np.repeat(np.arange(len(pieces)), b_sizes)][order]
    side = side[order]
    n_groups = int(group[-1]) + 1 if len(group) else 0
    a_size, b_size = np.bincount(group[side == 0], minlength=n_groups), np.bincount(group[side == 1], minlength=n_groups)
    of_group = np.zeros(n_groups, np.int64)
    of_group[group] = piece
    counts = np.stack([a_sizes, b_sizes, np.bincount(of_group, minlength=len(pieces)), np.zeros(len(pieces), np.int64)], axis=1)
    np.add.at(counts[:, 3], of_group, a_size * b_size)
    counts[bad] = -1
    # Texts: tokens by group and side, "," inside a side, "|" between sides, ";" after a group.
    listed = np.lexsort((side, group))
    next_group, next_side = np.r_[group[listed][1:], -1], np.r_[side[listed][1:], 0]
    marks = np.where(next_group != group[listed], ord(";"), np.where(next_side != side[listed], ord("|"), ord(",")))
    letters, at = written(ids[listed], marks)
    ends = np.r_[0, at][np.r_[0, np.cumsum(a_sizes + b_sizes)]]
    body = letters.tobytes()
    texts = [body[x:y - 1] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
    # Id pairs with their links, by piece.
    width, space = len(two.bytes), len(one.bytes) * len(two.bytes)
    keys, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for groups, pairs in group_links(ids[side == 0], ids[side == 1], group[side == 0], group[side == 1], a_size, b_size, width):
        more, times = totals(of_group[groups] * space + pairs, np.ones(len(pairs), np.int64))
        keys, links = totals(np.r_[keys, more], np.r_[links, times]) if len(keys) and len(more) and keys[-1] >= more[0] else (np.r_[keys, more], np.r_[links, times])
    starts = np.searchsorted(keys // space, np.arange(len(pieces) + 1))
    return Aligned(counts, texts, starts, keys % space, links)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, .. of every range, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def aligned_texts(texts: list[str], one: Side, two: Side, cut: bool) -> dict[str, object]:
    """The row of every text, from the alignment of its distinct pieces."""
    split = [(CUT.split(" " + t) if cut else [" " + t]) if t else [] for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    coded = pa.array([p for own in split for p in own], pa.large_string()).dictionary_encode()
    index, found = coded.indices.to_numpy().astype(np.int64), align(coded.dictionary.to_pylist(), one, two)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    whole = np.ones(len(texts), bool)
    whole[text_of[found.counts[index, 0] < 0]] = False
    kept = whole[text_of]
    text_of, index = text_of[kept], index[kept]
    sums = np.zeros((len(texts), 4), np.int64)
    np.add.at(sums, text_of, found.counts[index])
    at = np.cumsum(np.bincount(text_of, minlength=len(texts)))
    digests, low, pieces = [], 0, index.tolist()
    for high in at.tolist():
        digests.append(hashlib.sha256(b";".join(map(found.texts.__getitem__, pieces[low:high]))).hexdigest() if high > low else "")
        low = high
    # Pieces that a text repeats count as often; then their id pairs add up per text.
    uses, times = totals(text_of * max(1, len(found.texts)) + index, np.ones(len(index), np.int64))
    used = uses % max(1, len(found.texts))
    many = found.starts[used + 1] - found.starts[used]
    place = ragged(found.starts[used], many)
    space = len(one.bytes) * len(two.bytes)
    keys, links = totals(np.repeat(uses // max(1, len(found.texts)), many) * space + found.pairs[place], found.links[place] * np.repeat(times, many))
    starts = np.searchsorted(keys // space, np.arange(len(texts) + 1)).astype(np.int32)
    return {"n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3], "groups_sha256": digests,
            "pairs": (starts, keys % space), "links": (starts, links)}


def align_rows(docs: DataFrame, keep: Sequence[str], text: str, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """Columns `keep`, counts, digest, and the distinct id pairs of every text with their links (`pairs`, `links`)."""
    def work(texts: pa.Array) -> dict[str, object]:
        one, (two, cut) = byte_level(path_a, pattern), pieces_model(path_b)
        listed, parts, low, held = texts.to_pylist(), [], 0, 0
        for high, own in enumerate(listed, 1):
            held += len(own)
            if held >= PIECE_BYTES or high == len(listed):
                parts.append(aligned_texts(listed[low:high], one, two, cut))
                low, held = high, 0
        joined = lambda name: pa.concat_arrays([pa.ListArray.from_arrays(pa.array(p[name][0]), pa.array(p[name][1])) for p in parts])
        return {name: joined(name) if name in ("pairs", "links") else np.concatenate([p[name] for p in parts]) if name != "groups_sha256"
                else [d for p in parts for d in p[name]] for name in parts[0]}

    return over_texts(docs, keep, text, "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<long>", work)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): number of texts that hold an id pair, and whether no pair of its A id has a higher one; stored."""
    counted = materialise(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    own = F.floor(F.col("pair") / F.lit(width)).alias("a")
    highest = counted.groupBy(own).agg(F.max("n").alias("most"))  # one row per id of the vocabulary
    told = materialise(counted.withColumn("a", own).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    discard(counted)
    return told


def frequent_floor(counts: DataFrame, table: int) -> int:
    """The lowest count from which on at most `table` pairs have it, on a logarithmic scale of at most 64 * STEPS steps."""
    step = F.floor(F.log2("n") * STEPS)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("low")).orderBy(F.desc("step")).collect()
    held, floor = 0, 1 << 62
    for row in steps:
        held += row["pairs"]
        if held > table:
            break
        floor = row["low"]
    return floor


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, pattern: str, id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None,
                     table: int = TABLE) -> DataFrame:
    """Every row with how tokens of two tokenizers align: `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    `path_a` is a byte-level BPE (json, with the `pattern` of its words), which gets a blank and the text; `path_b` a sentencepiece
    model, which adds that blank.  Intervals of bytes of both are sorted by start and coalesced; a group breaks where a start
    reaches the running maximum of ends.  All A-B pairs of tokens in a group are links; an id pair counts in how many rows it is linked.

    NULL and empty texts, and texts whose joined token bytes differ from the text, have zeros and an empty digest.  Rows that
    repeat an id or a text each count.  An empty table gives an empty result; only `keep` and `text` are read, so other columns
    cannot clash.  Whole texts: a text is cut before blanks where neither tokenizer joins bytes, and each distinct piece of a
    batch is encoded and aligned once, so a very long text needs memory for its pieces; a piece is never cut.

    Counts: the pairs of all rows are stored, counted by Spark, and the `table` most frequent looked up in a second scan; the
    rarer ones are joined.  No key of that join is frequent.
    """
    begin(docs.sparkSession)
    columns = list(keep or [id])
    width = len(pieces_model(path_b)[0].bytes)
    rows = align_rows(docs, columns, text, path_a, path_b, pattern)
    made = [c for c in rows.columns if c not in columns]
    slots = [f"k{i}" for i in range(len(columns))]
    rows = materialise(rows.toDF(*slots, *made).withColumn("row", F.monotonically_increasing_id()))
    counts = pair_counts(rows, width)
    floor = frequent_floor(counts, table)
    known = counts.where(F.col("n") >= floor).toPandas().sort_values("pair")
    keys, seen, best = (known[c].to_numpy() for c in ("pair", "n", "best"))
    seen, best = seen.astype(np.int64), best.astype(bool)

    def looked_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
        return at, keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)

    def lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        pairs, links = batch.column(1), batch.column(2)
        return batch.column(0).to_numpy(), np.diff(pairs.offsets.to_numpy()), pairs.flatten().to_numpy(), links.flatten().to_numpy()

    def add_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sizes, pairs, links = lists(batch)
            at, hit = looked_up(pairs)
            at = at[hit]
            ends = np.r_[0, np.cumsum(sizes)]
            per_row = lambda values: np.diff(np.r_[0, np.cumsum(values)][np.r_[0, np.cumsum(hit)][ends]])
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(per_row(links[hit] * best[at])), pa.array(per_row(links[hit] * seen[at]))], names=["row", "n_best", "count_sum"])

    def leave_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sizes, pairs, links = lists(batch)
            missed = ~looked_up(pairs)[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row, sizes)[missed]), pa.array(pairs[missed]), pa.array(links[missed])], names=["row", "pair", "links"])

    listed = rows.select("row", "pairs", "links")
    sums = listed.mapInArrow(add_known, "row long, n_best long, count_sum long")
    rest = (listed.mapInArrow(leave_rest, "row long, pair long, links long").join(counts.where(F.col("n") < floor), "pair")
            .select("row", F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum")))
    per_row = materialise(sums.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    out = rows.drop("pairs", "links").join(per_row, "row").drop("row")
    return out.select(*[F.col(s).alias(c) for s, c in zip(slots, columns)], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
