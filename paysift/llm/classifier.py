"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with calibrated scores."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialise
from .common import Words, begin, chunk_row, over_texts, sum_chunks, widened

# Words and shapes fall into BUCKETS rows of DIM numbers; an index vector has NONZERO entries of 1 or -1.
BUCKETS, DIM, NONZERO, WINDOW = 1 << 14, 32, 4, 2
CHUNK = 256
# Texts a task turns into vectors at once; each of their words takes some hundred bytes.
SLICE = 400
# At most so many labelled rows fit the network; more do not change it much, and they are held by the driver.
MAX_ROWS = 20_000
FEATURES = 2 * DIM + 3
CORE = re.compile(r"[^\W\d_]+")
SHAPE = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "B" if m[0][0].isupper() else "a"), (re.compile(r"\d+"), lambda m: "0")]


def index_vectors() -> np.ndarray:
    """The index vectors of all buckets, the same on any machine."""
    made = np.zeros((BUCKETS, DIM), np.int8)
    draws = np.random.RandomState(7)
    for row in made:
        row[draws.choice(DIM, NONZERO, replace=False)] = draws.choice((-1, 1), NONZERO)
    return made


def bucket(kind: str, text: str) -> int:
    return zlib.crc32(f"{kind}{text}".encode("utf-8", "replace")) % BUCKETS


def shape(word: str) -> str:
    """Letters as A (capitals), B (a capital first) or a, digits as 0, marks as they are; cut after twelve."""
    for pattern, sign in SHAPE:
        word = pattern.sub(sign, word)
    return word[:12]


def core_and_shape(word: str) -> tuple[str, str]:
    """The letters of a word in lower case, and its shape; plain words with at most one mark behind need no patterns."""
    bare, mark = (word, "") if word.isalpha() else (word[:-1], word[-1:])
    if bare.isalpha() and mark in ("", ".", ",", ";", ":", "!", "?", "|"):
        return bare.lower(), SHAPE[0][1]([bare]) + mark
    return "".join(CORE.findall(word)).lower(), shape(word)


class Occurrences:
    """For every word of a batch the buckets of its letters in lower case and of its shape.

    A word inside a window of four that stood earlier in the same text has shapes of its own.
    """

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        names = [core_and_shape(w) for w in words.names.to_pylist()]
        cores = np.array([zlib.crc32(b"w" + core.encode("utf-8", "replace")) for core, _ in names], np.int64) % BUCKETS
        known = {s: (bucket("s", s), bucket("r", s)) for s in {s for _, s in names}}
        fresh = np.array([known[s][0] for _, s in names], np.int64)
        again = np.array([known[s][1] for _, s in names], np.int64)
        starts, equal = words.windows(4)
        seen = np.zeros(len(words.ids) + 1, np.int64)
        if len(starts):
            order = np.lexsort((starts, equal, words.doc[starts]))
            later = order[1:][(np.diff(equal[order]) == 0) & (np.diff(words.doc[starts][order]) == 0)]
            np.add.at(seen, starts[later], 1)
            np.add.at(seen, starts[later] + 4, -1)
        self.again = np.cumsum(seen[:-1]) > 0
        self.core = cores[words.ids] if len(names) else np.zeros(0, np.int64)
        self.shape = np.where(self.again, again[words.ids], fresh[words.ids]) if len(names) else np.zeros(0, np.int64)
        self.doc, self.counts = words.doc, words.counts

    def contexts(self, index: np.ndarray) -> np.ndarray:
        """Per occurrence the sum of the index vectors of itself and of the words at most WINDOW away in its text."""
        own = index[self.core] + index[self.shape]
        total = own.copy()
        for step in range(1, WINDOW + 1):
            near = (self.doc[step:] == self.doc[:-step])[:, None]
            total[step:] += own[:-step] * near
            total[:-step] += own[step:] * near
        return total


def accumulate(texts: pa.Array, index: np.ndarray, sums: np.ndarray) -> None:
    """Add a batch's contexts to the vectors of its buckets; the last column counts occurrences."""
    for at in range(0, len(texts), SLICE):
        seen = Occurrences(texts.slice(at, SLICE))
        if not len(seen.core):
            continue
        total = seen.contexts(index)
        for column in range(DIM):
            both = np.bincount(seen.core, weights=total[:, column], minlength=BUCKETS) + np.bincount(seen.shape, weights=total[:, column], minlength=BUCKETS)
            sums[:, column] += both.astype(np.int64)
        sums[:, DIM] += np.bincount(seen.core, minlength=BUCKETS) + np.bincount(seen.shape, minlength=BUCKETS)


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Random-indexing vectors of all buckets from all texts: BUCKETS x (DIM + 1) whole numbers, the last a count.

    Each task adds up its own texts and sends what it touched in chunks; chunks are added in two steps, so the first one is
    spread over many tasks however long the input.  The result has a fixed size.
    """
    begin(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_vectors(), np.zeros((BUCKETS, DIM + 1), np.int64)
        for batch in batches:
            accumulate(batch.column(0).cast(pa.string()), index, sums)
        chunks = sums.reshape(BUCKETS // CHUNK, -1)
        part = int(np.abs(sums).sum() % 16)  # any even spread will do
        for chunk in np.flatnonzero(np.abs(chunks).sum(axis=1)):
            yield chunk_row(chunk, part, chunks[chunk])

    parts = df.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t")).mapInArrow(run, "chunk long, part long, body binary")
    whole = np.zeros((BUCKETS // CHUNK, CHUNK * (DIM + 1)), np.int64)
    for row in sum_chunks(parts, CHUNK * (DIM + 1)).collect():
        whole[row["chunk"]] = widened(row["body"], CHUNK * (DIM + 1))
    return whole.reshape(BUCKETS, DIM + 1)


def weighted(sums: np.ndarray) -> np.ndarray:
    """Unit word vectors, frequent words weighing less."""
    vectors = sums[:, :DIM].astype(float)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = sums[:, DIM] / max(1, sums[:, DIM].sum())
    return (vectors * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Means of the word vectors of letters and of shapes, the share of repeated words, and the length."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for at in range(0, len(texts), SLICE):
        seen, rows = Occurrences(texts.slice(at, SLICE)), out[at:at + SLICE]
        if len(seen.core):
            some = np.flatnonzero(seen.counts)
            first = np.concatenate([[0], np.cumsum(seen.counts)[:-1]])[some]
            rows[some, :DIM] = np.add.reduceat(vectors[seen.core], first, axis=0)
            rows[some, DIM:2 * DIM] = np.add.reduceat(units[seen.shape], first, axis=0)
            rows[some, 2 * DIM] = np.add.reduceat(seen.again.astype(np.float32), first)
            rows /= np.maximum(seen.counts, 1)[:, None]
        rows[:, 2 * DIM + 1] = np.log1p(seen.counts) / 10
        rows[:, 2 * DIM + 2] = seen.counts == 0
    return out


@dataclass
class Network:
    """A two-layer network over standardised inputs; scores are divided by a temperature fitted on rows it was not trained on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30))), 9)  # the same whatever the batch


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4) -> Network:
    """Adam on the cross-entropy of four fifths of the rows; the rest sets the temperature.  One class alone gives a constant score."""
    share = (y.sum() + 1) / (len(y) + 2)
    draws = np.random.RandomState(11)
    width = x.shape[1]
    if not 0 < y.sum() < len(y):
        return Network(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))])])
    order = draws.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5:]
    net = Network(x[used].mean(axis=0), x[used].std(axis=0) + 1e-3,
                  [draws.normal(0, width ** -0.5, (width, hidden)), np.zeros(hidden), draws.normal(0, hidden ** -0.5, hidden), np.zeros(1)])
    z, target = (x[used] - net.mean) / net.scale, y[used].astype(float)
    first, second, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    for _ in range(epochs):
        mixed = draws.permutation(len(used))
        for at in range(0, len(used), 128):
            rows = mixed[at:at + 128]
            w1, b1, w2, b2 = net.weights
            layer = np.tanh(z[rows] @ w1 + b1)
            error = (1 / (1 + np.exp(-(layer @ w2 + b2[0]))) - target[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - layer ** 2)
            slopes = [z[rows].T @ back + decay * w1, back.sum(axis=0), layer.T @ error + decay * w2, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope ** 2
                net.weights[i] = net.weights[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    if len(held):
        logits, good, bad = net.logits(x[held]), y[held].sum(), (1 - y[held]).sum()
        seen = np.where(y[held] == 1, (good + 1) / (good + 2), 1 / (bad + 2))  # no row is quite sure
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, logits / t).mean() - (seen * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def remainder(id: str) -> F.Column:
    """crc32 of the id as text, modulo 3; NULL for a NULL id."""
    return F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 3


def score_quality(df: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", id: str = "doc_id",
                  label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """A calibrated score that each whole text is of good quality (label 1), learned from labelled rows that are not held out.

    Word vectors come from all texts.  Rows whose crc32(id) modulo 3 is 1 are held out of training and calibration; of the
    others at most `max_rows`, in hash order, fit the network.  Several labels of one id count as their majority (a tie: 1).
    Returns columns `keep`, held_out, score, predicted.

    NULL and empty texts get the score of a text without words; a NULL id is never labelled nor held out; NULL labels are
    ignored; without labels every score is 0.5; equal texts get equal scores; an empty table gives an empty one; columns
    not named are not read.
    """
    if clash := set(keep) & {"held_out", "score", "predicted"}:
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    sums = word_vectors(df, text)
    vectors, units = weighted(sums), sums[:, :DIM] / np.maximum(np.linalg.norm(sums[:, :DIM].astype(float), axis=1, keepdims=True), 1e-9)
    units = units.astype(np.float32)

    def pool(texts: pa.Array) -> dict[str, object]:
        return {"vector": pa.array(list(pooled(texts, vectors, units)), pa.list_(pa.float32()))}

    slots = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(keep, slots)], F.col(f"`{id}`").alias("own_id"), F.col(f"`{text}`").alias("whole"))
    stored = materialise(over_texts(rows, [*slots, "own_id"], "whole", "vector array<float>", pool))
    known = (labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id}`").isNotNull()).groupBy(F.col(f"`{id}`").alias("label_id"))
             .agg((F.avg(F.col(f"`{label}`").cast("double")) >= 0.5).cast("int").alias("y")))
    fit = (stored.select("own_id", "vector").join(known, F.col("own_id") == F.col("label_id")).where(remainder("label_id") != 1)
           .select("y", "vector", F.xxhash64("label_id", "vector").alias("order")).orderBy("order").limit(max_rows).toPandas())
    net = train(np.stack(fit["vector"]).astype(float) if len(fit) else np.zeros((0, FEATURES)), fit["y"].to_numpy(dtype=int) if len(fit) else np.zeros(0, int))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, FEATURES)
            scores = net.scores(flat.astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=[*slots, "held_out", "score", "predicted"])

    types = ", ".join([*(f"{s} {df.schema[c].dataType.simpleString()}" for c, s in zip(keep, slots)), "held_out boolean", "score double, predicted int"])
    return (stored.select(*slots, F.coalesce(remainder("own_id") == 1, F.lit(False)).alias("held_out"), "vector")
            .mapInArrow(judge, types).toDF(*keep, "held_out", "score", "predicted"))
