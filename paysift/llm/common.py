"""Small helpers shared by the operators: bounded Arrow batches and words of whole texts as integers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import prepare, shared_dir

# Rows and bytes a task holds at once; whole texts, so a batch of very long ones is cut by bytes.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20


def begin(spark: SparkSession) -> SparkSession:
    """Pin the settings results and memory depend on; name the shared checkpoint folder."""
    prepare(spark)
    shared_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def over_texts(df: DataFrame, keep: Sequence[str], text: str, schema: str,
               work: Callable[[pa.Array], dict[str, object]]) -> DataFrame:
    """Columns `keep` of every row and what `work` computes from a batch of whole texts (NULL counts as empty).

    `work` gets a string array and returns one array or list per column of `schema`.  Columns of
    `df` other than `keep` are not read, so names cannot clash.
    """
    begin(df.sparkSession)
    own = StructType.fromDDL(schema).names
    if clash := set(own) & set(keep):
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = df.select(*kept, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    types = ", ".join([*(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = work(batch.column(len(keep)).cast(pa.string()))
            arrays = [*batch.columns[: len(keep)], *(pa.array(made[c]) if not isinstance(made[c], pa.Array) else made[c] for c in own)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(f"k{i}" for i in range(len(keep))), *own])

    return rows.mapInArrow(run, types).toDF(*keep, *own)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a batch of texts.

    ids: an integer per word, equal for equal words of the batch; names: the distinct words;
    doc: the text each word stands in; starts: the first word of each text, and the number of words.
    """

    def __init__(self, texts: pa.Array):
        parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
        real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # a text without words has one empty part
        self.ids, self.doc, self.names = ids[real], doc[real], coded.dictionary
        self.texts = len(texts)
        self.counts = np.bincount(self.doc, minlength=self.texts).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of `width` words (a power of two) inside one text, and a number per window, equal for equal ones.

        Exact: two windows are equal when both their halves are, so widths double without hashing.
        """
        ids, size, distinct = self.ids, 1, len(self.names)
        while size < width:
            count = max(0, len(ids) - size)
            _, ids = np.unique(ids[:count] * np.int64(distinct) + ids[size:size + count], return_inverse=True)
            distinct, size = len(ids) + 1, size * 2
        at = np.arange(len(ids))
        inside = self.doc[at] == self.doc[at + width - 1]
        return at[inside], ids[inside]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same on any machine."""
        import pandas as pd

        named = pd.util.hash_array(np.asarray(self.names.to_pylist(), dtype=object), categorize=False) if len(self.names) else np.zeros(0, np.uint64)
        return named[self.ids]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a bijection)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, in as few bytes each as the largest needs."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(f"<i{next(n for n in (1, 2, 4, 8) if most < 1 << 8 * n - 1)}").tobytes()


def widened(body: bytes, cells: int) -> np.ndarray:
    return np.frombuffer(body, f"<i{len(body) // cells}").astype(np.int64) if cells else np.zeros(0, np.int64)


def sum_chunks(df: DataFrame, cells: int) -> DataFrame:
    """Add up rows (chunk, part, body) per chunk, each body holding `cells` whole numbers from `narrow`.

    First per chunk and part, so that many tasks share the work, then per chunk.  Rows stream through a task, which holds one
    sum per key.
    """
    def adder(by_part: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, np.ndarray] = {}
            for batch in batches:
                for chunk, part, body in zip(*(c.to_pylist() for c in batch.columns)):
                    key = (chunk, part if by_part else 0)
                    held[key] = held.get(key, 0) + widened(body, cells)
            for (chunk, part), values in held.items():
                yield chunk_row(chunk, part, values)
        return run

    schema = "chunk long, part long, body binary"
    first = df.repartition("chunk", "part").mapInArrow(adder(True), schema)
    return first.repartition("chunk").mapInArrow(adder(False), schema)


def chunk_row(chunk: int, part: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([part], pa.int64()), pa.array([narrow(values)], pa.binary())], names=["chunk", "part", "body"])
