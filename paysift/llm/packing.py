"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths, each a sequence of its own."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialise
from .common import begin

PIECE = "piece_start long, piece_length long, ids_crc32 long, doc_tokens long"
# Texts of these characters only are split below; NFC leaves them alone and their lower case is one character.
PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# Unicode White_Space; Python's str.split() also cuts at 1C-1F, which the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
# Bytes a memory may take, the dictionary entry of a word in it, and the longest word it keeps.
REMEMBERED, ENTRY, LONG = 256 << 20, 200, 64


def byte_symbols() -> dict[int, str]:
    """The visible character that byte-level BPE uses for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Chunks(dict):
    """Ids (16-bit, as bytes) by chunk of text between white space, made when first met.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks in order.
    Plain chunks are cut into the tokenizer's own parts and each part is given to its model once; other chunks go
    through the whole tokenizer.  Bounded: a memory is emptied when it has taken `REMEMBERED` bytes, and chunks and parts
    above `LONG` characters are not kept, so texts without white space do not fill it.  Vocabularies above 65,536 ids are
    refused, since ids are kept in 16 bits.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.codes = [i.to_bytes(2, "little") for i in range(1 << 16)]
        self.parts: dict[str, bytes] = {}
        self.taken = self.parts_taken = 0
        self.symbols = byte_symbols()

    def part(self, part: str) -> bytes:
        named = part if part.isascii() else part.encode().decode("latin-1").translate(self.symbols)
        codes = self.codes
        ids = b"".join([codes[t.id] for t in self.tokenizer.model.tokenize(named)])
        if len(part) <= LONG:
            self.parts_taken += ENTRY + len(ids)
            if self.parts_taken > REMEMBERED:
                self.parts.clear()
                self.parts_taken = ENTRY + len(ids)
            self.parts[part] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk):
            known = self.parts.get
            ids = b"".join([known(p) or self.part(p) for p in PARTS.findall(chunk.lower())])
        else:
            codes = self.codes
            ids = b"".join([codes[i] for i in self.tokenizer.encode(chunk, add_special_tokens=False).ids])
        if len(chunk) <= LONG:
            self.taken += ENTRY + len(ids)
            if self.taken > REMEMBERED:
                self.clear()
                self.taken = ENTRY + len(ids)
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        chunks = SPACE.split(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, filter(None, chunks)))


_CHUNKS: dict[str, Chunks] = {}


def chunks_of(path: str) -> Chunks:
    """One memory per worker process and vocabulary file."""
    if path not in _CHUNKS:
        _CHUNKS[path] = Chunks(path)
    return _CHUNKS[path]


def binary_lengths(total: int, longest: int) -> list[int]:
    """Full sequences of `longest`, then the powers of two of the rest, falling."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(df: DataFrame, keep: Sequence[str], text: str, path: str, longest: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece: columns `keep`, the piece's place and length, a checksum of its ids and, if asked, the ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    begin(df.sparkSession)
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    schema = ", ".join([*(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)), PIECE, *(["ids array<int>"] if with_ids else [])])
    ending = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(path)
        for batch in batches:
            row, places, lengths, sums, totals, ids = [], [], [], [], [], []
            for i, whole in enumerate(batch.column(len(keep)).to_pylist()):
                own = np.frombuffer(chunks.ids(whole) + ending, "<u2").astype("<u4")
                start = 0
                for length in binary_lengths(len(own), longest):
                    row.append(i)
                    places.append(start)
                    lengths.append(length)
                    totals.append(len(own))
                    sums.append(zlib.crc32(own[start:start + length]))
                    if with_ids:
                        ids.append(own[start:start + length].astype(np.int32))
                    start += length
            made = [pa.array(x, pa.int64()) for x in (places, lengths, sums, totals)] + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])
            pieces = batch.select(list(range(len(keep)))).take(pa.array(row, pa.int64())).columns if keep else []
            names = [*(f"k{i}" for i in range(len(keep))), "piece_start", "piece_length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
            yield pa.RecordBatch.from_arrays([*pieces, *made], names=names)

    return rows.mapInArrow(run, schema)


def pack(df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text", longest: int = 2048, end_id: int = 1,
         with_ids: bool = False) -> DataFrame:
    """Sequences of binary lengths, one piece each: no padding, and none crosses documents.

    A document's ids are those of the tokenizer file at `path` without special tokens, then `end_id`.  It is cut into full
    sequences of `longest` and the powers of two of the rest.  Returns columns `keep`, start, length, ids_crc32, doc_tokens,
    sequence_id (unique), offset (0) and, if asked, ids.  `bucketed` groups equal lengths for training.

    The pieces are stored before they get numbers, so a retried task cannot number a sequence twice.  NULL and empty texts
    give one piece with `end_id` alone; repeated rows give sequences of their own; an empty table gives none.
    """
    cuts = materialise(cut(df, keep, text, path, longest, end_id, with_ids))
    named = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return cuts.select(*named, F.col("piece_start").alias("start"), F.col("piece_length").alias("length"), "ids_crc32", "doc_tokens",
                       F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))


def bucketed(pieces: DataFrame, folder: str) -> None:
    """Write sequences by length, one folder per power of two, so a batch holds sequences of one length."""
    pieces.write.partitionBy("length").parquet(folder)
