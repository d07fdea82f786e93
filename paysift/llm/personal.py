"""Personal data: exact patterns for entities, and terms that reveal them by co-occurrence in the corpus."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialise
from .common import Words, begin, over_texts

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# A term is sanitised when it holds at least SHARE of the information of an entity in its text, after SHRINK texts in which
# the entity is as frequent as everywhere were added to those of the term.
SHARE, SHRINK = 0.8, 2.0
# Terms whose documents are counted are known by bits of a table of a fixed size; false ones are dropped by a join.
BITS = 1 << 20
FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, text_key string, entities array<string>, hits array<struct<term:string,start:int,end:int>>"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses.  Each @ is looked at once, so long runs cost no more than their length."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Dotted quads with parts up to 255.  A longer chain gives a quad after each four parts."""
    found = []
    for chain in CHAIN.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            quad = parts[i:i + 4]
            size = sum(map(len, quad)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in quad):
                found.append((at, at + size))
            at += size + 1
    return found


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(doubled)) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15] if "+" in text else []


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; patterns only run where their characters occur."""
    digit = DIGIT.search(text) is not None
    places = (emails(text) if "@" in text else [], addresses(text) if digit else [], cards(text) if digit else [], phones(text) if digit else [])
    return [(kind, start, end) for kind, spans in zip(KINDS, places) for start, end in spans]


def joined(spans: Sequence[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def marks() -> str:
    r"""Combining marks as ranges of a character class; Python's \w leaves them out, but they stand inside words."""
    codes = [c for c in range(0x300, 0x20000) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{chr(x)}-{chr(y)}" for x, y in ranges)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = rf"[^\W\d_](?:[^\W\d_]|[{marks()}])*+"
TERM = re.compile(rf"{LETTERS}(?:['\u2019\u2010\u2011-]{LETTERS})*+")
OWNER = re.compile(r"['\u2019][sS]\Z")


def terms_of(word: str) -> list[tuple[str, int, int]]:
    """(term, start, end) of the terms in a word: two letters or more in lower case, names joined by - or ' whole, outside addresses.

    Of the entities only addresses hold letters and none holds a blank, so these are the terms outside all entities.
    """
    if word.isascii() and word.isalpha():
        return [(word.lower(), 0, len(word))] if len(word) > 1 else []
    taken = emails(word) if "@" in word else []
    found = []
    for left, right in zip([0, *(end for _, end in taken)], [*(start for start, _ in taken), len(word)]):
        for m in TERM.finditer(word, left, right):
            bare = OWNER.sub("", m[0])
            if len(bare) > 1:
                found.append((bare.lower(), m.start(), m.start() + len(bare)))
    return found


def terms_in(text: str) -> list[dict]:
    """Every place of every term of a whole text, outside all entities."""
    known: dict[str, list[tuple[str, int, int]]] = {}
    hits = []
    for m in WORD.finditer(text):
        if (own := known.get(m[0])) is None:
            own = known[m[0]] = terms_of(m[0])
        hits += [{"term": term, "start": m.start() + a, "end": m.start() + b} for term, a, b in own]
    return hits


def entity_of(kind: str, value: str) -> str:
    return kind + ":" + hashlib.sha256(value.lower().encode("utf-8", "replace")).hexdigest()[:24]


def look(texts: pa.Array) -> dict[str, object]:
    """The columns of FOUND for a batch of whole texts."""
    rows = []
    for text in texts.to_pylist():
        spans = base_spans(text)
        count = [sum(kind == k for k, *_ in spans) for kind in KINDS]
        base = joined(spans)
        key = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest() if spans else None
        entities = sorted({entity_of(kind, text[start:end]) for kind, start, end in spans})
        rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), base, key, entities, terms_in(text) if spans else []))
    hit = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 3 + [pa.list_(pa.string()), hit]
    return {name: pa.array(values, kind) for name, values, kind in zip(["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "text_key", "entities", "hits"], zip(*rows), kinds)}


def bit_of(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) % BITS


def bits_of(terms: DataFrame) -> np.ndarray:
    """Which bits the terms have; at most BITS numbers come to the driver."""
    bits = np.zeros(BITS, bool)
    bits[[r[0] for r in terms.select((F.crc32(F.col("term").cast("binary")) % BITS).alias("bit")).distinct().collect()]] = True
    return bits


def term_documents(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(term, n_term): in how many of all documents each of `terms` stands."""
    bits = bits_of(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0).cast(pa.string()))
            known: dict[str, int] = {}
            number = [[known.setdefault(term, len(known)) for term, *_ in terms_of(word) if bits[bit_of(term)]] for word in words.names.to_pylist()]
            if known:
                # Words hold few terms: the first of each word, then the second of those that have one, and so on.
                pairs = []
                for k in range(max(map(len, number))):
                    seen = np.array([own[k] if k < len(own) else -1 for own in number], np.int64)[words.ids]
                    pairs.append(np.unique(words.doc[seen >= 0] * len(known) + seen[seen >= 0]))
                    number = [own if len(own) > k + 1 else [] for own in number]
                counts = np.bincount(np.unique(np.concatenate(pairs)) % len(known), minlength=len(known))
                yield pa.RecordBatch.from_arrays([pa.array(list(known)), pa.array(counts, pa.int64())], names=["term", "n"])

    texts = df.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    return texts.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term")).join(terms, "term", "left_semi")


def disclosing(texts: DataFrame, total: int, df: DataFrame, text: str, near_share: float = SHARE, shrink: float = SHRINK) -> DataFrame:
    """(text_key, term): the terms of each of the different `texts` that reveal an entity of the same text.

    The information of an entity is IC = -log2 p(entity); what a term tells of it is PMI = log2 p(entity | term) / p(entity), with
    p(entity | term) drawn towards p(entity) as if `shrink` more texts of the term were like the whole corpus.  A pair
    discloses when PMI >= near_share * IC.  So a term of few texts can reveal an entity of one text, if the corpus is large
    enough for it to be rare (N texts: a term of at most N ** (1 - near_share) - shrink others), and a frequent one cannot.
    Frequencies are of `total` documents, wherever in a text a term stands; copies of a text that holds an entity count once,
    so they prove nothing.  Entities of the same texts are judged as one group, known by two hashes over these texts.
    """
    distinct = lambda rows: rows.select("text_key", F.explode(F.array_distinct(F.transform("hits", lambda h: h["term"]))).alias("term"), "more")
    terms = materialise(distinct(texts).select("term").distinct())
    twice = distinct(texts.where("more > 0")).groupBy("term").agg(F.sum("more").alias("n_more"))
    counts = term_documents(df, text, terms).join(twice, "term", "left").select("term", (F.col("n_term") - F.coalesce("n_more", F.lit(0))).alias("n_term"))
    held = texts.select("text_key", F.explode("entities").alias("entity"))
    groups = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.bit_xor(F.xxhash64("text_key")).alias("a"), F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("b"))
    in_text = materialise(held.join(groups, "entity").select("text_key", "n_entity", "a", "b").distinct())
    # A term of more documents than this reveals none, not even the most frequent entity if it stood in all its texts.
    most = in_text.agg(F.max("n_entity")).first()[0] or 0
    bound = (total + shrink) * (most / total) ** near_share - shrink if total else 0.0
    rare = materialise(counts.where(F.col("n_term") <= bound * (1 + 1e-9)))
    bits = bits_of(rare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, own = [], []
            for key, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [term for term in dict.fromkeys(terms) if bits[bit_of(term)]]
                keys += [key] * len(rows)
                own += rows
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(own, pa.string())], names=["text_key", "term"])

    seen = texts.select("text_key", F.transform("hits", lambda h: h["term"]).alias("terms")).mapInArrow(run, "text_key string, term string")
    pairs = materialise(seen.join(rare, "term").join(in_text, "text_key"))
    whole = F.lit(float(max(1, total)))
    given = (F.col("n_pair") + shrink * F.col("n_entity") / whole) / (F.col("n_term") + shrink)
    pmi = F.log2(given * whole / F.col("n_entity"))
    good = pairs.groupBy("a", "b", "n_entity", "term", "n_term").agg(F.count(F.lit(1)).alias("n_pair"))
    good = good.where((pmi > 0) & (pmi >= near_share * F.log2(whole / F.col("n_entity")))).select("a", "b", "n_entity", "term")
    return pairs.join(good, ["a", "b", "n_entity", "term"], "left_semi").select("text_key", "term").distinct()


def term_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, more) from (text_key, hits, shown): every place of the terms shown, in order."""
    for batch in batches:
        more = []
        for hits, shown in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            known = set(shown)
            more.append(joined([("term", h["start"], h["end"]) for h in hits if h["term"] in known]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(more, pa.string())], names=["text_key", "more"])


def find_personal(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", near_share: float = SHARE, shrink: float = SHRINK) -> DataFrame:
    """Spans of personal data in every whole text.

    E-mail addresses, IPv4 addresses, payment cards (Luhn) and international phone numbers are found exactly; then terms
    that reveal them by the corpus's own statistics (`disclosing`) are added as spans of kind `term`, only in texts that
    hold the entity, and there at every place.  Returns columns `keep`, n_email, n_ip, n_card, n_phone, base_sha256 and spans
    (all, as kind:start:end in code points, by kind then start).

    NULL and empty texts hold nothing; equal texts get equal spans; an empty table gives an empty one; columns not in `keep`
    are not read but for `text`.
    """
    begin(df.sparkSession)
    own = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    if clash := set(keep) & {*own, "spans"}:
        raise ValueError(f"columns {sorted(clash)} would be there twice")
    slots = [f"c{i}" for i in range(len(keep))]
    source = df.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(keep, slots)], F.col(f"`{text}`").alias("whole"))
    found = materialise(over_texts(source, slots, "whole", FOUND, look))
    holding = found.where(F.col("text_key").isNotNull())
    texts = materialise(holding.groupBy("text_key").agg((F.count(F.lit(1)) - 1).alias("more"), F.first("entities").alias("entities"), F.first("hits").alias("hits")))
    total = found.count() - (texts.agg(F.sum("more")).first()[0] or 0)
    shown = disclosing(texts, total, source, "whole", near_share, shrink).groupBy("text_key").agg(F.collect_list("term").alias("shown"))
    flagged = materialise(texts.select("text_key", "hits").join(shown, "text_key").select("text_key", "hits", "shown").mapInArrow(term_spans, "text_key string, more string"))
    out = [*[F.col(s).alias(c) for c, s in zip(keep, slots)], *own]
    with_terms = holding.join(flagged, "text_key", "left").select(*out, F.concat_ws(",", "base", "more").alias("spans"))
    return with_terms.unionByName(found.where(F.col("text_key").isNull()).select(*out, F.col("base").alias("spans")))


def replaced(text: str, spans: str) -> str:
    """The text with each span generalised to its kind; overlapping spans go as one, under the kind of the longest of them."""
    unions: list[list] = []  # start, end, length and kind of the longest span
    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)):
        if not unions or start >= unions[-1][1]:
            unions.append([start, end, end - start, kind])
            continue
        last = unions[-1]
        last[1] = max(last[1], end)
        if end - start > last[2]:
            last[2:] = end - start, kind
    parts, at = [], 0
    for start, end, _, kind in unions:
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def sanitise(df: DataFrame, text: str = "text", near_share: float = SHARE, shrink: float = SHRINK) -> DataFrame:
    """All rows and columns of `df`, personal data in `text` generalised to [EMAIL], [IP], [CARD], [PHONE] and [TERM].

    NULL stays NULL, texts without findings stay as they are; see `find_personal`.
    """
    slots = {c: f"x{i}" for i, c in enumerate(df.columns)}
    rows = df.toDF(*slots.values())
    whole = slots[text]
    found = find_personal(rows, list(slots.values()), whole, near_share, shrink)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    names = rows.columns
    at = names.index(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            texts = [t if t is None or not s else replaced(t, s) for t, s in zip(columns[at].to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.select(*names, "spans").mapInArrow(run, schema).toDF(*df.columns)
