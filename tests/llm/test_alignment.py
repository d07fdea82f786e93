"""Cross-tokenizer alignment against plain Python and the tokenizers' own libraries on whole texts."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from paysift.llm import alignment as al

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def texts():
    rng = random.Random(2)
    alphabet = ["a", "b", "The", "é", "ß", "ñandú", "木", "日本語", " ", "  ", "   ", "\n", "\n\n", " \n ", "\t", " ", "　", "\x1c", "\x00", ".", "'s", "#!", "123", "😀", "é", "<s>", "<|endoftext|>", "<0x41>"]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(150)]
    prose = ["Die schöne Straße ist lang.", "antidisestablishmentarianism unbelievably", "a  b   c ", " lead", "trail ", " ", "  ", "\n", "x▁y", "▁", "a ▁ b", "word " * 300]
    return made + prose + prose[:2] + [None, "", "é" * 5000, "x" * 20000, " " * 3000 + "end"]


def plain(rows):
    """The columns of every row, groups found by common ends of both token sequences."""
    one, two = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    one.encode_special_tokens = True
    letters = al.byte_letters()
    spelled = {i: bytes(letters[c] for c in t) for t, i in one.get_vocab().items() if all(c in letters for c in t)}
    piece = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    parts, held = [], Counter()
    for text in rows:
        whole = (" " + (text or "")).encode()
        a, b = one.encode(" " + (text or ""), add_special_tokens=False).ids, two.encode(text or "")
        if not text or b"".join(spelled[i] for i in a) != whole or b"".join(map(piece, b)) != whole:
            parts.append(None)
            continue
        ends = [list(accumulate(map(len, spelt))) for spelt in ([spelled[i] for i in a], [piece(i) for i in b])]
        common, groups, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for end in common:
            k, m = i, j
            while k < len(a) and ends[0][k] <= end:
                k += 1
            while m < len(b) and ends[1][m] <= end:
                m += 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        held.update(links.keys())
        parts.append((len(a), len(b), groups, links))
    highest = Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for part in parts:
        if part is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = part
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == highest[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("table,links", [(1 << 18, 1 << 21), (40, 16), (0, 16)])
def test_rows_match_whole_text_encodings(spark, monkeypatch, table, links):
    monkeypatch.setattr(al, "LINKS", links)
    rows = texts()
    df = spark.createDataFrame([(i * 2, t, 5, "noise") for i, t in enumerate(rows)], "doc_id long, text string, pairs int, row string").repartition(4)
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in al.align_tokenizers(df, *PATHS, table=table).collect()}
    want = plain(rows)
    assert sum(w[0] > 0 for w in want) > 120 and sum(w[0] == 0 for w in want) > 3
    for i, row in enumerate(want):
        assert got[i * 2] == row, (rows[i] or "")[:80]


def test_groups_break_where_a_start_reaches_the_running_maximum():
    import numpy as np

    starts, ends, side = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 6, 2, 5, 6]), np.array([0, 0, 0, 1, 1, 1])
    order, group = al.coalesced(starts, ends, side)
    assert sorted(zip(order.tolist(), group.tolist())) == [(0, 0), (1, 0), (2, 1), (3, 0), (4, 0), (5, 1)]


def test_odd_tables(spark):
    assert al.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), *PATHS).count() == 0
    df = spark.createDataFrame([(None, "same text"), (1, "same text"), (1, "same text"), (2, None)], "doc_id long, text string")
    got = [tuple(r) for r in al.align_tokenizers(df, *PATHS).collect()]
    assert len(got) == 4 and all(r[6] == 3 * r[4] for r in got) and sum(r[1] == 0 for r in got) == 1
