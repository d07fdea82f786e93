"""The prefix trie of conversations against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from paysift.llm import prefixtrie as pt

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_trie(rows, period=20, most=3):
    """Rows of the trie by listing every prefix of every rebuilt conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % (most + 1), c - c % period
        rebuilt = own if c == base else turns.get(base, [])[:h] + own[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].add(c)
        ends[tuple(rebuilt)].add(c)
    out = []
    for node, held in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(children),
                    sum(1 for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)),
                    sum((len(members[x]) - 1) * words(x) for x in below), hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


def spread(seed, n=70):
    """Conversations over few words, so that many share prefixes; NULLs, empty texts, gaps in the ids, copies and a hot one."""
    rng, rows = random.Random(seed), []
    for c in [*range(0, n), 105, 999, 1000, 1007]:
        if c in (40, 41, 42):
            continue
        for turn in range(rng.randrange(1, 8)):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "bot", None]), rng.choice(["hi", "a b  c", "", None, "x\ty"])))
    rows += [(c, t, "user", f"same {t} words") for c in (60, 200, 220, 240, 260, 280, 300, 320, 340) for t in range(12)]
    rows += [(500, t, "user", f"long {t}") for t in range(60)] + [(None, 1, "user", "lost")]
    seen, kept = set(), []
    for row in rows:  # ties of a turn have no order of their own in plain Python
        if row[:2] not in seen:
            seen.add(row[:2])
            kept.append(row)
    rng.shuffle(kept)
    return kept


@pytest.mark.parametrize("held,chunk", [(400_000, 4096), (9, 2)])
def test_nodes_match_plain_python(spark, monkeypatch, held, chunk):
    monkeypatch.setattr(pt, "HELD", held)
    monkeypatch.setattr(pt, "CHUNK", chunk)
    rows = spread(1)
    df = spark.createDataFrame([(*r, "noise", 1) for r in rows], "conv_id long, turn long, role string, text string, h1 string, depth int").repartition(5)
    got = sorted((tuple(r) for r in pt.conversation_trie(df).collect()), key=str)
    assert got == plain_trie(rows)


def test_locate_finds_where_every_path_leaves():
    rng = random.Random(4)
    paths = [pt.digests([(rng.choice([b"a", b"b"]), 1) for _ in range(rng.randrange(0, 40))]) for _ in range(300)]
    paths += [pt.digests([(b"a", 1)] * k) for k in range(70)]
    rng.shuffle(paths)
    trie, seen = pt.ZFastTrie(), set()
    for i, (path, words) in enumerate(paths):
        shared = max((d for d in range(len(path)) if path[d] in seen), default=0)
        node, leaves = trie.locate(path)
        assert node.high <= shared and node.path[node.high] == path[node.high]
        if leaves is not None:
            assert node.high <= leaves.low < shared <= leaves.high
        else:
            assert shared == node.high
        trie.insert(i, path, words)
        seen.update(path)
    assert {row[0] for row in trie.expanded() if row[2] is not None} == seen | {pt.ROOT}


def test_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert pt.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    one = [tuple(r) for r in pt.conversation_trie(spark.createDataFrame([(7, None, None, None)], schema)).collect()]
    assert one == plain_trie([(7, None, None, None)])  # base absent, so no turn is left
    repeated = spark.createDataFrame([(20, 0, "u", "x y"), (20, 0, "u", "x y"), (40, 0, "u", "x y")], schema)
    got = sorted(tuple(r)[:7] for r in pt.conversation_trie(repeated).collect())
    assert got == [(20, 0, None, 2, 1, 1, 2), (20, 1, 20, 2, 1, 1, 2), (20, 2, 20, 1, 0, 1, 0)]
    long = spark.createDataFrame([(20, 0, "u", "word " * 200_000), (40, 0, "u", "word " * 200_000)], schema)
    assert pt.conversation_trie(long).where("depth = 1").first()["saved_tokens"] == 200_000
