"""SimHash fingerprints and their links against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paysift.llm import simhash as sh

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Smallest position reachable from every position."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def texts():
    rng = random.Random(3)
    vocabulary = [rng.choice(["a", "be", "Tree", "ÉTÉ", "ünder", "x1", "zz", "木"]) + str(i % 40) for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randrange(3, 60))) for _ in range(40)]
    near = []
    for text in base[:20]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        near.append("\t\n ".join(words).upper())
    odd = [None, "", "   ", "one", "One", "two words", "\u00a0", "x" * 5000, "a b\x0bc\x1cd", " lead and trail "]
    return base + near + base[:10] + odd


def test_fingerprints_and_components_match_plain_python(spark):
    rows = [(i * 3 + 1, t, "noise", 9) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, fp int").repartition(3)
    got = {r["doc_id"]: r for r in sh.simhash_duplicates(df).collect()}
    fps = [plain_fingerprint(r[1]) for r in rows]
    labels = plain_components(fps)
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        assert got[row[0]]["fingerprint"] == f"{fps[i]:016x}"
        assert got[row[0]]["component_id"] == rows[labels[i]][0]


def test_slices_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    whole = sh.fingerprint(text)
    monkeypatch.setattr(sh, "SLICE", 7)
    assert sh.fingerprint(text) == whole == plain_fingerprint(text)


def test_every_pair_of_linked_fingerprints_shares_a_list_at_every_level():
    rng, parts = random.Random(1), sh.index_lists()
    while True:
        for _ in range(300):
            differing = set(rng.sample(range(8), 3))
            assert any(not differing & set(p) for p in parts)
        if len(parts[0]) == sh.MATCHES:
            break
        parts = [finer for p in parts for finer in sh.finer_lists(p)]


@pytest.mark.parametrize("crowded_at", [2048, 8, 40])
def test_links_connect_what_brute_force_connects(spark, crowded_at):
    """Random fingerprints, dense families with equal bytes, and chains of three bits, with lists crowded or not."""
    rng = random.Random(5)
    family = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(150)} | {family ^ rng.getrandbits(14) for _ in range(150)} | {0}
    for start in list(fps)[:30]:
        for _ in range(4):
            start ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            fps.add(start)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(4)
    edges = [(int(np.int64(u).astype(np.uint64)), int(np.int64(v).astype(np.uint64))) for u, v in sh.links(df, crowded_at).collect()]
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for u, v in edges:
        parent[max(root(u), root(v))] = min(root(u), root(v))
    labels = plain_components(fps)
    assert [root(f) for f in fps] == [fps[i] for i in labels]


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = sh.simhash_duplicates(empty)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "q w e r t"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in sh.simhash_duplicates(df).collect()), key=str)
    assert (None, 5) in got and (5, 5) in got and (None, None) in got and len(got) == 4
    with pytest.raises(ValueError):
        sh.simhash_duplicates(df.withColumn("n", F.lit(1)), keep=["doc_id", "n"])
