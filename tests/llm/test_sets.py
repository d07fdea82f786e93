"""Source mix, near duplicates, top-k, classifier and pipeline against plain versions."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paysift.llm import classifier, mixing, nearjoin, topk

from .cases import documents, nothing, prose, texts

WORD = r"[^\x20\x09-\x0D]+"


# Source mix

def plain_targets(sizes):
    names = sorted([n for n in sizes if n is not None], key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        full = {n for n in free if share[n] >= 3 * sizes[n]}
        if not full:
            return target | share
        target |= {n: 3.0 * sizes[n] for n in full}
        left -= sum(3 * sizes[n] for n in full)
        free -= full
    return target


def test_mix_meets_targets(spark):
    rows = texts() + [(1000 + i, prose(i, 40 + i % 50), "abcd"[i % 4] if i % 3 else None) for i in range(300)]
    mix = mixing.mix_sources(documents(spark, rows), keep=("doc_id", "source")).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(WORD, text or ""))
    target, taken, largest = plain_targets(sizes), defaultdict(int), defaultdict(int)
    for r in mix:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(mix) == len(rows) and all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = mixing.mix_sources(documents(spark, rows).repartition(7), keep=("doc_id", "source")).collect()
    assert sorted(mix, key=repr) == sorted(again, key=repr)
    assert mixing.mix_sources(nothing(spark)).count() == 0
    assert [r["taken"] for r in mixing.mix_sources(documents(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


@pytest.mark.parametrize("few", [64, 2, 0])
def test_sample_equals_sorting_by_key(spark, monkeypatch, few):
    """The digit search takes the same documents as sorting each source by its keys, however deep it goes."""
    monkeypatch.setattr(mixing, "FEW", few)
    df = documents(spark, [(i, prose(i, 30 + i % 20), "ab"[i % 2]) for i in range(400)])
    key = mixing.sampling_key(mixing.letter_share(F.col("text")), F.col("doc_id"), F.col("text"), F.lit(0))
    keyed = {r["doc_id"]: r["key"] for r in df.select("doc_id", key.alias("key")).collect()}
    by_source = defaultdict(list)
    for r in mixing.mix_sources(df, keep=("doc_id", "source")).collect():
        by_source[r["source"]].append(r)
    for rows in by_source.values():
        epochs, upto, expected = int(rows[0]["target"] // rows[0]["source_size"]), 0, set()
        rest = rows[0]["target"] - epochs * rows[0]["source_size"]
        for r in sorted(rows, key=lambda r: keyed[r["doc_id"]]):
            if upto + r["size"] / 2 > rest:
                break
            upto += r["size"]
            expected.add(r["doc_id"])
        assert {r["doc_id"] for r in rows if r["copies"] > epochs} == expected


def test_heavier_documents_come_first(spark):
    df = documents(spark, [(i, ("plain words only here " if i % 2 else "## 12 !! 99 ?? 1 ") * 10, "ab"[i // 500]) for i in range(1000)])
    taken = mixing.mix_sources(df, weights=(1, 1)).join(df.select("doc_id", "text"), "doc_id")
    half = mixing.mix_sources(df, weights=(3, 1)).where("source_size > target and taken > 0")
    assert taken.where("taken > 0").count() == 1000
    good = half.where("doc_id % 2 = 1").count()
    assert good > 2 * (half.count() - good)


# Near duplicates

def plain_components(rows):
    sets = []
    for _, text, _ in rows:
        words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    smallest = {}
    for x, (i, *_), s in zip(label, rows, sets):
        if i is not None:
            smallest[x] = min(i, smallest.get(x, i))
    return [(i, len(s), smallest.get(x)) for x, (i, *_), s in zip(label, rows, sets)]


def edited(text, seed, share):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randint(0, 10 ** 6)}" if draw.random() < share else w for w in text.split())


def near_rows():
    rows = texts()
    for g, (size, share) in enumerate([(40, 0.02), (40, 0.03), (30, 0.04), (60, 0.05)]):
        base = prose(9000 + g, 150)
        rows += [(2000 + 100 * g + i, edited(base, 100 * g + i, share * (i % 4) / 2), "s") for i in range(size)]
    passage = prose(77, 60)  # shared by many, most of none
    rows += [(5000 + i, prose(5000 + i, 40 + 3 * i) + " " + passage, "s") for i in range(50)]
    chain = prose(321, 100).split()
    return rows + [(7000 + i, " ".join(chain[4 * i:] + [f"c{k}" for k in range(4 * i)]), "s") for i in range(12)]


@pytest.mark.parametrize("cut", [None, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, cut):
    if cut:  # tiny blocks, so that chunks meet in pairs
        monkeypatch.setattr(nearjoin, "BLOCK", cut)
        monkeypatch.setattr(nearjoin, "FANOUT", 2)
        monkeypatch.setattr(nearjoin, "SETTLED", 0)
    rows = near_rows()
    df = nearjoin.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df), key=repr) == sorted(plain_components(rows), key=repr)
    kept = [r for r in df if r["keeper"]]
    assert all(r["doc_id"] == r["component_id"] for r in kept) and len({r["component_id"] for r in kept if r["n_shingles"]}) == sum(r["n_shingles"] > 0 for r in kept)
    assert {r["component_id"] for r in df if r["n_shingles"]} == {r["component_id"] for r in kept if r["n_shingles"]}


def test_near_duplicates_of_nothing(spark):
    assert nearjoin.near_duplicates(nothing(spark)).count() == 0
    assert [r["component_id"] for r in nearjoin.near_duplicates(documents(spark, [(3, None, "a")])).collect()] == [3]


def test_a_passage_is_one_block_and_sizes_far_apart_do_not_meet(spark):
    """Sets that share many tokens are named once; sets whose sizes cannot link share no block, whatever tokens they share."""
    passage = np.arange(1, 400, dtype=np.uint64)
    own = lambda k, n: np.arange(10_000 * k, 10_000 * k + n, dtype=np.uint64)
    sets = {k: np.concatenate([passage, own(k, n)]) for k, n in ((1, 40), (2, 50), (3, 60), (4, 2_000))}
    df = spark.createDataFrame([(k, bytearray(nearjoin.packed(s))) for k, s in sets.items()], "set_id long, tokens binary").repartition(2)
    none = np.zeros(nearjoin.COUNTERS, np.uint8)
    rows = nearjoin.shared_blocks(df, none, 8).collect()
    assert sorted(r["set_id"] for r in rows if r["other"] is None) == [1, 2, 3] and len({r["block"] for r in rows if r["other"] is None}) == 1
    assert all(4 not in (r["set_id"], r["other"]) for r in rows) and len(rows) <= 3 + 3


@pytest.mark.parametrize("most", [1 << 18, 50])
def test_pairs_of_overlapping_blocks_come_once(monkeypatch, most):
    monkeypatch.setattr(nearjoin, "HELD_PAIRS", most)
    block = lambda low, high: pa.RecordBatch.from_pydict({"a": list(range(low, high)), "b": list(range(low + 1, high + 1))}, schema=pa.schema({"a": pa.int64(), "b": pa.int64()}))
    found = [r for b in nearjoin.once(iter([block(i, i + 20) for i in [*range(30), 0, 0]] + [block(0, 0)])) for r in zip(*b.to_pydict().values())]
    assert set(found) == {(i, i + 1) for i in range(49)} and len(found) <= (49 if most > 1000 else 400)
    assert not list(nearjoin.once(iter([])))


def test_sizes_that_link_lie_within_the_gap():
    small = np.arange(1, 60_000)
    for large in (small * 100 // nearjoin.SIMILARITY, np.minimum(small + 1, small * 100 // nearjoin.SIMILARITY)):
        apart = nearjoin.size_classes(large).astype(int) - nearjoin.size_classes(small)
        assert apart.min() >= 0 and apart.max() <= nearjoin.SIZE_GAP
    assert nearjoin.size_classes(np.array([10 ** 9]))[0] == 255


def test_frequent_tokens_are_told_from_many_rare_ones():
    """A token of 600 sets stands out from 10,000 rare ones in its counter; rare ones alone do not."""
    counts = np.random.RandomState(1).poisson(10_000, 1 << 16)
    counts[77] = 10_600
    found = nearjoin.classed(counts)
    assert found[77] > 0 and (found > 0).sum() < 20 and nearjoin.classed(np.zeros(8, np.int64)).max() == 0


def test_trees_keep_every_pair_that_links():
    draw = np.random.RandomState(2)
    base = [np.unique(draw.randint(0, 1 << 40, size).astype(np.uint64)) for size in (300, 60, 1500)]
    sets = [np.unique(np.where(draw.rand(len(b)) < 0.06, draw.randint(0, 1 << 40, len(b)).astype(np.uint64), b)) for b in base for _ in range(25)]
    sets += [np.unique(draw.randint(0, 1 << 40, 200).astype(np.uint64)) for _ in range(60)]
    bodies = [nearjoin.signature(s) for s in sets]
    width = min(map(len, bodies)) // 8
    tree = nearjoin.SignatureTree(np.arange(len(sets)), np.arange(len(sets)), np.array([len(s) for s in sets]), np.stack([nearjoin.folded(b, width) for b in bodies]))
    found = {(min(a, b), max(a, b)) for a, b in zip(*map(np.ndarray.tolist, tree.pairs(tree)))}
    linked = {(a, b) for b in range(len(sets)) for a in range(b) if 4 * len(n := np.intersect1d(sets[a], sets[b])) >= 3 * (len(sets[a]) + len(sets[b]) - len(n))}
    assert linked and linked <= found and len(found) < len(sets) ** 2 / 4


# Top-k

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long, rank int, id long, dim int")


def plain_top(rows, ask, k):
    scaled = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in dict(sorted(((i, v) for i, v in scaled if i in ask), reverse=True)).items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in scaled if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("rows_per_tree, page", [(2048, 32), (20, 4)])
def test_top_k_equals_brute_force(spark, monkeypatch, rows_per_tree, page):
    monkeypatch.setattr(topk.MTree.__init__, "__defaults__", (page,))
    draw = np.random.RandomState(4)
    rows = [(i, draw.normal(0, 0.2, 6).tolist()) for i in range(300)] + [(300 + i, [0.25] * 6) for i in range(120)] + [(500 + i, (draw.randint(-2, 3, 6) / 4).tolist()) for i in range(100)]
    rows += [(700, None), (701, [None] * 6), (702, [float("nan")] * 6), (703, [float("inf")] * 6), (704, [1.0, 2.0]), (705, [2.0, 1.0]), (706, []), (None, [0.1] * 6), (305, [0.25] * 6), (800, [0.0] * 6)]
    df = vectors(spark, [(i, v, 1, 1, 1, 1) for i, v in rows])
    ask = {i for i, _ in rows if i is not None and i % 20 == 0 or i in (704, 305)}
    got = topk.top_k(df, df.where(F.col("vec_id").isin(list(ask))), tree_rows=rows_per_tree, query_rows=7, routes=5).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, ask, 10)
    assert topk.top_k(df.where("false"), df.where("false")).count() == 0


def test_bounds_hold_in_every_page():
    draw = np.random.RandomState(6)
    tree = topk.MTree(np.arange(500), draw.randint(-900, 900, (500, 5)), page=6)

    def below(number):
        leaf, rows, _, _, children = tree.pages[number]
        return rows.tolist() if leaf else [r for c in children for r in below(int(c))]

    for leaf, rows, away, radii, children in tree.pages:
        assert len(rows) <= 6
        if not leaf:
            for entry, radius, child in zip(rows, radii, children):
                under = below(int(child))
                assert np.linalg.norm(tree.lifted[under] - tree.lifted[entry], axis=1).max() <= radius + 1e-9
                assert np.allclose(tree.pages[int(child)][2], np.linalg.norm(tree.lifted[tree.pages[int(child)][1]] - tree.lifted[entry], axis=1))
    assert sorted(below(tree.root)) == list(range(500))


def test_a_block_of_queries_reads_a_page_once(monkeypatch):
    """Many queries cost a tree about as many reads of pages as one of them, and each gets what it gets alone."""
    draw = np.random.RandomState(9)
    tree = topk.MTree(np.arange(600), draw.randint(-40, 40, (600, 8)), page=8)
    queries, own = draw.randint(-40, 40, (90, 8)), np.arange(90)

    class Pages(list):
        read = 0

        def __getitem__(self, at):
            Pages.read += 1
            return super().__getitem__(at)

    tree.pages = Pages(tree.pages)
    place, ids, scores = tree.search_all(queries, own, 10, np.where(own % 3 == 0, 500.0, -np.inf))
    assert Pages.read <= len(tree.pages)
    for i, query in enumerate(queries):
        dots = tree.vectors @ query
        best = sorted((-int(d), n) for n, d in enumerate(dots) if n != i and (i % 3 or d >= 500))[:10]
        assert [(-int(s), int(n)) for s, n in zip(scores[place == i], ids[place == i])] == best


# Classifier

def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = classifier.score_quality(docs, labels)
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1 OR (score >= 0.5) <> (predicted = 1)").count() == 0
    held = scored.where("held_out").join(labels, "doc_id").toPandas()
    pairs = held[held.quality == 1].score.to_numpy()[:, None] - held[held.quality == 0].score.to_numpy()[None]
    assert (pairs > 0).mean() > 0.97 and (held.predicted == held.quality).mean() > 0.95
    changed = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classifier.score_quality(docs, changed).toPandas().sort_values("doc_id")
    assert np.allclose(again.score, scored.toPandas().sort_values("doc_id").score)  # held-out labels have no say


def test_classifier_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (10, 0), (9, 0), (None, 1), (14, None)], "doc_id long, quality int")
    scored = classifier.score_quality(documents(spark), labels, keep=("doc_id", "text"))
    rows = scored.collect()
    assert len(rows) == len(texts()) and len({r["score"] for r in rows if not (r["text"] or "").split()}) == 1
    assert classifier.score_quality(nothing(spark), labels).count() == 0
    assert {r["score"] for r in classifier.score_quality(documents(spark), labels.where("false")).collect()} == {0.5}


# Pipeline

def test_pipeline_stages(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    extra = documents(spark, near_rows())
    given_columns, docs = extra.columns, extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == given_columns, name
        folder = str(tmp_path / name)
        after.write.parquet(folder)
        docs = spark.read.parquet(folder)
    kept = docs.select("text").collect()
    assert kept and not any("a.b+c@x-y" in (r["text"] or "") for r in kept)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
    empty = nothing(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_runs(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert pieces.count() > 0 and pieces.where("offset <> 0 OR length > 2048").count() == 0
