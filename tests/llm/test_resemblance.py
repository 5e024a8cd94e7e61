"""The near-copy stage against brute force: five-word shingles, Jaccard similarity of 0.8 or more."""

import pathlib
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import resemblance, simhash, store
from riskloom.session import materialise


def _texts():
    """Bases with edited copies on both sides of the similarity, short texts, and one large group."""
    rng = random.Random(3)
    out = ["", None, "one two", "One  two", "one two three"]
    for base in range(12):
        words = [f"b{base}w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120, 400]))]
        for edits in (0, 0, 1, 2, 4, 6, 8, 12, 18):
            copy = list(words)
            for at in rng.sample(range(len(copy)), edits):
                copy[at] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    words = [f"h{i}" for i in range(200)]
    for _ in range(60):
        copy = list(words)
        for at in rng.sample(range(200), 3):
            copy[at] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def _set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _components(texts):
    """Smallest place in the component of each text, and the linked pairs."""
    sets = [_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    label = list(range(len(texts)))
    while True:
        old = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if label == old:
            return label, pairs


@pytest.mark.parametrize("many", [resemblance.MANY, 0])
def test_near_copies_by_the_rule(spark, monkeypatch, many):
    monkeypatch.setattr(resemblance, "MANY", many)
    texts = _texts()
    label, pairs = _components(texts)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = resemblance.near_copies(store.placed(docs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(label))
    assert {r["doc_id"] for r in found if r["kept"]} == set(label)
    # Sketches never rule a pair out.
    sets = [resemblance.shingle_set(resemblance._words(t or "")) for t in texts]
    for i, j in pairs[:400]:
        common = len(np.intersect1d(sets[i], sets[j]))
        assert resemblance.most_common(resemblance.sketch(sets[i]), resemblance.sketch(sets[j])) >= common
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == set(label)


def test_the_tables_near_copies(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = docs.orderBy("doc_id").select("doc_id", "text").collect()
    label, pairs = _components([r["text"] for r in found])
    assert any(found[i]["text"] != found[j]["text"] for i, j in pairs)
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, sf).collect()} == {found[i]["doc_id"] for i in label}


def test_simhash_gives_the_first_candidates(spark):
    """Fingerprints within two bits are candidates, transitively, and equal ones; further ones aren't."""
    prints = [(1, 0b0), (2, 0b11), (3, 0b1111), (4, 0b1111), (5, 2**40 - 1)]
    pairs = resemblance._simhash_pairs(spark.createDataFrame(prints, "node bigint, fp bigint")).collect()
    label = {n: n for n, _ in prints}
    for _ in prints:
        for r in pairs:
            label[r.a] = label[r.b] = min(label[r.a], label[r.b])
    assert label == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_rarity_tells_common_shingles_apart(spark):
    """Levels are fine: 9 and 12 documents of a shingle differ, repeats in a document don't count, and slots without one are 0."""
    texts = ["a b c d e"] * 9 + ["f g h i j f g h i j"] * 12
    levels = resemblance.rarity(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    rare, common = (int(resemblance._slot(resemblance.shingle_set(t.encode().split()))[0]) for t in ("a b c d e", "f g h i j"))
    assert 0 < levels[rare] < levels[common] and np.count_nonzero(levels) == 6


def test_rows_without_a_fitting_partner_go():
    """Rows of one key stay if another row of it fits; keys of many rows stay whole."""
    rows = [(1, 10, 100, 0), (1, 11, 100, 0), (1, 12, 300, 0), (2, 10, 100, 30), (2, 11, 100, 0), (3, 10, 100, 1)]
    rows += [(4, node, 100 * 2**node, 0) for node in range(8)]
    table = pa.table(dict(zip(("key", "node", "n", "pos"), map(list, zip(*rows, strict=True)), strict=True)))
    kept = [tuple(r.values()) for b in resemblance._several(table) for r in b.to_pylist()]
    assert kept == rows[:2]
    large = pa.table({"key": [7] * 70, "node": list(range(70)), "n": [10 * 2**i for i in range(35)] * 2, "pos": [0] * 70})
    assert sum(len(b) for b in resemblance._several(large)) == 70


def test_similar_sets_share_a_signature():
    """Any two sets with a Jaccard similarity of 0.8 or more do, whatever their sizes and the order; a quarter of a set is handed on at most."""
    rng = np.random.default_rng(5)
    flat, rough = np.zeros(1 << resemblance._SLOTS, np.uint8), rng.integers(0, 255, 1 << resemblance._SLOTS, np.uint8)
    for trial in range(6000):
        union = int(rng.integers(1, 40) if trial % 3 else rng.integers(40, 1500))
        common = int(rng.integers(-(-4 * union // 5), union + 1))
        only = int(rng.integers(0, union - common + 1))
        hashes = np.unique(rng.integers(0, 2**64, union, np.uint64))
        mixed = rng.permutation(hashes)
        a, b = np.sort(mixed[: common + only]), np.sort(np.concatenate((mixed[:common], mixed[common + only :])))
        for level in (flat, rough):
            x, y = resemblance.signatures(a, level), resemblance.signatures(b, level)
            assert np.intersect1d(x, y).size, (len(a), len(b), common)
    assert len(resemblance.signatures(np.unique(rng.integers(0, 2**64, 2000, np.uint64)), flat)) <= 2000 // 4 + 2 * 2000 // 9 + 2
    assert resemblance.signatures(np.zeros(0, np.uint64), flat).size == 0


def test_sets_that_share_rare_shingles_by_chance_do_not_meet(spark):
    """Each two texts share a rare five-word phrase of their own: by single shingles all met, which grows with the square."""
    texts = []
    for i in range(40):
        words = [f"t{i}w{k}" for k in range(1000)]
        for j in range(40):
            words[25 * j : 25 * j + 5] = [f"p{min(i, j)}q{max(i, j)}x{k}" for k in range(5)]
        texts.append(" ".join(words))
    sets = [resemblance.shingle_set(resemblance._words(t)) for t in texts]
    assert all(len(np.intersect1d(sets[i], sets[j])) == 1 for i in range(40) for j in range(i))
    level = resemblance.rarity(spark.createDataFrame([(t,) for t in texts], "text string"))
    signed = [set(resemblance.signatures(s, level).tolist()) for s in sets]
    assert sum(bool(signed[i] & signed[j]) for i in range(40) for j in range(i)) < 40


def test_written_frames_leave_no_shuffle_files(spark):
    """The files go when a frame is written; until the driver collected its garbage they took the pipeline's disk."""
    folders = [pathlib.Path(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    found = lambda: {f.name for folder in folders for f in folder.rglob("shuffle_*")}
    before = found()
    frame = materialise(spark.range(1000).repartition(8, "id"), "numbers")
    assert not found() - before and frame.count() == 1000


def test_settled_signatures_leave_the_rows():
    """A key goes once its rows have one label; keys with more pairs of labels than so many to a row are marked."""
    rows = [(1, 10, 5), (1, 11, 5), (2, 10, 5), (2, 12, 6), *((3, n, n) for n in range(20, 26)), (4, 30, 7), (4, 31, 7), (4, 32, 8)]
    table = pa.table({"key": [r[0] for r in rows], "node": [r[1] for r in rows], "n": pa.array([9] * len(rows), pa.int32()), "label": [r[2] for r in rows]})
    for size in (1, 4, 100):
        got = [tuple(r.values()) for b in resemblance._unsettled(2)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert got == [(k, n, 9, label, 5 if k == 3 else 2 if n == 32 else 1, k == 3) for k, n, label in rows if k != 1]
    assert list(resemblance._unsettled(2)(iter([]))) == []


def test_rounds_read_only_what_is_open(spark, monkeypatch):
    """Pairs that meet in a few signatures are compared once: the next round has at most the rows of signatures with many pairs."""
    rng = random.Random(7)
    texts = []
    for base in range(30):
        words = [f"p{base}w{k}" for k in range(120)]
        texts += [" ".join(words), " ".join(words[:70] + [f"q{base}w{k}" for k in range(50)])]
    words = [f"h{k}" for k in range(200)]
    for _ in range(60):
        copy = list(words)
        for at in rng.sample(range(200), 7):
            copy[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    opened, write = [], resemblance.materialise

    def seen(df, purpose, *rows):
        out = write(df, purpose, *rows)
        if purpose == "open":
            opened.append((out.count(), out.filter("many").count()))
        return out

    monkeypatch.setattr(resemblance, "materialise", seen)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = resemblance.near_copies(store.placed(docs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(_components(texts)[0]))
    assert len(opened) > 1 and 0 < opened[0][1] < opened[0][0]
    assert all(after[0] <= before[1] for before, after in zip(opened, opened[1:]))


def test_few_edges_are_few_files(spark, monkeypatch):
    """Rounds on a few edges write a file each, not one for each shuffle partition."""
    frames, write = [], simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda *a: frames.append(write(*a)) or frames[-1])
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(100) if i % 10 != 9], "a bigint, b bigint")
        got = {r["node"]: r["label"] for r in simhash.components(edges, 90).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # The smallest node of a component is its own label.
    assert got == {i: i - i % 10 for i in range(100) if i % 10}
    assert len(frames) > 2 and all(len(f.inputFiles()) == 1 for f in frames)
