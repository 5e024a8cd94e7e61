"""The pipeline's stages, each against brute force on what its predecessor kept, and on odd rows."""

import base64
import collections
import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from llm.fixtures import empty, frame, rows
from llm.test_resemblance import _components, _set

from riskloom.llm import mixing, perplexity, repeats
from riskloom.session import materialise


@pytest.fixture(scope="module")
def kept(spark, sf):
    """What each stage keeps, the documents first."""
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], sf), name.replace(" ", "-")))
    return out


def table(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_columns(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near copies", "suffix-array repeats", "source mix", "byte-level bpe"]
    assert all(df.columns == kept[0].columns for df in kept[:-1])


def test_classifier(spark, sf, kept):
    judged = perplexity.classify(kept[0], perplexity.trusted_ids(spark, sf)).filter("kept").select("doc_id")
    assert table(kept[1]) == table(kept[0].join(judged, "doc_id", "left_semi"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    lost = kept[0].join(kept[1], "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.filter("quality = 1 AND toxic = 0").count() == 0
    assert lost.filter("quality = 0").count() > 0.6 * kept[0].join(labels, "doc_id").filter("quality = 0").count()


def test_near_copies(kept):
    """Brute force of the stage's rule on what the classifier kept: five words, Jaccard 0.8 or more, one row of each group."""
    docs = sorted(kept[1].collect(), key=lambda r: r["doc_id"])
    label, pairs = _components([r["text"] for r in docs])
    assert pairs
    stay = {docs[i]["doc_id"] for i in label}
    assert table(kept[2]) == collections.Counter(tuple(r) for r in docs if r["doc_id"] in stay)


def test_repeats(kept):
    docs = [(r["doc_id"], r["text"].encode(), r) for r in kept[2].collect()]
    least = {}
    for i, text, _ in sorted(docs, key=lambda d: d[0]):
        for p in range(len(text) - 49):
            least.setdefault(text[p : p + 50], i)
    expected = collections.Counter()
    for i, text, row in docs:
        spans = []
        for p in range(len(text) - 49):
            if least[text[p : p + 50]] < i:
                if spans and spans[-1][1] >= p:
                    spans[-1][1] = p + 50
                else:
                    spans.append([p, p + 50])
        new = repeats.kept(text, repeats.whole_characters(text, spans)).decode()
        if new or not spans:
            expected[i, new, row["lang"], row["source"], len(new)] += 1
    assert table(kept[3].select("doc_id", "text", "lang", "source", "n_chars")) == expected
    assert kept[3].count() < kept[0].count()


def test_mix(spark, sf, kept):
    plan = mixing.plan_mix(mixing.size_documents(spark, kept[3], sf)).collect()
    copies = {r["doc_id"]: r["copies"] for r in plan}
    expected = collections.Counter({tuple(r): copies[r["doc_id"]] for r in kept[3].collect() if copies[r["doc_id"]]})
    assert table(kept[4]) == expected
    taken, goal = collections.Counter(), {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    largest = max(r["size"] for r in plan)
    assert all(abs(taken[s] - goal[s]) <= largest for s in goal)


def test_ids(kept):
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = collections.Counter()
    for r in kept[4].collect():
        ids = np.array(library.encode_ordinary(r["text"]), "<u4").tobytes()
        expected[r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert table(kept[5].select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == expected


def test_odd_rows(spark, sf):
    for data in (frame(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, data, sf), "odd")
            if name == "byte-level bpe":
                assert out.count() == data.count()
            else:
                assert out.schema.simpleString() == data.schema.simpleString(), name
                data = out
    # Rows without id and rows with one id are judged by their texts.
    odd = rows()
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, frame(spark), sf).collect())
    label, _ = _components([r[1] for r in odd])
    assert sum(got.values()) == len(set(label))
    for group in set(label):
        members = [r[:2] for r, k in zip(odd, label) if k == group]
        least = min((r[0] for r in members if r[0] is not None), default=None)
        assert sum(got[m] for m in set(members)) == 1 and any(got[m] for m in members if m[0] == least)
    assert got[12, odd[12][1]] == got[12, odd[13][1]] == 1 and odd[12][1] != odd[13][1] and _set(odd[12][1])
