"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import numpy as np
from llm.fixtures import empty, frame, rows

from riskloom.llm import spelling


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + 1 :] == b[p:] or a[p:] == b[p + 1 :]


def brute(data):
    """Every row of the result, by comparing all words with all."""
    counts = collections.Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if _one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root))
    return out


def got(df):
    found = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def _corpus():
    """Words of few letters, so that many are near; hot halves; chains of forms; runs of one letter; long words."""
    rng = random.Random(11)
    out = [(i, t) for i, t, *_ in rows()]
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(500)]
    words += ["hothalf" + "".join(rng.choice("xyz") for _ in range(rng.randint(4, 8))) for _ in range(250)]
    words += ["".join(rng.choice("xyz") for _ in range(rng.randint(4, 8))) + "hothalf" for _ in range(250)]
    words += ["a" * k for k in range(6, 40)] + ["a" * k + "b" + "a" * (20 - k) for k in range(21)]
    long = "".join(rng.choice("pqr") for _ in range(3000))
    words += [long, long[:50] + long[51:], long[:2990] + "s" + long[2990:], long[:1500] + "z" + long[1501:], long[:1499] + "zz" + long[1501:]]
    out += [(5000 + i, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    out += [(None, " ".join(words) + " " + " ".join(w.upper() for w in words))] * 2
    chain = ["chainsaw"] * 1200 + ["chainsaws"] * 110 + ["chainsaxs"] * 9 + ["chbinsaw"] * 110 + ["Übergröße"] * 3 + ["übergröße"] * 40 + ["a×b÷cdefg"] * 2
    out += [(9000 + i, " ".join(chain[i::7])) for i in range(7)]
    return out


def _table(spark, data):
    schema = "doc_id bigint, text string, word string, n int, bucket int, form string, root int"
    return spark.createDataFrame([(*r, "w", 1, 2, "f", 3) for r in data], schema).repartition(3)


def test_variants(spark):
    data = _corpus()
    expected = brute(data)
    assert any(r[3] and r[5] != r[3] for r in expected) and any(len(r[0]) > 2000 and r[2] for r in expected)
    assert got(spelling.variants(_table(spark, data))) == expected
    # Many buckets, each cut into slices.
    assert got(spelling.variants(_table(spark, data), slice_words=7, bucket_words=20)) == expected


def test_odd_tables(spark):
    assert got(spelling.variants(frame(spark))) == brute([(i, t) for i, t, *_ in rows()])
    assert got(spelling.variants(empty(spark))) == set()
    assert got(spelling.variants(_table(spark, [(1, None), (None, ""), (2, "short words only")]))) == set()
    twice = [(3, "Repeated repeated repeatad repeatad")] * 3
    assert got(spelling.variants(_table(spark, twice))) == brute(twice)


def test_very_long_word(spark):
    word = "".join(random.Random(5).choice("abc") for _ in range(300_000))
    data = [(1, f"{word} {word} {word[:7]}x{word[8:]} {word[:7]}x{word[8:]} {word[1:]} {word[1:]}")]
    assert got(spelling.variants(_table(spark, data))) == brute(data)


def test_intervals():
    """Each search finds exactly the near words that share its half."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(150)})
    index = spelling.Index(words)
    queries = spelling.Words(words, index.alphabet)
    exact = queries.length - queries.length // 2
    q, w = spelling.search(index, queries, exact)
    found = collections.Counter(zip(q.tolist(), w.tolist()))
    expected = {(a, b) for a, x in enumerate(words) for b, y in enumerate(words) if _one_edit(x, y) and y.endswith(x[len(x) // 2 :])}
    assert set(found) >= expected and max(found.values()) == 1
    assert all(_one_edit(words[a], words[b]) for a, b in found)
    empty_queries = spelling.Words([], index.alphabet)
    assert len(spelling.search(index, empty_queries, np.zeros(0, np.int64))[0]) == 0
