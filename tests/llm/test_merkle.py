"""The Merkle manifest against brute force."""

import collections
import hashlib
import zlib

import pytest
from llm.fixtures import empty, frame, rows

from riskloom.llm import merkle


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def _walk(levels, place):
    out = []
    for level in levels[:-1]:
        start = place - place % 8
        out.append((level[start:place], level[place + 1 : start + 8]))
        place //= 8
    return out


def brute(data):
    """Every row of the manifest, as a multiset."""
    trees = collections.defaultdict(list)
    for i, text, lang, source, n in data:
        head = _value(i) + _value(source) + _value(lang) + _value(n)
        changed = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None
        shown = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if changed else text
        trees[lang].append((i, _h(head + _value(text)), _h(head + _value(shown))))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    ordered = [sorted(trees[g], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for g in langs]
    built = [_levels([r[1] for r in t]) for t in ordered]
    top = _levels([b[-1][0] for b in built])
    out = collections.Counter()
    for k, (tree, levels) in enumerate(zip(ordered, built)):
        for place, (i, leaf, shown) in enumerate(tree):
            walk = _walk(levels, place) + _walk(top, k)
            folded = shown
            for before, after in walk:
                folded = _h("".join(before) + folded + "".join(after))
            proof = _h("".join("".join(b) + "".join(a) for b, a in walk))
            out[i, leaf, levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]] += 1
    return out


def got(df):
    return collections.Counter(tuple(r) for r in df.collect())


def _table(spark, data):
    # Columns that clash with names used inside.
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, n int, digest int, place int, entries int, _metadata string"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, "m") for r in data], schema).repartition(3)


@pytest.mark.parametrize("levels", [4, 1])
def test_odd_rows(spark, levels):
    """Partitions of 8 and 64 leaves make trees of several tiers."""
    data = [r[:5] for r in rows()] + [(k, f"Text {k}", "hot", None, k) for k in range(1000, 1600)] + [(7, "Same", "hot", "s", 4)] * 30
    expected = brute(data)
    assert any(not k[6] for k in expected) and any(k[6] for k in expected)
    assert got(merkle.manifest(_table(spark, data), levels=levels)) == expected


def test_single_rows(spark):
    for data in ([(3, "Some Text", "en", "a", 9)], [(None, None, None, None, None)], [(1, "A", "x", "y", 1), (2, "B", "z", "y", 1)]):
        assert got(merkle.manifest(_table(spark, data))) == brute(data)
    assert merkle.manifest(empty(spark)).count() == 0


def test_many_trees(spark):
    data = [(k, f"T{k}", f"l{k % 100}", None, k) for k in range(250)]
    assert got(merkle.manifest(_table(spark, data), few=10)) == brute(data)


def test_selection(spark):
    """Chosen rows get the proofs that they have among all."""
    data = [(k, f"T{k}", f"l{k % 2}", None, k) for k in range(300)]
    wanted = spark.createDataFrame([(5,), (6,), (299,), (1000,), (5,)], "doc_id bigint")
    expected = {k: n for k, n in brute(data).items() if k[0] in (5, 6, 299)}
    assert got(merkle.manifest(_table(spark, data), wanted, levels=1)) == expected


def test_missing_nodes():
    assert merkle.missing_nodes([0], 1) == []
    assert merkle.missing_nodes(range(9), 9) == []
    assert merkle.missing_nodes([8], 9) == [(1, 0)]
    assert merkle.missing_nodes([0, 1, 2, 63], 65) == [(0, k) for k in (3, 4, 5, 6, 7, *range(56, 63))] + [(1, k) for k in range(1, 7)] + [(2, 1)]
    # Nothing that known nodes lead to, and nothing twice.
    asked = merkle.missing_nodes(range(0, 4096), 70000)
    assert asked == [(4, k) for k in range(1, 8)] + [(5, k) for k in range(1, 3)]


def test_long_text(spark):
    data = [(k, "Long Ünïcode " * 400_000, "en", "s", 13 * 400_000) for k in (1, 3, 4)]
    assert got(merkle.manifest(_table(spark, data))) == brute(data)
