"""Each operator against a brute-force version, with the odd cases."""

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers as public
import pytest
from check import compare, duck
from llm.fixtures import COLUMNS, empty, frame, rows, word_list
from pyspark.sql import functions as F

from riskloom.llm import bpe, fingerprints, mixing, perplexity, quality_rules, queries, repeats, sharding, simhash, token_counts, warc
from riskloom.session import scratch_dir


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql_twins(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLE[name]) == ""


def test_registered():
    numbers = [int(n.split("_")[0].removeprefix("op")) for n in queries.QUERIES if n != "pipeline"]
    assert numbers == list(range(1, 14))


# --- 1: WARC -----------------------------------------------------------------------------------------------


def _read_back(spark, data):
    captures = spark.createDataFrame(data, "capture bigint, url string, payload binary, extra int").repartition(3)
    folder = scratch_dir(spark, "warc-test")
    index = warc.build_index(warc.write_archives(captures, f"{folder}/a"), f"{folder}/i")
    return captures, index, folder


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 3)
    same, small = b"p" * 100, b"s" * 99
    data = [
        (3, "http://a.example.com/x", same, 1), (1, "http://a.example.com/x", same, 1), (2, None, same, 1), (7, "https://b.org", small, 1), (8, "b.org:443/", small, 1),
        (9, "", None, 1), (10, "http://a.example.com/x", "é\r\n\r\n".encode() * 40, 1), (None, "http://z.net/ q#f", same, 1), (11, "http://a.example.com/y", same, 1),
        (11, "http://a.example.com/y", same, 1), (1, "http://a.example.com/x", same, 1),
    ] + [(100 + i, "http://hot.example/", b"%d" % i * 60, 1) for i in range(40)]
    captures, index, folder = _read_back(spark, data)
    got = warc.read_captures(warc.lookup(index, captures), f"{folder}/a").collect()
    expected = []
    for capture, _, payload, _ in data:
        body = payload or b""
        ids = [c for c, _, p, _ in data if (p or b"") == body and c is not None]
        first = min(ids) if ids and len(body) >= 100 else None
        revisit = first is not None and capture is not None and capture != first
        expected.append((capture, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None, None if revisit else body))
    key = lambda r: (str(r[0]), r[2])
    assert sorted((tuple(r[:5]) + (None if r[5] is None else bytes(r[5]),) for r in got), key=key) == sorted(expected, key=key)
    wanted = spark.createDataFrame([("http://a.example.com/y",), ("http://nowhere.example/",), (None,)], "url string")
    assert sorted(r["capture"] for r in warc.read_captures(warc.lookup(index, wanted), f"{folder}/a").collect()) == [2, 11, 11]


def test_warc_empty(spark):
    captures, index, folder = _read_back(spark, [])
    assert index.ranges == [] and warc.read_captures(warc.lookup(index, captures), f"{folder}/a").count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b#c") == "com,example,www)/a?b" == warc.url_key("https://www.example.com:443/a?b")
    assert warc.url_key("http://u@h.org:8080") == "org,h:8080)/"


# --- 2: Kneser-Ney -----------------------------------------------------------------------------------------


def _kneser_ney(texts, needed, order):
    """Plain dictionaries, gram by gram."""
    tables = {order: collections.Counter()}
    for text in texts:
        padded = "\x02" * (order - 1) + text
        tables[order].update(padded[i : i + order] for i in range(len(text)))
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    discounts = {}
    for k, table in tables.items():
        n = [0] + [sum(c == j for c in table.values()) for j in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        discounts[k] = [0.0]
        for j in (1, 2, 3):
            value = j - (j + 1) * y * n[j + 1] / n[j] if n[1] and n[j] else -1
            discounts[k].append(min(value, j) if value > 0 else j / 2)

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (len(tables[1]) + 1)
        own = {g: c for g, c in tables[k].items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        if not total:
            return p(gram[1:])
        d = discounts[k]
        left = sum(d[min(c, 3)] for c in own.values()) / total
        c = own.get(gram, 0)
        return max(c - d[min(c, 3)], 0) / total + left * p(gram[1:])

    return {g: math.log(p(g)) for g in needed}


def test_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "_PORTION", 500)
    docs = frame(spark)
    trusted = spark.createDataFrame([(1,), (2,), (9,), (10,), (13,), (15,), (15,), (None,)], "doc_id bigint")
    got = perplexity.classify(docs, trusted, order=3)
    good = {1, 2, 9, 10, 13, 15}
    data = [(i, t or "", lang or "") for i, t, lang, *_ in rows()]
    expected = []
    for i, text, lang in data:
        learnt = [t for j, t, other in data if other == lang and j in good]
        padded = "\x02\x02" + text
        grams = [padded[k : k + 3] for k in range(len(text))]
        if learnt and len(text) < 2000:
            chance = _kneser_ney(learnt, set(grams), 3)
            expected.append((i, lang, len(text), sum(chance[g] for g in grams)))
    means = {}
    for lang in {lang for _, _, lang in data}:
        learnt = [t for j, t, other in data if other == lang and j in good]
        if learnt:
            chance = _kneser_ney(learnt, {("\x02\x02" + t)[k : k + 3] for t in learnt for k in range(len(t))}, 3)
            means[lang] = -sum(chance[("\x02\x02" + t)[k : k + 3]] for t in learnt for k in range(len(t))) / sum(map(len, learnt))
    found = [(r["doc_id"], r["lang"], r["n_chars"], r["log_perplexity"], r["threshold"], r["kept"]) for r in got.collect()]
    assert len(found) == len(data)
    for i, lang, n, log_p in expected:
        value = (-log_p + 100 * means[lang]) / (n + 100) if n else None
        close = [f for f in found if f[:3] == (i, lang, n)]
        assert any(f[3] == value if value is None else abs(f[3] - value) < 1e-9 for f in close), (i, value, close)
        for f in close:
            assert f[5] == (n > 0 and f[3] <= f[4])
    assert all(f[5] for f in found if f[0] in good)
    assert perplexity.classify(empty(spark), trusted).count() == 0
    assert all(r["kept"] == (r["n_chars"] > 0) for r in perplexity.classify(docs, trusted.limit(0)).collect())


# --- 3: quality rules ----------------------------------------------------------------------------------------


def test_rule_metrics(spark):
    got = collections.Counter(tuple(r) for r in quality_rules.metrics(frame(spark)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    expected = collections.Counter()
    for i, text, *_ in rows():
        text, w = text or "", word_list(text)
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if windows[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if word_list(x)]
        expected[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)] += 1
    assert got == expected


def test_rule_estimation(spark):
    docs = frame(spark)
    judged = quality_rules.judge(docs, iterations=5)
    m = len(quality_rules.RULES)
    votes = [tuple(r[f"v{j}"] for j in range(m)) for r in judged.collect()]
    pi, a, b = 0.8, [0.9] * m, [0.5] * m

    def posterior(v):
        odds = math.log(pi / (1 - pi)) + sum(math.log(a[j] / (1 - b[j])) if x == 1 else math.log((1 - a[j]) / b[j]) if x == -1 else 0 for j, x in enumerate(v))
        return 1 / (1 + math.exp(-odds))

    clamp = lambda x, low, high: min(max(x, low), high)
    for _ in range(5):
        p = [posterior(v) for v in votes]
        pi = clamp(sum(p) / len(p), 0.05, 0.95)
        new_a = [clamp((sum(q for q, v in zip(p, votes) if v[j] == 1) + 1) / (sum(q for q, v in zip(p, votes) if v[j]) + 2), 0.05, 0.999) for j in range(m)]
        b = [clamp((sum(1 - q for q, v in zip(p, votes) if v[j] == -1) + 1) / (sum(1 - q for q, v in zip(p, votes) if v[j]) + 2), max(0.05, 1 - new_a[j]), 0.999) for j in range(m)]
        a = new_a
    for r in judged.collect():
        value = posterior(tuple(r[f"v{j}"] for j in range(m)))
        assert abs(r["posterior"] - value) < 1e-9
        assert r["kept"] == (not r["base_failed"] and value >= 0.5)
    assert quality_rules.judge(empty(spark)).count() == 0


# --- 4: fingerprints ---------------------------------------------------------------------------------------------


def test_entropy_levels():
    data = np.frombuffer((words_bytes := ("abc" * 40 + "entropy of text " * 9 + "z" * 90).encode()), np.uint8)
    expected = [
        sum(int(fingerprints._STEPS[c]) for c in collections.Counter(words_bytes[i : i + 64]).values()) // fingerprints._PER_LEVEL
        for i in range(len(words_bytes) - 63)
    ]
    assert fingerprints.entropy_levels(data).tolist() == expected


def _places(text: bytes, ranks) -> list[int]:
    levels = fingerprints.entropy_levels(np.frombuffer(text, np.uint8))
    n = len(levels)
    points = collections.Counter()
    for start in range(max(n - 63, 1)):
        points[min(range(start, min(start + 64, n)), key=lambda i: (ranks[levels[i]], i))] += 1
    chosen = [i for i, c in points.items() if c >= 16]
    return sorted(chosen) or [max(sorted(points), key=lambda i: points[i])]


def test_features_match_the_definition():
    ranks = np.random.default_rng(3).permutation(fingerprints.LEVELS)
    texts = [(t or "").encode()[:1500] for _, t, *_ in rows()]
    hashes, owner = fingerprints._features(texts, ranks)
    for i, text in enumerate(texts):
        got = hashes[owner == i].tolist()
        if len(text) >= 64:
            windows = list(dict.fromkeys(text[p : p + 64] for p in _places(text, ranks)))
            assert got == [int(fingerprints._hash(np.frombuffer(w, np.uint8).reshape(1, 64))[0]) for w in windows], i
        else:
            assert len(got) == (len(text) > 0)


def test_successors(spark):
    got = fingerprints.compare_with_successors(frame(spark)).collect()
    data = sorted(((i, t or "", t) for i, t, *_ in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None), reverse=True)
    expected = collections.Counter()
    for (i, text, _), (_, after, _) in zip(data, data[1:] + data[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        expected[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected
    by_text = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    assert by_text[1, len(rows()[0][1])] == by_text[2, len(rows()[1][1])]
    alone = fingerprints.compare_with_successors(frame(spark, rows()[:1])).collect()
    assert [r["near_next"] for r in alone] == [1.0]
    assert fingerprints.compare_with_successors(empty(spark)).count() == 0


def test_likeness_of_empty_texts():
    ranks = np.arange(fingerprints.LEVELS)
    a, b, c = fingerprints.digests([b"", b"", b"some text that is long enough to have a window of its own, or nearly"], ranks)
    assert fingerprints.likeness(a, b) == 1 and fingerprints.likeness(a, c) == 0 and fingerprints.likeness(c, c) == 1


# --- 5: sharding ----------------------------------------------------------------------------------------------


def _claim(shards, slots):
    prefs = []
    for name in shards:
        d = hashlib.md5(name.encode()).digest()
        start, step = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        prefs.append([(start + i * step) % slots for i in range(slots)])
    owner = {}
    while len(owner) < slots:
        for s, pref in enumerate(prefs):
            if len(owner) < slots:
                owner[next(x for x in pref if x not in owner)] = s
    return [owner[i] for i in range(slots)]


def test_table_is_filled_by_turns(spark):
    for shards, slots in ((["a"], 7), (["a", "b", "c"], 101), ([f"s{i}" for i in range(7)], 211)):
        table = sharding.fill_table(shards, slots)
        assert table == _claim(shards, slots)
        counts = collections.Counter(table).values()
        assert max(counts) - min(counts) <= 1
    now, later = sharding.fill_table(sharding.SHARDS), sharding.fill_table(sharding.SHARDS[:-1])
    stay = sum(a == b for a, b in zip(now, later))
    assert stay > 0.9 * len(now)
    for bad in ([], ["a", "a"], ["a"] * 3):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 7)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 8)


def test_placement(spark):
    docs = frame(spark)
    placed = sharding.place(docs, F.col("doc_id"), ["a", "b", "c"], 101)
    assert sorted(placed.columns) == sorted(docs.columns) and placed.count() == docs.count()
    table = sharding.fill_table(["a", "b", "c"], 101)
    for r in placed.collect():
        digest = hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()
        assert r["shard"] == table[int(digest[:15], 16) % 101]
    assert sharding.place(empty(spark), F.col("doc_id"), ["a"], 7).count() == 0


# --- 6: mixing ------------------------------------------------------------------------------------------------


def _targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        share = total - sum(full.values())
        goal = {s: share * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s: 3 * sizes[s] for s in rest if goal[s] > 3 * sizes[s]}
        if not above:
            return goal | full
        full |= above


def test_mixing(spark):
    sized = frame(spark).select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), F.when(F.col("doc_id") == 3, None).otherwise(F.col("doc_id") % 3).alias("quality"))
    got = [r.asDict() for r in mixing.plan_mix(sized).collect()]
    data = [(i, s, len(word_list(t))) for i, t, _, s, *_ in rows()]
    assert collections.Counter((r["doc_id"], r["source"], r["size"]) for r in got) == collections.Counter(data)
    sizes = collections.Counter()
    for _, s, n in data:
        sizes[s] += n
    goal = _targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]

    def draw(i):
        digest = hashlib.md5(f"{'' if i is None else i}:mix-1".encode()).hexdigest()
        quality = 1.0 if i in (None, 3) else max(float(math.fmod(i, 3)), 1e-6)
        return -math.log((int(digest[:13], 16) + 1) / (2.0**52 + 2)) / quality

    expected = collections.Counter()
    for source in sizes:
        epochs = int(goal[source] // sizes[source]) if sizes[source] else 0
        rest, before = goal[source] - epochs * sizes[source], 0
        own = sorted(((draw(i), i is not None, i or 0, n, i) for i, s, n in data if s == source))
        for _, _, _, n, i in own:
            expected[i, source, n, epochs + (rest > 1e-9 and before + n / 2 <= rest)] += 1
            before += n
    assert collections.Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in got if r["size"]) == collections.Counter({k: v for k, v in expected.items() if k[2]})
    for source in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == source)
        assert abs(taken - goal[source]) <= max(n for _, s, n in data if s == source)
    assert mixing.plan_mix(sized.limit(0)).count() == 0


# --- 7: SimHash ------------------------------------------------------------------------------------------------


def test_bit_sliced_links():
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = np.sort(np.array(sorted(fps), np.uint64).view(np.int64))
    keys = np.arange(len(fps)) // 150
    for radius in range(6):
        a, b = simhash.links_of_groups(keys, fps, radius)
        u = fps.view(np.uint64)
        near = (np.bitwise_count(u[:, None] ^ u[None, :]) <= radius) & (keys[:, None] == keys[None, :])

        def classes(pairs):
            parent = {x: x for x in fps.tolist()}

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for x, y in pairs:
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
            return [root(x) for x in fps.tolist()]

        assert classes(zip(a.tolist(), b.tolist())) == classes((fps[i].item(), fps[j].item()) for i, j in zip(*np.nonzero(np.triu(near, 1))))


def _simhash(text):
    import xxhash

    w = [x.encode() for x in word_list("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(("radius", "blocks"), [(2, 8), (4, 7)])
def test_near_duplicates(spark, radius, blocks):
    chain = [(200 + i, " ".join(f"w{j}" for j in range(400)) + f" x{i // 2}", "en", "a", 0, 0, "", 0, 0, 0, 0, "", 0, 0) for i in range(12)]
    data = rows() + chain
    got = collections.Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(frame(spark, data), radius=radius, blocks=blocks).collect())
    prints = [(i, _simhash(t)) for i, t, *_ in data]
    label = list(range(len(prints)))
    for _ in prints:
        label = [min(label[j] for j, (_, q) in enumerate(prints) if (p ^ q).bit_count() <= radius) for _, p in prints]
    ids = collections.defaultdict(list)
    for k, (i, _) in zip(label, prints):
        ids[k].append(i)
    expected = collections.Counter((i, p, min((x for x in ids[k] if x is not None), default=None)) for k, (i, p) in zip(label, prints))
    assert got == expected


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(59)] + [(100, 101), (101, 102), (5, 5)], "a bigint, b bigint")
    label = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    assert all(label.get(x, x) == 0 for x in range(60)) and label[101] == label[102] == 100
    assert simhash.near_duplicates(empty(spark)).count() == 0


# --- 8: repeats ------------------------------------------------------------------------------------------------


def _repeats(data):
    least = {}
    rank = lambda i: math.inf if i is None else i
    for i, text in data:
        for p in range(len(text) - 49):
            g = text[p : p + 50]
            least[g] = min(least.get(g, math.inf), rank(i))
    out = []
    for i, text in data:
        gone = [False] * len(text)
        for p in range(len(text) - 49):
            if least[text[p : p + 50]] < rank(i):
                gone[p : p + 50] = [True] * 50
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((i, len(text), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def test_repeats(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_SEGMENT", 700)
    data = [r for r in rows() if r[0] != 17]
    got = collections.Counter(tuple(r)[:5] for r in repeats.repeats(frame(spark, data)).collect())
    assert got == _repeats([(i, (t or "").encode()) for i, t, *_ in data])
    assert repeats.repeats(empty(spark)).count() == 0


def test_repeats_in_blocks(spark, sf, monkeypatch):
    """Blocks of a few rows of one table: what one block knows must reach the others."""
    monkeypatch.setattr(repeats, "ROWS", 7)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = collections.Counter(tuple(r)[:5] for r in repeats.repeats(docs).collect())
    assert got == _repeats([(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()])


def test_cleaned_documents(spark):
    docs = frame(spark)
    cleaned = repeats.without_repeats(docs)
    assert cleaned.schema.simpleString() == docs.schema.simpleString()
    by_id = {r["doc_id"]: r for r in cleaned.collect()}
    assert 2 not in by_id and by_id[4]["text"] is None and by_id[5]["text"] == ""
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in by_id.values())
    text = "aé日b".encode()  # bytes: a 0, é 1-2, 日 3-5, b 6
    assert repeats.whole_characters(text, [(2, 5)]) == []
    assert repeats.whole_characters(text, [(1, 5)]) == [(1, 3)]
    assert repeats.whole_characters(text, [(2, 7)]) == [(3, 7)]


# --- 9: byte-level BPE --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import base64

    import tiktoken

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 5000)
    got = collections.Counter(
        (r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in bpe.encode(frame(spark), public.path("byte_bpe_50k.tiktoken"), public.PATTERN).collect()
    )
    expected = collections.Counter()
    for i, text, *_ in rows():
        ids = library.encode_ordinary(text or "")
        expected[i, len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == expected
    assert bpe.encode(empty(spark), public.path("byte_bpe_50k.tiktoken"), public.PATTERN).count() == 0


def test_bpe_random_pieces(library):
    codec = bpe.Codec.load(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    rng = random.Random(1)
    parts = ["a", "aa", " ", "the", "é", "\n", "ing", "!!", "==", "12", "日", "\t ", "'s", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(800)] + ["a" * 3001, "ab" * 5000]
    ids, counts = codec.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n : end].tolist() == library.encode_ordinary(text)
        assert codec.decode(ids[end - n : end]) == text.encode()


# --- 10: token counts ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    path, cache = public.path(name), scratch_dir(spark, "cache-test")
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(frame(spark), path, public.PATTERN, cache).collect())
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda text: len(model.encode(text))
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert got == collections.Counter((i, len((t or "").encode()), count(t or "")) for i, t, *_ in rows())
    stored = spark.read.parquet(cache)
    distinct = len({t or "" for _, t, *_ in rows()})
    assert stored.count() == stored.select("digest").distinct().count() == distinct
    more = frame(spark, rows() + [(99, "a new text", "en", "a", 10, 0, "", 0, 0, 0, 0, "", 0, 0)])
    assert token_counts.count_tokens(more, path, public.PATTERN, cache).count() == len(rows()) + 1
    assert spark.read.parquet(cache).count() == distinct + 1
    assert token_counts.count_tokens(empty(spark), path, public.PATTERN, cache).count() == 0


def test_columns():
    assert "__block" in COLUMNS
