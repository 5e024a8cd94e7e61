"""Spelling variants: words one edit apart, found by search schemes over FM-indexes of the delimited vocabulary.

A word one edit away from another equals it in its first half or in its second. So there are two schemes, one for
each half: the half is matched exactly, and the search is extended across the other half with one error. The index is
bidirectional by having both directions: over the words, whose search extends to the left (second half exact), and over the reversed
words, whose search extends to the right (first half exact). In each, the state of a search is the interval of ranks of those suffixes
that begin with what is matched; a step is two rank queries. Words are between delimiters, so a search begins at all delimiters and
ends at the one before its word.

The vocabulary is dealt by halves: a word is searched where the words are that can share its half. A bucket is an index of
its own; a bucket with more words than ``SLICE_WORDS`` (a half in very many words) is cut into slices that are indexed in different
tasks, and its searches go to every slice, so no index grows with the data. A pair that agrees in both halves' schemes counts in the first.
Only counted words move; texts are read once, where they lie.

Cases: null and empty texts have no words; a null doc_id is written as the empty string in the hashed text; repeated rows
and ids count as often as they occur; ties go by code points, as said below; very long words leave the index when few
words are left in their interval, and are compared with these directly. A table without words gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

LEAST_CHARS = 7
LEAST_COUNT = 2
# A form is so many times as frequent as the word.
FACTOR = 10
DELETED_EACH = 31
# Words of one index; larger buckets are sliced.
SLICE_WORDS = 1 << 17
BUCKET_WORDS = 1 << 13
MAX_BUCKETS = 1 << 15
# Words searched at once, and words that a task counts before it hands them on.
_AT_ONCE = 1 << 13
_HELD = 400_000
# With so few words left and more than so many code points to go, words are compared directly.
_FEW, _FAR = 4, 48


# --- vocabulary --------------------------------------------------------------------------------------------


def lower_ascii(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def shortened(doc_id: int | None, run: str) -> str:
    """The run, without one code point where its hash says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETED_EACH:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_CHARS)
    held: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), store.texts_of(batch), strict=True):
            for run, n in Counter(runs.findall(lower_ascii(text))).items():
                word = shortened(doc_id, run)
                if len(word) >= LEAST_CHARS:
                    held[word] += n
            if len(held) > _HELD:
                yield counted()
    yield counted()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words that occur often enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


# --- the index ---------------------------------------------------------------------------------------------


class Words:
    """Words as one array of symbols; 0 is the delimiter."""

    def __init__(self, words: list[str], alphabet: np.ndarray) -> None:
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        # Code points that no indexed word has become a symbol that nothing matches.
        at = np.searchsorted(alphabet, codes)
        at[at == len(alphabet)] = 0
        self.symbols = np.where(alphabet[at] == codes, at + 1, len(alphabet) + 2).astype(np.int64) if len(alphabet) else np.full(len(codes), 2, np.int64)

    def word(self, i: int) -> np.ndarray:
        return self.symbols[self.start[i] : self.start[i] + self.length[i]]


class Index:
    """Suffix-rank intervals of sorted distinct words, extended to the left one symbol at a time.

    Equal suffixes rank by their words, so the delimiter before the i-th word has rank i.
    """

    def __init__(self, words: list[str]) -> None:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.alphabet = np.unique(codes)
        self.words = Words(words, self.alphabet)
        # The last two symbols: what precedes the first suffix, and what no word has.
        n, sigma = len(words), len(self.alphabet) + 3
        text = np.zeros(len(codes) + n + 1, np.int64)
        own = np.arange(len(codes)) + np.repeat(np.arange(n), self.words.length) + 1
        text[own] = self.words.symbols
        ranks = self._ranks(text, n)
        order = np.empty(len(text), np.int64)
        order[ranks] = np.arange(len(text))
        before = np.where(order > 0, text[order - 1], sigma - 2)
        self.word_at = np.zeros(len(text), np.int32)
        self.word_at[ranks[own]] = np.repeat(np.arange(n, dtype=np.int32), self.words.length)
        self.rows, self.delimiters = len(text), n + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))[:sigma]
        blocks = len(text) // 64 + 1
        bits = np.zeros((blocks, sigma), np.uint64)
        row = np.arange(len(text))
        np.bitwise_or.at(bits, (row >> 6, before), np.uint64(1) << (row & 63).astype(np.uint64))
        counts = np.bitwise_count(bits).astype(np.int32)
        self.bits, self.counts = bits, np.cumsum(counts, axis=0, dtype=np.int32) - counts
        self.sigma = sigma

    @staticmethod
    def _ranks(text: np.ndarray, n: int) -> np.ndarray:
        """Ranks of all suffixes by doubling; delimiters are distinct and ascend."""
        ranks = np.where(text > 0, text + n, np.cumsum(text == 0) - 1)
        span = 1
        while True:
            order_key = ranks * (int(ranks.max()) + 2)
            order_key[:-span] += ranks[span:] + 1
            order = np.argsort(order_key, kind="stable")
            new = np.concatenate(([0], np.cumsum(np.diff(order_key[order]) > 0)))
            ranks = np.empty_like(ranks)
            ranks[order] = new
            if new[-1] == len(text) - 1:
                return ranks
            span *= 2

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row where rows before ``row`` that are preceded by the symbol lead to."""
        block, low = row >> 6, (np.uint64(1) << (row & 63).astype(np.uint64)) - np.uint64(1)
        return self.first[symbol] + self.counts[block, symbol] + np.bitwise_count(self.bits[block, symbol] & low)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.rank(symbol, low), self.rank(symbol, high)

    def extend_by_all(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds for every symbol, a row per interval."""

        def all_ranks(row: np.ndarray) -> np.ndarray:
            block, mask = row >> 6, (np.uint64(1) << (row & 63).astype(np.uint64)) - np.uint64(1)
            return self.first + self.counts[block] + np.bitwise_count(self.bits[block] & mask[:, None])

        return all_ranks(low), all_ranks(high)


def one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two arrays differ by exactly one inserted, deleted or replaced symbol."""
    if abs(len(a) - len(b)) > 1:
        return False
    m = min(len(a), len(b))
    other = np.flatnonzero(a[:m] != b[:m])
    p = int(other[0]) if len(other) else m
    if len(a) == len(b):
        return p < m and np.array_equal(a[p + 1 :], b[p + 1 :])
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return np.array_equal(longer[p + 1 :], shorter[p:])


def search(index: Index, queries: Words, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) pairs one edit apart that agree in the last ``exact[q]`` symbols of the query.

    ``at`` is the number of the query's symbols still to be matched.
    """
    found_q, found_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def symbol(q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return queries.symbols[queries.start[q] + at - 1]

    def alive(*state: np.ndarray) -> list[np.ndarray]:
        low, high = state[-2:]
        keep = low < high
        return [s[keep] for s in state]

    def near_end(q, at, low, high):
        """Long words with few candidates are compared here; the others go on."""
        direct = (high - low <= _FEW) & (at > _FAR)
        if direct.any():
            for i in np.flatnonzero(direct):
                for w in np.unique(index.word_at[low[i] : high[i]]):
                    if one_edit(queries.word(q[i]), index.words.word(w)):
                        found_q.append(q[i : i + 1])
                        found_w.append(np.array([w], np.int64))
            q, at, low, high = (s[~direct] for s in (q, at, low, high))
        return q, at, low, high

    def finish(q, at, low, high):
        """Searches without symbols left end at the delimiter before their word; the others go on."""
        done = at == 0
        if done.any():
            zero = np.zeros(int(done.sum()), np.int64)
            a, b = index.extend(zero, low[done], high[done])
            # Words are distinct: at most one.
            found_q.append(q[done][a < b])
            found_w.append(a[a < b])
        return tuple(s[~done] for s in (q, at, low, high))

    # The half that matches exactly.
    q = np.arange(len(queries.length))
    at = queries.length.copy()
    low, high = np.zeros(len(q), np.int64), np.full(len(q), index.delimiters, np.int64)
    ready = []
    while len(q):
        at_half = queries.length[q] - at == exact[q]
        ready.append([s[at_half] for s in (q, at, low, high)])
        q, at, low, high = (s[~at_half] for s in (q, at, low, high))
        low, high = index.extend(symbol(q, at), low, high)
        q, at, low, high = near_end(*alive(q, at - 1, low, high))
    if not ready:
        return found_q[0], found_w[0]
    q, at, low, high = (np.concatenate(parts) for parts in zip(*ready, strict=True))
    # The other half: searches without an error so far, and those with one.
    pool = [np.zeros(0, np.int64) for _ in range(4)]
    while len(q) or len(pool[0]):
        if len(pool[0]):
            pq, pat, plow, phigh = pool
            plow, phigh = index.extend(symbol(pq, pat), plow, phigh)
            pool = list(near_end(*finish(*alive(pq, pat - 1, plow, phigh))))
        if len(q):
            rest = at > 0
            here = np.where(rest, symbol(q, np.maximum(at, 1)), 0)
            lows, highs = index.extend_by_all(low, high)
            state, other = np.nonzero(lows < highs)
            word = (other > 0) & (other < index.sigma - 2) & (other != here[state])
            state, other = state[word], other[word]
            clow, chigh = lows[state, other], highs[state, other]
            one = rest[state]
            born = [
                (q[state[one]], at[state[one]] - 1, clow[one], chigh[one]),  # replaced
                (q[state], at[state], clow, chigh),  # inserted, unless it repeats the next symbol
            ]
            following = np.where(at > 1, symbol(q, np.maximum(at - 1, 1)), 0)
            gone = rest & (following != here)  # of equal symbols the last one is deleted
            born.append((q[gone], at[gone] - 1, low[gone], high[gone]))
            fresh = finish(*(np.concatenate(parts) for parts in zip(*born, strict=True)))
            pool = [np.concatenate(parts) for parts in zip(pool, near_end(*fresh), strict=True)]
            q, at, here = q[rest], at[rest], here[rest]
            low, high = lows[rest][np.arange(len(q)), here], highs[rest][np.arange(len(q)), here]
            q, at, low, high = near_end(*alive(q, at - 1, low, high))
    return np.concatenate(found_q), np.concatenate(found_w)


# --- dealing the vocabulary --------------------------------------------------------------------------------


def _half(length: Column) -> Column:
    return F.floor(length / 2)


def _keys(side: int, lengths: list[int], buckets: int) -> list[Column]:
    """Buckets where a word is indexed or searched: by the half that a word of each length has in common with it."""
    out = []
    for more in lengths:
        # Side 0 shares the first half, side 1 the second; a word of this length has its half at the same place.
        size = F.length("word") + more
        part = _half(size) if side == 0 else size - _half(size)
        half = F.substring(F.col("word"), F.lit(1), part) if side == 0 else F.substring(F.col("word"), F.greatest(F.length("word") - part + 1, F.lit(1)), part)
        out.append(F.pmod(F.xxhash64(F.lit(side), part, half), F.lit(buckets)) * 2 + side)
    return out


def deal(words: DataFrame, buckets: int, slice_words: int) -> DataFrame:
    """bucket, slice, searched, word, n: every word where it is indexed (searched is false) and where it is searched."""
    targets, searches = [], []
    for side in (0, 1):
        targets += _keys(side, [-1, 0, 1], buckets)
        searches += _keys(side, [0], buckets)
    indexed = words.select("word", "n", F.explode(F.array_distinct(F.array(*targets))).alias("bucket"))
    slices = indexed.groupBy("bucket").agg(F.ceil(F.count("*") / slice_words).cast("int").alias("slices"))
    # At most two rows per bucket number: 2 * MAX_BUCKETS.
    slices = F.broadcast(slices)
    indexed = indexed.join(slices, "bucket").withColumn("slice", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    searched = words.select("word", "n", F.explode(F.array(*searches)).alias("bucket")).join(slices, "bucket")
    searched = searched.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    columns = ["bucket", "slice", "searched", "word", "n"]
    return indexed.withColumn("searched", F.lit(False)).select(*columns).union(searched.withColumn("searched", F.lit(True)).select(*columns))


_NEAR = "word string, n_near bigint, best_n bigint, best string"


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, slice, searched: each word's near words of the slice, counted, and the most frequent one."""
    group, words, counts, index, ids = None, [], [], None, None
    waiting: list[str] = []

    def look(side: int) -> pa.RecordBatch:
        text = [w[::-1] for w in waiting] if side == 0 else waiting
        queries = Words(text, index.alphabet)
        first = queries.length // 2
        q, w = search(index, queries, first if side == 0 else queries.length - first)
        w = ids[w]
        if side == 1:
            # Pairs that share the first half, too, were found there.
            both = np.fromiter((words[b].startswith(waiting[a][: len(waiting[a]) // 2]) for a, b in zip(q.tolist(), w.tolist())), bool, len(q))
            q, w = q[~both], w[~both]
        n = np.array(counts, np.int64)
        # The most frequent first, then by code points; a word's first row is its best.
        order = np.lexsort((places[w], -n[w], q))
        q, w = q[order], w[order]
        start = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
        size = np.diff(np.append(start, len(q)))
        return pa.RecordBatch.from_arrays(
            [pa.array([waiting[i] for i in q[start]], pa.string()), pa.array(size, pa.int64()), pa.array(n[w[start]], pa.int64()), pa.array([words[i] for i in w[start]], pa.string())],
            names=["word", "n_near", "best_n", "best"],
        )

    places = None
    for batch in batches:
        bucket, part, searched = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1]) | (searched[1:] != searched[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if start == end:
                continue
            key = (int(bucket[start]), int(part[start]))
            if key != group:
                if waiting and index:
                    yield look(group[0] % 2)
                group, words, counts, index, waiting = key, [], [], None, []
            rows = batch.slice(start, end - start)
            text = rows.column(3).to_pylist()
            if not searched[start]:
                words += text
                counts += rows.column(4).to_pylist()
                continue
            if index is None and words:
                turned = [w[::-1] for w in words] if key[0] % 2 == 0 else words
                ids = np.array(sorted(range(len(turned)), key=turned.__getitem__), np.int64)
                index = Index([turned[i] for i in ids])
                places = np.empty(len(words), np.int64)
                places[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
            waiting += text
            while len(waiting) >= _AT_ONCE and index:
                more, waiting = waiting[_AT_ONCE:], waiting[:_AT_ONCE]
                yield look(key[0] % 2)
                waiting = more
    if waiting and index:
        yield look(group[0] % 2)


def near_words(words: DataFrame, slice_words: int = SLICE_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """word, n_near, best_n, best for the words (word, n; distinct) that have a near word."""
    size = words.count()
    buckets = min(MAX_BUCKETS, max(64, -(-2 * size // bucket_words)))
    dealt = deal(words, buckets, slice_words).repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "searched")
    found = dealt.mapInArrow(_near_words, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first")).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead. Counts grow tenfold at each step, so a few rounds of doubling end it."""
    ahead = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ahead.select(F.col("word").alias("at"), F.col("root").alias("next"))
        new = materialise(ahead.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ahead = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return ahead


def variants(docs: DataFrame, slice_words: int = SLICE_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root."""
    words = materialise(vocabulary(docs), "vocabulary")
    near = words.join(near_words(words, slice_words, bucket_words), "word", "left")
    has = F.col("best_n") >= FACTOR * F.col("n")
    table = materialise(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
        "near-words",
    )
    led = roots(table.filter("form IS NOT NULL"))
    return table.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(store.documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


def op11_sql() -> str:
    """The same by neighbourhoods of deletions, which is quadratic in nothing but costs a row per code point."""
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda x: xor(x >> 1, 3988292384 * (x & 1)))[1]"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
coded AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(digits), 2), lambda k:
    CAST(16 * (instr('0123456789ABCDEF', digits[k]) - 1) + instr('0123456789ABCDEF', digits[k + 1]) - 1 AS BIGINT))),
    lambda c, b: {step}), 4294967295) AS h FROM coded),
short AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM short WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS best_n FROM pairs GROUP BY word),
first AS (
  SELECT word, n_near, best_n, (SELECT min(p.other) FROM pairs p WHERE p.word = b.word AND p.n = b.best_n) AS best FROM best b),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
         CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN first USING (word)),
ways(word, place, depth) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL
  SELECT ways.word, form, depth + 1 FROM ways JOIN formed ON formed.word = ways.place WHERE form IS NOT NULL)
SELECT f.word, f.form, max_by(ways.place, ways.depth) AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN ways ON ways.word = f.word GROUP BY ALL"""
