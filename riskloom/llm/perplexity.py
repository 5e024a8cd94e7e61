"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's units are characters, in n-grams of four by default, one model per language. It is counted over
all trusted documents, and every document is scored whole. Grams of a block are folded in the task
that meets them; the counts of all blocks are joined by gram (sharded by its hash), turned into
probabilities from the unigrams up, and the probabilities of a block's grams are sent back to it, so
texts never move and no task holds the model (see ``store``).

A document is rejected when its log-perplexity lies beyond its language's threshold: a quantile over the
trusted documents of that language, plus their standard deviation: the model has learnt from them, so that
clean text that it has not seen lies somewhat higher. Short documents vary more, so the mean of the
language counts as ``PRIOR_CHARS`` further characters of each document.

Cases: a null text counts as empty; an empty text has no perplexity and is rejected; a null language is
the language ""; without trusted text of its language a document is kept, with no threshold; a null doc_id
is never trusted; repeated rows are judged each (and trusted each); extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

ORDER = 4
QUANTILE = 0.995
SPREADS = 1.0  # standard deviations of the language's trusted documents beyond the quantile
PRIOR_CHARS = 100
# Tables with a row per language are broadcast up to so many languages.
MAX_LANGUAGES = 10_000
_BEFORE = "\x02"  # stands before a text's first character
_GRID = 1000  # thresholds are found on a grid of log-perplexities
_PORTION = 1 << 20
_KEY = 0x9E3779B97F4A7C15


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """64-bit hash of each run of ``order`` code points."""
    n = len(codes) - order + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(order):
        h = h * np.uint64(_KEY) + codes[k : k + n] + np.uint64(1)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class GramIndex:
    """Numbers for hashes: a direct table, and a sorted list of those whose place was taken."""

    def __init__(self, expected: int = 1 << 14) -> None:
        self.keys = np.zeros(1, np.uint64)
        self.size = 0
        self._room(expected)

    def _room(self, n: int) -> None:
        self.bits = max(16, int(8 * n).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.extra = np.zeros(0, np.uint64)
        self.extra_ids = np.zeros(0, np.int64)
        if self.size:
            self._place(self.keys[: self.size], np.arange(self.size))

    def _place(self, keys: np.ndarray, ids: np.ndarray) -> None:
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        _, first = np.unique(slot, return_index=True)
        fits = np.zeros(len(keys), bool)
        fits[first] = self.slot[slot[first]] < 0
        self.slot[slot[fits]] = ids[fits]
        extra, extra_ids = np.append(self.extra, keys[~fits]), np.append(self.extra_ids, ids[~fits])
        order = np.argsort(extra)
        self.extra, self.extra_ids = extra[order], extra_ids[order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 if it has none."""
        ids = self.slot[hashes >> np.uint64(64 - self.bits)].astype(np.int64)
        other = np.flatnonzero((self.keys[ids] != hashes) | (ids < 0))
        ids[other] = -1
        if len(other) and len(self.extra):
            at = np.minimum(np.searchsorted(self.extra, hashes[other]), len(self.extra) - 1)
            ids[other] = np.where(self.extra[at] == hashes[other], self.extra_ids[at], -1)
        return ids

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Number new, distinct hashes."""
        ids = np.arange(self.size, self.size + len(keys))
        self.keys = np.concatenate((self.keys[: self.size], keys, np.zeros(1, np.uint64)))
        self.size += len(keys)
        if self.size << 3 > 1 << self.bits:
            self._room(2 * self.size)
        else:
            self._place(keys, ids)
        return ids


def _portions(texts: list[str], chosen: list[int], order: int) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """(code points with the padding, texts in them, number of characters of each), some at a time; long texts in parts."""
    pad = _BEFORE * (order - 1)
    held, rows, sizes, size = [], [], [], 0
    for i in chosen:
        text = texts[i]
        for start in range(0, len(text), _PORTION):
            before = text[start - order + 1 : start] if start else pad
            piece = text[start : start + _PORTION]
            if held and size + len(piece) > _PORTION:
                yield _codes(held), rows, np.array(sizes)
                held, rows, sizes, size = [], [], [], 0
            held.append(before + piece)
            rows.append(i)
            sizes.append(len(piece))
            size += len(piece)
    if held:
        yield _codes(held), rows, np.array(sizes)


def _codes(parts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _places(sizes: np.ndarray, order: int) -> np.ndarray:
    """Where the gram of each character begins."""
    return np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)) * (order - 1), sizes)


def _by_language(batch: pa.RecordBatch) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, lang in enumerate(batch.column(batch.schema.get_field_index("lang")).to_pylist()):
        out.setdefault(lang or "", []).append(i)
    return out


def _trusted(side: str):
    def load(block: int) -> set[int]:
        table = store.read_side(side, block, ["doc_id"])
        return set(table.column("doc_id").to_pylist()) if table is not None else set()

    return load


def _count(side: str, order: int):
    """Distinct grams of each block and language with their number in trusted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store.SideCache(_trusted(side))
        for block, batch in store.by_block(batches):
            trusted, texts = known.get(block), store.texts_of(batch)
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for lang, chosen in _by_language(batch).items():
                index, grams, counts = GramIndex(), [], np.zeros(0, np.int64)
                for codes, rows, sizes in _portions(texts, chosen, order):
                    places = _places(sizes, order)
                    hashes = _hashes(codes, order)[places]
                    found = index.find(hashes)
                    missing = np.flatnonzero(found < 0)
                    if len(missing):
                        keys, first = np.unique(hashes[missing], return_index=True)
                        index.add(keys)
                        new = codes[places[missing[first]][:, None] + np.arange(order)].astype("<u4")
                        text = new.tobytes().decode("utf-32-le", "surrogatepass")
                        grams += [text[i : i + order] for i in range(0, len(text), order)]
                        found[missing] = index.find(hashes[missing])
                        counts = np.append(counts, np.zeros(len(keys), np.int64))
                    own = np.repeat(np.array([ids[i] in trusted for i in rows]), sizes)
                    counts += np.bincount(found[own], minlength=index.size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                    names=[store.BLOCK, "lang", "gram", "n"],
                )

    return run


def _discount(c: Column) -> Column:
    return F.when(c <= 0, F.lit(0.0)).when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def _discounts(table: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 from the numbers of grams seen once to four times; one row per language."""
    n = {k: F.count_if(F.col("c") == k).cast("double").alias(f"n{k}") for k in range(1, 5)}
    counts = table.groupBy("lang").agg(*n.values())
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def rule(k: int) -> Column:
        value = k - (k + 1) * y * F.try_divide(f"n{k + 1}", f"n{k}")
        usable = (F.col("n1") > 0) & (F.col(f"n{k}") > 0) & (value > 0)
        return F.when(usable, F.least(value, F.lit(float(k)))).otherwise(F.lit(k / 2))

    return counts.select("lang", *[rule(k).alias(f"d{k}") for k in (1, 2, 3)])


def _per_language(table: DataFrame, languages: int) -> DataFrame:
    """A table with one row per language, so that a frequent language needs no task of its own."""
    return F.broadcast(table) if languages <= MAX_LANGUAGES else table


def gram_probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, log_p for grams with their count ``c`` in trusted text (0 for grams only met elsewhere).

    Lower orders count in how many ways a gram is continued to the left. A gram's context is looked up
    by a window over (language, context), which holds at most one row per character.
    """
    tables = {order: counts.select("lang", "gram", "c")}
    languages = counts.select("lang").distinct().count()
    for k in range(order - 1, 0, -1):
        shorter = tables[k + 1].select("lang", F.expr(f"substring(gram, 2, {k})").alias("gram"), "c")
        tables[k] = materialise(shorter.groupBy("lang", "gram").agg(F.count_if(F.col("c") > 0).alias("c")), f"grams{k}")
    # Below the unigrams: every character seen, and one that was not, alike.
    lower = tables[1].groupBy("lang").agg((1.0 / (F.count_if(F.col("c") > 0) + 1)).alias("p_lower")).withColumn("gram_lower", F.lit(""))
    for k in range(1, order + 1):
        context = Window.partitionBy("lang", "context")
        c = F.col("c")
        seen = tables[k].withColumn("context", F.expr(f"substring(gram, 1, {k - 1})")).withColumns({
            "total": F.sum("c").over(context),
            "t1": F.count_if(c == 1).over(context), "t2": F.count_if(c == 2).over(context), "t3": F.count_if(c >= 3).over(context),
        })
        weighed = seen.join(_per_language(_discounts(tables[k]), languages), "lang").withColumn("gram_lower", F.expr(f"substring(gram, 2, {k - 1})"))
        own = F.try_divide(F.greatest(c - _discount(c), F.lit(0.0)), "total")
        left = F.try_divide(F.col("d1") * F.col("t1") + F.col("d2") * F.col("t2") + F.col("d3") * F.col("t3"), "total")
        p = F.when(F.col("total") > 0, own + left * F.col("p_lower")).otherwise(F.col("p_lower"))
        table = weighed.join(lower, ["lang", "gram_lower"]).select("lang", "gram", p.alias("p"))
        if k < order:
            table = materialise(table, f"chances{k}")
        lower = table.select("lang", F.col("gram").alias("gram_lower"), F.col("p").alias("p_lower"))
    return table.select("lang", "gram", F.ln("p").alias("log_p"))


def _score(side: str, chances: str, order: int):
    def load(block: int) -> dict[str, tuple[GramIndex, np.ndarray]]:
        table = store.read_side(chances, block, ["lang", "gram", "log_p"])
        out = {}
        if table is None:
            return out
        frame = table.to_pandas()
        for lang, part in frame.groupby("lang"):
            hashes = _hashes(_codes(part["gram"].tolist()), order)[::order]
            hashes, first = np.unique(hashes, return_index=True)
            index = GramIndex(len(hashes))
            index.add(hashes)
            out[lang] = index, part["log_p"].to_numpy()[first]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, models = store.SideCache(_trusted(side)), store.SideCache(load)
        for block, batch in store.by_block(batches):
            trusted, model, texts = known.get(block), models.get(block), store.texts_of(batch)
            total = np.zeros(len(texts))
            for lang, chosen in _by_language(batch).items():
                for codes, rows, sizes in _portions(texts, chosen, order):
                    index, log_p = model[lang]
                    found = index.find(_hashes(codes, order)[_places(sizes, order)])
                    if (found < 0).any():
                        raise RuntimeError("a gram of this block is missing from its side table")
                    np.add.at(total, rows, np.add.reduceat(log_p[found], np.cumsum(sizes) - sizes))
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([x or "" for x in batch.column(batch.schema.get_field_index("lang")).to_pylist()], pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(total),
                    pa.array([i in trusted for i in ids]),
                ],
                names=["doc_id", "lang", "n_chars", "log_p", "trusted"],
            )

    return run


def classify(docs: DataFrame, trusted: DataFrame, order: int = ORDER, quantile: float = QUANTILE, spreads: float = SPREADS) -> DataFrame:
    """doc_id, lang, n_chars, log_perplexity, threshold, kept; ``trusted`` has the doc_id of the text to learn from."""
    rows = store.with_blocks(docs, "doc_id", "text", "lang")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), store.BLOCK)
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter(F.col("doc_id").isNotNull()).distinct()
    side = store.write_side(rows.select("doc_id", store.BLOCK).join(ids, "doc_id").distinct(), "trusted")
    grams = materialise(rows.mapInArrow(_count(side, order), f"{store.BLOCK} bigint, lang string, gram string, n bigint"), "grams")
    counts = materialise(grams.groupBy("lang", "gram").agg(F.sum("n").alias("c")), "counts")
    chances = materialise(gram_probabilities(counts, order), "chances")
    of_blocks = store.write_side(grams.select(store.BLOCK, "lang", "gram").join(chances, ["lang", "gram"]), "block-chances")
    scores = materialise(
        rows.mapInArrow(_score(side, of_blocks, order), "doc_id bigint, lang string, n_chars bigint, log_p double, trusted boolean"), "scores"
    )
    languages = scores.select("lang").distinct().count()
    means = scores.filter(F.col("trusted")).groupBy("lang").agg(F.try_divide(-F.sum("log_p"), F.sum("n_chars")).alias("mean"))
    prior = F.when(F.col("mean").isNull(), 0).otherwise(PRIOR_CHARS)
    smooth = F.try_divide(-F.col("log_p") + prior * F.coalesce("mean", F.lit(0.0)), F.col("n_chars") + prior)
    judged = scores.join(_per_language(means, languages), "lang", "left").withColumn("log_perplexity", F.when(F.col("n_chars") > 0, smooth))
    # Quantile and spread on a grid: counts per cell are exact whatever the order of rows.
    cells = judged.filter("trusted AND n_chars > 0").groupBy("lang", F.floor(F.col("log_perplexity") * _GRID).alias("cell")).agg(F.count("*").alias("n"))
    language = Window.partitionBy("lang")
    first, second = (F.sum(x).over(language) for x in (F.col("n") * F.col("cell"), F.col("n") * F.col("cell") * F.col("cell")))
    reached = cells.withColumns({"upto": F.sum("n").over(language.orderBy("cell")), "total": F.sum("n").over(language), "s1": first, "s2": second})
    spread = F.sqrt(F.greatest(F.col("s2") / F.col("total") - (F.col("s1") / F.col("total")) ** 2, F.lit(0.0)))
    beyond = reached.filter(F.col("upto") >= F.col("total") * quantile).withColumn("spread", spread)
    thresholds = beyond.groupBy("lang").agg(((F.min("cell") + 1 + spreads * F.max("spread")) / _GRID).alias("threshold"))
    kept = (F.col("n_chars") > 0) & F.coalesce(F.col("log_perplexity") <= F.col("threshold"), F.lit(True))
    return judged.join(_per_language(thresholds, languages), "lang", "left").select("doc_id", "lang", "n_chars", "log_perplexity", "threshold", kept.alias("kept"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id")


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(store.documents(spark, sf_dir), trusted_ids(spark, sf_dir))
