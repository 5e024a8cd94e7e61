"""Document fingerprints from improbable features.

Every 64-byte window of a text has a Shannon entropy, kept as one of about a thousand levels. Levels are
ranked by how rare they are in the whole corpus. In each run of 64 successive windows the rarest one
(leftmost on ties) gets a point, and windows with at least 16 points are the text's features. A
feature sets five bits in a Bloom filter of 2048 bits; a filter takes 160 distinct features, then the
next one is chained on. Two fingerprints are as alike as their filters' bits overlap beyond chance,
taken over the best partner of each filter of the shorter chain.

Cases: a null text counts as empty; an empty text has no filter, is like another empty one (1) and
unlike all others (0); a text under 64 bytes is one feature; a text none of whose windows gets 16
points keeps its best one; equal texts have equal fingerprints in one run. Documents without id
come last in the order; rows with the same id are ordered by text; a single document is its own
successor. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import scratch_dir

WINDOW = 64
POINTS = 16
PER_FILTER = 160
FILTER_BYTES = 256
_FILTER_BITS = FILTER_BYTES * 8
_HASHES, _HASH_BITS = 5, 11
# Sum of c * log2(c) over a window's byte counts c, in whole steps: exact in any order of addition.
_STEPS = np.rint(64 * np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1))).astype(np.int32)
_STEP = np.diff(_STEPS, prepend=0).astype(np.int32)
_PER_LEVEL = 24
LEVELS = int(_STEPS[WINDOW]) // _PER_LEVEL + 1
_PORTION = 1 << 20


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level of each window of ``data``; 0 is the highest entropy.

    Sliding a window changes two byte counts. How often a byte occurs in the 64 positions from its
    place on, and up to its place, follows from comparing the text with itself at 63 shifts.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int32)
    onward, upto = np.ones(n, np.uint8), np.ones(n, np.uint8)
    same = np.empty(n, bool)
    for lag in range(1, WINDOW):
        equal = np.equal(data[:-lag], data[lag:], out=same[lag:]).view(np.uint8)
        onward[:-lag] += equal
        upto[lag:] += equal
    added, removed = np.cumsum(_STEP[upto]), np.cumsum(_STEP[onward])
    total = added[WINDOW - 1 :].copy()
    total[1:] -= removed[: n - WINDOW]
    return total // _PER_LEVEL


def _hash(windows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of 64 bytes."""
    words = np.ascontiguousarray(windows).view(np.uint64)
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _features(texts: Sequence[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the distinct features, by text and place."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    chosen = [np.zeros(0, np.int64)]
    n = len(data)
    if n >= WINDOW:
        level = entropy_levels(data)
        key = (ranks[level].astype(np.int64) << 40) | np.arange(len(level))
        room = np.repeat(starts + lengths, lengths) - np.arange(n)  # bytes up to the text's end
        key[room[: len(key)] < WINDOW] = np.iinfo(np.int64).max
        best, reach = key.copy(), 1
        while reach < WINDOW:
            np.minimum(best[:-reach], key[reach:] if reach == 1 else best[reach:], out=best[:-reach])
            reach *= 2
        runs = np.flatnonzero(room[: len(best)] >= 2 * WINDOW - 1)
        winner = best[runs] & ((1 << 40) - 1)
        if len(winner):
            first = np.flatnonzero(np.append(True, winner[1:] != winner[:-1]))
            points = np.diff(np.append(first, len(winner)))
            place = winner[first]
            owner = np.searchsorted(starts, place, side="right") - 1
            enough = points >= POINTS
            chosen.append(place[enough])
            lacking = np.setdiff1d(owner, owner[enough])
            for text in lacking.tolist():
                own = np.flatnonzero(owner == text)
                chosen.append(place[own[[np.argmax(points[own])]]])
        for text in np.flatnonzero((lengths >= WINDOW) & (lengths < 2 * WINDOW - 1)).tolist():
            start = starts[text]
            chosen.append(start + np.argmin(key[start : start + lengths[text] - WINDOW + 1], keepdims=True))
    place = np.sort(np.concatenate(chosen))
    hashes = _hash(data[place[:, None] + np.arange(WINDOW)]) if len(place) else np.zeros(0, np.uint64)
    owner = np.searchsorted(starts, place, side="right") - 1
    short = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
    if len(short):
        padded = np.frombuffer(b"".join(texts[i].ljust(WINDOW, b"\0") for i in short.tolist()), np.uint8)
        hashes = np.concatenate((hashes, _hash(padded.reshape(-1, WINDOW))))
        owner = np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    repeat = np.zeros(len(hashes), bool)
    repeat[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    return hashes[~repeat], owner[~repeat]


def digests(texts: Sequence[bytes], ranks: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(number of features, filters as rows of 64-bit words) of each text."""
    hashes, owner = _features(texts, ranks)
    counts = np.bincount(owner, minlength=len(texts))
    chains = -(-counts // PER_FILTER)
    base = np.cumsum(chains) - chains
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = base[owner] + place // PER_FILTER
    filters = np.zeros((int(chains.sum()), FILTER_BYTES), np.uint8)
    for k in range(_HASHES):
        bit = ((hashes >> np.uint64(k * _HASH_BITS)) % np.uint64(_FILTER_BITS)).astype(np.int64)
        np.bitwise_or.at(filters, (row, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
    words = filters.view(np.uint64)
    return [(int(c), words[b : b + k]) for c, b, k in zip(counts, base.tolist(), chains.tolist(), strict=True)]


def as_string(digest: tuple[int, np.ndarray]) -> str:
    return f"{digest[0]}:{digest[1].tobytes().hex()}"


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1: bits in common beyond chance, over those that could be."""
    one, two = sorted((a[1], b[1]), key=len)
    if not len(one):
        return 1.0 if not len(two) else 0.0
    theirs = np.bitwise_count(two).sum(1, dtype=np.int64)
    total = 0.0
    for row in one:
        own = int(np.bitwise_count(row).sum(dtype=np.int64))
        common = np.bitwise_count(row & two).sum(1, dtype=np.int64)
        chance = own * theirs / _FILTER_BITS
        most = np.minimum(own, theirs)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(most > chance, (common - chance) / (most - chance), common == most)
        total += float(np.clip(score, 0, 1).max())
    return total / len(one)


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level, 0 for the rarest, from the windows of every whole text."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for _, texts in _portions(iter([batch])):
                raw = [t.encode("utf-8") for t in texts]
                lengths = np.fromiter(map(len, raw), np.int64, len(raw))
                data = np.frombuffer(b"".join(raw), np.uint8)
                level = entropy_levels(data)
                room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))
                total += np.bincount(level[room[: len(level)] >= WINDOW], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(total)], names=["level", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tally, "level bigint, n bigint")
    totals = np.zeros(LEVELS, np.int64)
    for row in counted.groupBy("level").agg(F.sum("n").alias("n")).collect():  # one row per level
        totals[row["level"]] = row["n"]
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.argsort(totals, kind="stable")] = np.arange(LEVELS)
    return ranks


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Rows of successive batches as (ids, texts), a few at a time."""
    for batch in batches:
        has_id = batch.schema.get_field_index("doc_id")
        ids = batch.column(has_id).to_pylist() if has_id >= 0 else [None] * batch.num_rows
        texts, start, held = store.texts_of(batch), 0, 0
        for at, text in enumerate(texts):
            if held and held + len(text) > _PORTION:
                yield ids[start:at], texts[start:at]
                start, held = at, 0
            held += len(text)
        if start < len(texts):
            yield ids[start:], texts[start:]


def edited(text: str, successor: str) -> str:
    """The last third of the characters replaced by as many first ones of the successor."""
    third = len(text) // 3
    return text[: len(text) - third] + successor[:third]


_COLUMNS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
_PLACED_SQL = _COLUMNS + ", part bigint, first_text string, last_text string"
_ROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_PLACED = _ROW.append(pa.field("part", pa.int64())).append(pa.field("first_text", pa.string())).append(pa.field("last_text", pa.string()))


def _compare(ids: list, texts: list[str], successors: list[str], ranks: np.ndarray, following: bool) -> dict[str, list]:
    """Rows for texts with their successors; ``following``: successors are the texts one further on."""
    changed = [edited(t, s).encode("utf-8") for t, s in zip(texts, successors, strict=True)]
    own = [*texts, successors[-1]] if following else [*texts, *successors]
    all_digests = digests([*(t.encode("utf-8") for t in own), *changed], ranks)
    n = len(texts)
    mine, after = all_digests[:n], all_digests[1 : n + 1] if following else all_digests[n : 2 * n]
    new = all_digests[len(own) :]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed],
        "fingerprint": [as_string(d) for d in mine],
        "edited_fingerprint": [as_string(d) for d in new],
        "near_edited": [likeness(a, b) for a, b in zip(mine, new, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(mine, after, strict=True)],
    }


def compare_with_successors(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and its successor by descending doc_id.

    One range shuffle of the texts puts nearly all successors beside their documents; only the last
    document of each partition meets the first one of the next in a second, small step.
    """
    spark, ranks = docs.sparkSession, rarity_ranks(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held_ids, held, opening = TaskContext.get().partitionId(), [], [], None

        def emit(rows: dict[str, list], **more: list) -> pa.RecordBatch:
            n = len(rows["doc_id"])
            rows = {**{f.name: [None] * n for f in _PLACED}, **rows, "part": [part] * n, **more}
            return pa.RecordBatch.from_pydict(rows, schema=_PLACED)

        for ids, texts in _portions(batches):
            if opening is None:
                opening = texts[0]
            ids, texts = held_ids + ids, held + texts
            if len(texts) > 1:
                yield emit(_compare(ids[:-1], texts[:-1], texts[1:], ranks, True))
            held_ids, held = ids[-1:], texts[-1:]
        if held:
            yield emit({"doc_id": held_ids}, first_text=[opening], last_text=held)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict(
                    _compare([row["doc_id"]], [row["last_text"]], [row["first_text"]], ranks, False), schema=_ROW
                )

    order = [F.desc_nulls_last("doc_id")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_dir(spark, "fingerprints")
    # The filters are sparse: zstd halves what they take on disk.
    rows.repartitionByRange(*order).sortWithinPartitions(*order, F.desc_nulls_last("text")).mapInArrow(run, _PLACED_SQL).write.option(
        "compression", "zstd"
    ).parquet(path)
    placed = spark.read.schema(_PLACED_SQL).parquet(path)
    ends = placed.filter(F.col("last_text").isNotNull())
    parts = sorted(row["part"] for row in ends.select("part").collect())  # one per partition
    if not parts:
        return placed.select(*_ROW.names)
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part bigint, next_part bigint")
    firsts = ends.select(F.col("part").alias("next_part"), "first_text")
    last = ends.select("doc_id", "part", "last_text").join(follows, "part").join(firsts, "next_part")
    closing = last.select("doc_id", "last_text", "first_text").mapInArrow(finish, _COLUMNS)
    return placed.filter(F.col("last_text").isNull()).select(*_ROW.names).unionByName(closing)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_successors(store.documents(spark, sf_dir))
