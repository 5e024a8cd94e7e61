"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: a text's words (A-Z lower-cased) give shingles, each shingle a 64-bit XXH64, and a bit of the
fingerprint is set when it is set in over half of the shingles' hashes.

Links: fingerprints that differ in at most r of 64 bits agree on at least b - r of b blocks of bits. For
every choice of b - r blocks, fingerprints are grouped by those blocks and compared in their group. Equal
fingerprints are one row from the start, so a group holds at most 2 ** (bits outside the blocks) rows,
whatever the number of copies. Within groups, 64 fingerprints form a word per bit position (their bit
planes). Comparing one fingerprint with 64 others is an XOR per plane whose result goes into vertical
counters by carry-save addition; once all counters of a word have passed r it is dropped.
Links of a group are reduced to a spanning forest where they arise, which keeps every connection.

Components: each fingerprint takes the smallest label of its neighbours, and labels are shortened along the
way (star contraction) until nothing changes; every round is written to the shared folder.

Cases: a null text has no words; a text without words has fingerprint zero and is linked like any other;
fewer words than a shingle make one shingle of them all; a null doc_id takes part, the component's id is
its smallest known doc_id, null if none is known; repeated rows give repeated results; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
BLOCKS = 8
# Comparisons of a word of 64 fingerprints that are under way at once.
_AT_ONCE = 1 << 17
_CHUNK = 1 << 16


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    import xxhash

    tokens = text.encode("utf-8").lower().split()  # bytes: only A-Z and only ASCII white space
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    return majority(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start : start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in store.texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def block_masks(radius: int, blocks: int) -> list[int]:
    """For every choice of blocks that may stay equal: a mask of their bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(bits[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, its component's first node) with the same components as the edges a-b."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int, lanes: np.ndarray) -> np.ndarray:
    """Lanes of each (query, word) pair that differ in at most ``radius`` bits.

    ``planes[p, w]`` has bit p of the 64 fingerprints of word w. Counters lie vertically: ``counter[k]`` has
    bit k of 64 counts; ``over`` marks counts beyond the radius for good.
    """
    size = max(1, int(radius).bit_length())
    out = np.zeros(len(query), np.uint64)
    live = np.arange(len(query))
    counter = np.zeros((size, len(query)), np.uint64)
    over = ~lanes
    limit = [(radius + 1) >> k & 1 for k in range(size + 1)]
    for p in range(BITS):
        bit = (query[live] >> np.uint64(p)) & np.uint64(1)
        carry = planes[p, word[live]] ^ (np.uint64(0) - bit)
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        # A count that reaches radius + 1 is out.
        if not limit[size]:
            reached = np.full(len(live), np.iinfo(np.uint64).max, np.uint64)
            for k in range(size):
                reached &= counter[k] if limit[k] else ~counter[k]
            over |= reached
        if p % 8 == 7:
            alive = over != np.iinfo(np.uint64).max
            if not alive.all():
                live, over, counter = live[alive], over[alive], counter[:, alive]
                if not len(live):
                    return out
    out[live] = ~over
    return out


def links_of_groups(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges among fingerprints of equal key; rows are sorted by key."""
    n = len(fps)
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(begins, n))
    several = np.repeat(sizes > 1, sizes)
    fps, sizes = fps[several], sizes[sizes > 1]
    n = len(fps)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group_end = np.repeat(np.cumsum(sizes), sizes)
    values = np.zeros(-(-n // 64) * 64, np.uint64)
    values[:n] = fps.view(np.uint64)
    table = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(table.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)[:, :, 0]
    row = np.arange(n)
    first, last = (row + 1) // 64, (group_end - 1) // 64
    counts = np.where(row + 1 < group_end, last - first + 1, 0)
    upto = np.cumsum(counts)
    edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    start, everything = 0, np.uint64(0xFFFFFFFFFFFFFFFF)
    while start < n:
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + _AT_ONCE, side="right")))
        some = row[start:end]
        repeat = counts[start:end]
        query = np.repeat(some, repeat)
        word = np.arange(int(repeat.sum())) + np.repeat(first[start:end] - (np.cumsum(repeat) - repeat), repeat)
        # Lanes after the query and inside its group.
        low = np.maximum(query + 1 - word * 64, 0).astype(np.uint64)
        high = np.minimum(group_end[query] - word * 64, 64)
        lanes = (everything << low) & np.where(high >= 64, everything, (np.uint64(1) << (high % 64).astype(np.uint64)) - np.uint64(1))
        hits = _within(planes, values[query], word, radius, lanes)
        found = np.flatnonzero(hits)
        for at in range(0, len(found), _CHUNK):
            part = found[at : at + _CHUNK]
            pair, lane = np.nonzero(np.unpackbits(hits[part].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            edges.append((fps[query[part[pair]]], fps[word[part[pair]] * 64 + lane]))
            if sum(len(a) for a, _ in edges) > 1 << 21:
                edges = [_forest(*map(np.concatenate, zip(*edges, strict=True)))]
        start = end
    return _forest(*map(np.concatenate, zip(*edges, strict=True)))


def link(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges a-b among distinct fingerprints (column ``fp``) that connect all within the radius."""
    masks = block_masks(radius, blocks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(fps), _CHUNK):
                part = fps[start : start + _CHUNK]
                for number, mask in enumerate(masks):
                    # The table's number is mixed into the key; fingerprints that only share a mixed key fail the comparison.
                    key = (part & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part.view(np.int64))], names=["key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy()))
            # The last group may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                a, b = links_of_groups(keys[:whole], fps[:whole], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            a, b = links_of_groups(keys, fps, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = distinct.select("fp").mapInArrow(deal, "key bigint, fp bigint")
    return dealt.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, label (smallest node reachable) for the nodes of the edges a-b; there are no more than ``rows`` edges, if that is known.

    Each round: every node learns the smallest label around it, then labels point to labels' labels.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", rows)
    # Edges are distinct, so their number and the exclusive or of their hashes tell whether a round has changed any.
    state = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b"))).alias("state")
    before = edges.agg(state).first()
    while True:
        # A star has no more edges than there were, the next ones one for each node besides.
        n = before["state"]["n"]
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node are tied to the smallest one around it.
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: neighbours below a node, and the node, are tied to the smallest of them.
        large = materialise(large.distinct(), "edges", n)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges", 2 * n)
        after = edges.agg(state).first()
        if after == before:
            break
        before = after
    label = edges.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    return label


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component_id for every document."""
    prints = materialise(fingerprints(docs, words), "fingerprints")
    # Copies fold here, in part before the shuffle; a fingerprint is a single row from now on.
    folded = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "folded")
    labels = components(link(folded, radius, blocks))
    labelled = materialise(
        folded.join(labels, folded["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "labels"
    )
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    member = labelled.join(smallest, "label").select("fp", "component_id")
    return prints.join(member, "fp").select("doc_id", "fp", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(store.documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
