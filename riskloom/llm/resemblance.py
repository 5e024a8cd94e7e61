"""Near copies by an exact rule: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The first candidates are those of SimHash: the sets' fingerprints that differ in two bits or fewer, found by the search of ``simhash``. What
they link by the exact comparison needs no other candidate. SimHash can't find all pairs: at a similarity of 0.8 fingerprints differ in ten of
64 bits on average, and a search that far is no longer near-linear. The rest comes from signatures, which miss none. A set
is cut by the leading bits of its hashes into parts, one to two shingles to a part on average, and a part that isn't empty has a signature, that of all its
shingles. Sets of n and m shingles that are similar enough differ in at most (n + m) / 9 shingles, so in no more parts, and all
other parts are equal. The number of parts goes by the size class (a power of two) of the smaller set; a set that may be the larger one of a pair
across classes is cut for the class below, too. Signatures have one order: of those that differ, at most a quarter of n comes before the first
that is equal, so each set hands on that many and one, and two sets this similar meet in one. Unlike a single shingle, a part of several is hardly ever shared by chance,
so the number of sets that meet grows with the copies in a table and not with the square of its rows. The order puts parts of several shingles first, by their rarest
shingle, by counts in a table of fixed size; any order is right, this one keeps common passages away. The table has 2 ** 24 slots, each with a fine
level: a coarse one fills up with the input, and then rare and common shingles look alike. Sets with too few parts for that proof (short ones, by
chance) also hand on their rarest fifth (and one) of shingles, where others of their kind meet them. Equal word sequences are one node, folded before any signature is made.
Candidate pairs are first bounded by sketches: the numbers of shingles by the leading bits of their hashes, about four
to a number; the smaller numbers of two sketches sum to no less than what the sets have in common. Only pairs that can still be similar
are compared by their whole sets, so sets travel for few pairs.

A large group of near copies would have candidates in the square of its size. Signatures with few pairs to a row give them all in the first
round and are done with. In the others, while draws get rid of a tenth of the pairs, each
document is compared with up to eight documents drawn from those that it meets, and what is linked needs no
further comparison; then all pairs that meet there and are not linked yet are compared. A signature whose documents are all linked leaves the
rows for good, so rounds only read what is open. So the work
grows with the square of a group only for documents that share whole parts of rare text and aren't near copies.

Texts are the same words as in ``simhash`` and shingles are known by 64-bit hashes. Rows are known by their place, not by
doc_id: one row of each group is kept, that with the smallest doc_id (null last), of several the first by place. So rows without id
and rows that share one are judged like any other. Cases: fewer words than a shingle make one shingle of them all; texts without words
are copies of each other; a null text has no words; very long texts are whole sets; an empty table has no groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import simhash, store
from riskloom.session import materialise

WORDS = 5
# Similarity 4 / 5, in whole numbers.
PART, WHOLE = 4, 5
# Pairs to compare for each row of a signature; where it has more, documents are drawn first.
MANY = 4
# Slots of the table of counts, as a power of two, and how many travel together.
_SLOTS = 24
_RANGE = 1 << 16
# Rows of one key that are tried with each other before any set is read.
_NEAR = 64
# Documents that each document is compared with in a round of draws.
_DRAWS = 8
# What a part of one shingle adds to its level: it counts as 16 times more common.
_SINGLE = 64
# Shingles that a task hands on at once.
_PORTION = 1 << 18
ROW = store.ROW
_AT_ONCE = 1 << 20
_KEY = 0x9E3779B97F4A7C15


def shingle_set(tokens: list[bytes], words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    import xxhash

    if not tokens:
        return np.zeros(0, np.uint64)
    words = min(words, len(tokens))
    codes = np.array([xxhash.xxh64_intdigest(t) for t in tokens], np.uint64)
    n = len(codes) - words + 1
    h = np.full(n, words, np.uint64)
    for k in range(words):
        h = h * np.uint64(_KEY) + codes[k : k + n]
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h ^ (h >> np.uint64(32)))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _node(tokens: list[bytes]) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(tokens))).astype(np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles by slot, one per document, up to 255: the slots' ranges that aren't empty, packed."""
    counts, held, size = np.zeros(1 << _SLOTS, np.uint8), [], 0

    def add() -> None:
        slots, n = np.unique(np.concatenate(held), return_counts=True)
        counts[slots] = np.minimum(counts[slots] + n, 255)

    for batch in batches:
        for text in store.texts_of(batch):
            held.append(_slot(shingle_set(_words(text))))
            size += len(held[-1])
            if size > _PORTION:
                add()
                held, size = [], 0
    if held:
        add()
    table = counts.reshape(-1, _RANGE)
    for at in np.flatnonzero(table.any(axis=1)):
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(table[at], 1)])], names=["part", "counts"])


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range: the sum of each range's counts, as sixteenths of its binary logarithm."""

    def packed(part: int, total: np.ndarray) -> pa.RecordBatch:
        level = np.minimum(np.round(16 * np.log2(1 + total)), 255).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([level.tobytes()])], names=["part", "level"])

    part, total = None, np.zeros(_RANGE, np.int64)
    for batch in batches:
        for at, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            if at != part and part is not None:
                yield packed(part, total)
                total = np.zeros(_RANGE, np.int64)
            part = at
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
    if part is not None:
        yield packed(part, total)


def rarity(rows: DataFrame) -> np.ndarray:
    """For each slot of the hashes a level that grows with its number of shingles, one per document.

    Levels are fine and slots many, so that a common shingle still shows among the rare ones of its slot.
    """
    counts = rows.select("text").mapInArrow(_counted, "part int, counts binary")
    levels = counts.repartition("part").sortWithinPartitions("part").mapInArrow(_levels, "part int, level binary").toArrow()
    out = np.zeros(((1 << _SLOTS) // _RANGE, _RANGE), np.uint8)
    for at, level in zip(levels.column("part").to_pylist(), levels.column("level"), strict=True):
        out[at] = np.frombuffer(level.as_py(), np.uint8)
    return out.reshape(-1)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without their texts, with the node of the word sequence."""
    for batch in batches:
        nodes = [_node(_words(text)) for text in store.texts_of(batch)]
        kept = batch.select(["doc_id", store.BLOCK, ROW])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(nodes, pa.int64())], names=[*kept.schema.names, "node"])


def _open_nodes(side: str):
    def load(block: int) -> set[int]:
        table = store.read_packed(side, block, ["node"])
        return set(table.column("node").to_pylist()) if table is not None else set()

    return store.SideCache(load)


def _wanted(side: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Nodes that are wanted from each block, once, with their sets."""
    wanted = _open_nodes(side)
    for block, batch in store.by_block(batches):
        open_nodes = wanted.get(block)
        nodes, sets, held = [], [], 0
        for text in batch.column(batch.schema.get_field_index("text")) if open_nodes else []:
            tokens = _words(text.as_py() or "")
            node = _node(tokens)
            if node in open_nodes:
                open_nodes.discard(node)
                nodes.append(node)
                sets.append(shingle_set(tokens))
                held += len(sets[-1])
                if held > _PORTION:
                    yield nodes, sets
                    nodes, sets, held = [], [], 0
        yield nodes, sets


def _mixed(values: np.ndarray, salt: int) -> np.ndarray:
    h = (values + np.uint64(salt * _KEY & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _classes(n: int) -> list[tuple[int, int]]:
    """Bits of the parts that a set of n shingles is cut into, and in how many parts a similar set can differ at most.

    The class of its own size, and that of the smallest similar set, for which this one is the larger.
    """
    own, below = n.bit_length() - 1, (-(-PART * n // WHOLE)).bit_length() - 1
    return [(own, n // 4)] + ([(below, 2 * n // 9)] if below < own else [])


def signatures(hashes: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Keys of a set; similar sets share one or more."""
    rare = level[_slot(hashes)].astype(np.int64)
    keys = [np.zeros(0, np.uint64)]
    for bits, differ in _classes(len(hashes)) if len(hashes) else []:
        part = hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)
        begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        single = np.diff(np.append(begin, len(hashes))) == 1
        key = _mixed(np.add.reduceat(hashes, begin), bits)
        order = np.lexsort((key, np.minimum.reduceat(rare, begin) + _SINGLE * single))
        keys.append(key[order[: differ + 1]])
        if len(begin) <= differ:
            n = len(hashes)
            keys.append(_mixed(hashes[np.lexsort((hashes, rare))[: n - -(-PART * n // WHOLE) + 1]], 64 + bits))
    return np.concatenate(keys)


def _entries(levels, side: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for nodes, sets in _wanted(side, batches):
            keys = [signatures(h, level).view(np.int64) for h in sets]
            size = np.array([len(k) for k in keys], np.int64)
            columns = [np.concatenate([np.zeros(0, np.int64), *keys]), np.repeat(np.array(nodes, np.int64), size)]
            columns += [np.repeat(np.array([len(h) for h in sets], np.int32), size)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "n"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and node: one per node, those that fit another node's row of their key."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
        new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
        table, key = table.filter(pa.array(new)), key[new]
        # The last group may go on in the next batch.
        whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
        yield from _several(table.slice(0, whole))
        held = table.slice(whole).combine_chunks()
    if held is not None:
        yield from _several(held)


def _several(table: pa.Table) -> list[pa.RecordBatch]:
    """Rows whose key has another row that fits; in a key with many rows, all of them."""
    key, n = (table.column(c).to_numpy() for c in ("key", "n"))
    # Signatures have no place in their set: with a place of 0 the sizes alone decide.
    pos = table.column("pos").to_numpy() if "pos" in table.column_names else np.zeros(len(key), np.int32)
    good, ahead = np.zeros(len(key), bool), 0
    a = np.arange(len(key))
    while len(a):
        ahead += 1
        a = a[a + ahead < len(key)]
        a = a[key[a] == key[a + ahead]]
        if ahead > _NEAR:
            good |= np.isin(key, key[a])
            break
        fits = a[_may_fit(n[a], pos[a], n[a + ahead], pos[a + ahead])]
        good[fits] = good[fits + ahead] = True
    return table.filter(pa.array(good)).combine_chunks().to_batches()


def _may_fit(n: np.ndarray, pos: np.ndarray, m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles with a common one at these places can be similar enough."""
    most = np.minimum(pos, at).astype(np.int64) + 1 + np.minimum(n - pos - 1, m - at - 1)
    return (PART + WHOLE) * most >= PART * (n.astype(np.int64) + m)


def _fits(n: Column, m: Column) -> Column:
    """Whether sets of n and m shingles can be similar enough."""
    return (PART + WHOLE) * F.least(n, m) >= PART * (n + m)


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key, cut so that no key is in two tables."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key = table.column("key").to_numpy()
        # The last group may go on in the next batch.
        whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if whole:
            yield table.slice(0, whole)
        held = table.slice(whole).combine_chunks()
    if held is not None and len(held):
        yield held


def _unsettled(many: int):
    """Rows sorted by key and label: those whose key has several labels, and whether it has over ``many`` pairs of them to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches):
            key, label = table.column("key").to_numpy(), table.column("label").to_numpy()
            fresh = key[1:] != key[:-1]
            first = np.flatnonzero(np.append(True, fresh))
            rows = np.diff(np.append(first, len(key)))
            run = np.diff(np.flatnonzero(np.append(np.append(True, fresh | (label[1:] != label[:-1])), True)))
            others = np.repeat(rows, rows) - np.repeat(run, run)
            pairs = np.add.reduceat(others, first) // 2
            table = table.append_column("others", pa.array(others)).append_column("many", pa.array(np.repeat(pairs > many * rows, rows)))
            yield from table.filter(pa.array(others > 0)).combine_chunks().to_batches()

    return run


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and label: pairs of nodes with one key and different labels that can be similar enough."""
    for table in _whole_keys(batches):
        yield from _cross_pairs(table)


def _cross_pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    key, label, node, n = (table.column(c).to_numpy() for c in ("key", "label", "node", "n"))
    size = len(key)
    if not size:
        return
    fresh = key[1:] != key[:-1]
    group = np.flatnonzero(np.append(fresh, True)) + 1
    run = np.flatnonzero(np.append(fresh | (label[1:] != label[:-1]), True)) + 1
    row = np.arange(size)
    begin, end = run[np.searchsorted(run, row, side="right")], group[np.searchsorted(group, row, side="right")]
    start = 0
    upto = np.cumsum(end - begin)
    while start < size:
        done = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + _AT_ONCE, side="right")))
        counts = (end - begin)[start:stop]
        a = np.repeat(row[start:stop], counts)
        b = np.arange(int(counts.sum())) + np.repeat(begin[start:stop] - (np.cumsum(counts) - counts), counts)
        good = _may_fit(n[a], 0, n[b], 0)
        pairs = np.unique(np.sort(np.stack((node[a[good]], node[b[good]]), axis=1), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        start = stop


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Numbers of shingles by the leading bits of their hashes."""
    bits = max(5, int(len(hashes) // 4).bit_length())
    return np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u2")


def most_common(a: np.ndarray, b: np.ndarray) -> int:
    """No fewer than the two sets have in common."""
    size = min(len(a), len(b))
    a, b = (x.astype(np.int64).reshape(size, -1).sum(axis=1) for x in (a, b))
    return int(np.minimum(a, b).sum())


def _sets(side: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, sets in _wanted(side, batches):
            prints = np.array([simhash.majority(h) for h in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(prints), pa.array([sketch(h).tobytes() for h in sets], pa.binary()), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))],
                names=["node", "fp", "sketch", "shingles"],
            )

    return run


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave it open that the sets are similar enough."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, "<u2"), np.frombuffer(y, "<u2")
            good.append((PART + WHOLE) * most_common(x, y) >= PART * (int(x.sum(dtype=np.int64)) + int(y.sum(dtype=np.int64))))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar enough."""

    def with_both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
        x = sets.select(F.col("node").alias("a"), F.col(column).alias("x"))
        return pairs.join(x, "a").join(sets.select(F.col("node").alias("b"), F.col(column).alias("y")), "b").select("a", "b", "x", "y")

    possible = materialise(with_both(pairs, sets, "sketch").mapInArrow(_possible, "a bigint, b bigint"), "possible")
    # Only sets that a pair asks for are shuffled; the others stay where they are stored.
    asked = possible.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    few = sets.join(asked, "node", "left_semi")
    common = F.size(F.array_intersect("x", "y"))
    alike = (PART + WHOLE) * common >= PART * (F.size("x") + F.size("y"))
    # Two whole sets weigh like some 25 narrow rows.
    return materialise(with_both(possible, few, "shingles").filter(alike).select("a", "b"), "similar", 25 * possible.count())


def _simhash_pairs(sets: DataFrame, rows: int | None = None) -> DataFrame:
    """Candidates by SimHash: each node with the first one of its fingerprint, and the first ones of linked fingerprints."""
    first = materialise(sets.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints", rows)
    same = sets.select("node", "fp").join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    x, y = (first.select(F.col("fp").alias(side), F.col("first").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    linked = simhash.link(first).join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return same.filter("a <> b").union(linked)


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the label of their node; a node without one is its own."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    known = labels.select(F.col("node").alias("of"), F.col("label").alias("known"))
    return rows.join(known, F.col("node") == F.col("of"), "left").withColumn("label", F.coalesce("known", "node"))


def _drawn(open_rows: DataFrame, turn: int) -> DataFrame:
    """Each document with up to eight others, drawn from those that were drawn for its keys."""
    drawn = F.min_by(F.struct("node", "n", "label"), F.xxhash64("key", "node", F.lit(turn))).alias("other")
    met = open_rows.select("key", "node", "n", "label").join(open_rows.groupBy("key").agg(drawn), "key").filter("label <> other.label")
    met = met.filter(_fits(F.col("n"), F.col("other.n")))
    mixed = [F.xxhash64("node", "other.node", F.lit(turn), F.lit(draw)) for draw in range(_DRAWS // 2)]
    some = met.groupBy("node").agg(F.array(*[pick("other.node", m) for m in mixed for pick in (F.min_by, F.max_by)]).alias("others"))
    some = some.select("node", F.explode("others").alias("other"))
    return some.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def near_copies(docs: DataFrame) -> DataFrame:
    """Block and row, doc_id, component_id and kept for every row of ``store.placed``; a component's id is its smallest known doc_id."""
    # Every Python stage is written before this returns, so the setting holds for all of them.
    with store.small_batches(docs.sparkSession):
        return _near_copies(docs)


def _near_copies(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"), store.BLOCK, ROW)
    levels = docs.sparkSession.sparkContext.broadcast(rarity(rows))
    table = materialise(rows.mapInArrow(_nodes, f"doc_id bigint, {store.BLOCK} bigint, {ROW} bigint, node bigint"), "rows")
    known = table.count()
    places = materialise(table.groupBy("node").agg(F.min(store.BLOCK).alias(store.BLOCK)), "places", known)
    side = store.write_packed(places, "nodes")
    entries = rows.select("text", store.BLOCK).mapInArrow(_entries(levels, side), "key bigint, node bigint, n int")
    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    shared = materialise(dealt.mapInArrow(_shared, "key bigint, node bigint, n int"), "shared")
    side = store.write_packed(places.join(shared.select("node").distinct(), "node"), "shared-nodes")
    sets = materialise(rows.select("text", store.BLOCK).mapInArrow(_sets(side), "node bigint, fp bigint, sketch binary, shingles array<bigint>"), "shingles")
    labels, turn, before = None, 0, None
    found = _compared(_simhash_pairs(sets, sets.count()).distinct(), sets)
    if size := found.count():
        labels = materialise(simhash.components(found, size), "labels", 2 * size)
    open_rows, size = shared, shared.count()
    while True:
        open_rows = _labelled(open_rows, labels).select("key", "node", "n", "label").repartition("key").sortWithinPartitions("key", "label")
        open_rows = open_rows.mapInArrow(_unsettled(MANY), "key bigint, node bigint, n int, label bigint, others bigint, many boolean")
        # Rows whose key is settled never come back, as labels only merge.
        open_rows = materialise(open_rows, "open", size)
        size, many = open_rows.agg(F.count("*"), F.sum(F.when(F.col("many"), F.col("others")))).first()
        if not size:
            break
        # Another round of draws is worth its while if the last one has linked a tenth of what was left.
        last = not many or turn > 0 and (not linked or 10 * many > 9 * before)
        pairs = open_rows if last else open_rows.filter("not many")
        pairs = pairs.select("key", "node", "n", "label").repartition("key").sortWithinPartitions("key", "label").mapInArrow(_cross, "a bigint, b bigint")
        if not last:
            # All pairs of a key with few are compared now, and it is done with; only those with many go on.
            open_rows, before = open_rows.filter("many"), many
            pairs = pairs.union(_drawn(open_rows, turn))
        found, turn = _compared(pairs.distinct(), sets), turn + 1
        if linked := found.count():
            # What was linked before goes in as its stars.
            edges = found if labels is None else found.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
            linked += 0 if labels is None else labels.count()
            labels = materialise(simhash.components(edges, linked), "labels", 2 * linked)
        if last:
            break
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", store.BLOCK, ROW))
    nodes = table.groupBy("node").agg(first.alias("first"))
    nodes = materialise(_labelled(nodes, labels).select("node", "first", "label"), "nodes", known)
    member = nodes.join(nodes.groupBy("label").agg(F.min("first").alias("best")), "label").select("node", "best")
    found = table.join(member, "node")
    kept = (F.col(store.BLOCK) == F.col(f"best.{store.BLOCK}")) & (F.col(ROW) == F.col(f"best.{ROW}"))
    return found.select(store.BLOCK, ROW, "doc_id", F.col("best.doc_id").alias("component_id"), kept.alias("kept"))
