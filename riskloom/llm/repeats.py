"""Exact removal of repeated passages with suffix buckets refined by bucket pointers.

Every byte position starts in the bucket of its 25-byte gram. The bucket of the 50 bytes from a position
on is refined from two such buckets: its own and that of the position 25 further on, whose identifier is
reused as it stands. A bucket knows the smallest doc_id that has a position in it; a position in a
bucket of a smaller document marks its 50 bytes for removal.

Only positions that can be in a shared bucket are refined. Of the 26 grams inside 50 bytes, the one with
the smallest hash stands for them; equal strings have the same one. Successive positions with the same
least gram form a run (13 positions on average), whose own bucket is again refined from the buckets of
its first and last position.

1. Blocks send their least grams and learn which occur in several documents.
2. They send the runs of these. A run that a smaller document has is removed as a whole. For the others only
   the smallest document of each run's bucket goes on, and only where the gram has other runs too:
   nowhere else can a smaller document have just a part of it.
3. These send the buckets of their single positions.
4. The texts are scanned once more and cut.

What blocks send is combined per block first, so a passage in a third of all documents is a row per block.
Texts stay where they are; only identifiers move (see ``store``). Later copies of a whole text are
taken out by digest at the start: all their bytes occur in the first copy.

Identifiers are 64-bit hashes: with a billion positions to refine, the chance of one false match is 3 %.
Grams travel as 32 bits beside the number of their part; a false match there only adds work.

Cases: a null text counts as empty; a text under 50 bytes is kept; a null doc_id counts as larger than all
others, and such documents do not remove each other's bytes, nor do rows with equal ids; an empty table
gives no rows; extra columns are ignored by ``repeats`` and kept by ``without_repeats``. Very long texts
are worked on in overlapping segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

LENGTH = 50
GRAM = LENGTH // 2
_SEGMENT = 1 << 19
# Rows of a block; a task holds some blocks' worth of identifiers.
ROWS = 4096
_NO_ID = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2 ** 64, made once per worker."""

    up: np.ndarray | None = None
    down: np.ndarray | None = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.up is None:
            n = 2 * (_SEGMENT + LENGTH)
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Identifier of the 25 bytes from each position on."""
    up, down = _Powers.get()
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(data * up[:n], out=total[1:])
    return _mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])


def _least(ids: np.ndarray) -> np.ndarray:
    """Smallest of the 26 identifiers from each position on."""
    width, reach = LENGTH - GRAM + 1, 1
    while 2 * reach <= width:
        ids = np.minimum(ids[:-reach], ids[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(ids[:-rest], ids[rest:]) if rest else ids


@dataclass
class _Segment:
    """Some texts, or part of a long one, with runs of positions that share their least gram."""

    ids: np.ndarray
    position: np.ndarray  # of each position with 50 bytes to come, in the segment
    row: np.ndarray
    offset: np.ndarray  # in the row's text
    run: np.ndarray  # first of each run among the positions
    value: np.ndarray  # least gram of each run


def _segments(texts: list[bytes], rows: list[int]) -> Iterator[_Segment]:
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row in rows:
        text = texts[row]
        for start in range(0, max(len(text) - LENGTH + 1, 0), _SEGMENT):
            piece = text[start : start + _SEGMENT + LENGTH - 1]
            if held and size + len(piece) > _SEGMENT:
                yield _segment(held)
                held, size = [], 0
            held.append((row, start, piece))
            size += len(piece)
    if held:
        yield _segment(held)


def _segment(pieces: list[tuple[int, int, bytes]]) -> _Segment:
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    lengths = np.array([len(p) for _, _, p in pieces])
    starts = np.cumsum(lengths) - lengths
    ids = gram_ids(data)
    least = _least(ids)
    counts = lengths - LENGTH + 1
    position = np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    row = np.repeat(np.array([r for r, _, _ in pieces]), counts)
    offset = position - np.repeat(starts - np.array([s for _, s, _ in pieces]), counts)
    least = least[position]
    run = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])))
    return _Segment(ids, position, row, offset, run, least[run])


def _keys(grams: np.ndarray, parts: int) -> np.ndarray:
    """A gram's part and 32 of its bits."""
    return (_mix(grams) % np.uint64(parts)) << np.uint64(32) | grams & np.uint64(0xFFFFFFFF)


def _buckets(segment: _Segment, p: np.ndarray) -> np.ndarray:
    """Identifier of the 50 bytes from each position on, from those of its gram and the gram after it."""
    return _mix(segment.ids[p] * np.uint64(0xC2B2AE3D27D4EB4F) + segment.ids[p + GRAM])


@dataclass
class _Runs:
    """Runs of a segment whose gram occurs in several documents."""

    number: np.ndarray
    first: np.ndarray  # as indexes among the segment's positions
    end: np.ndarray
    gram: np.ndarray
    bucket: np.ndarray
    row: np.ndarray


def _shared_runs(segment: _Segment, shared: np.ndarray, parts: int) -> _Runs:
    number = np.flatnonzero(_member(_keys(segment.value, parts), shared))
    first = segment.run[number]
    end = np.append(segment.run[1:], len(segment.position))[number]
    begin, last = _buckets(segment, segment.position[first]), _buckets(segment, segment.position[end - 1])
    bucket = _mix(_mix(begin + (end - first).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + last)
    return _Runs(number, first, end, segment.value[number], bucket, segment.row[first])


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _owners_of(values: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest document of each bucket, as far as it is known; else one larger than all."""
    buckets, owners = known
    if not len(buckets):
        return np.full(len(values), _NO_ID)
    at = np.minimum(np.searchsorted(buckets, values), len(buckets) - 1)
    return np.where(buckets[at] == values, owners[at], _NO_ID)


def _positions(runs: _Runs, chosen: np.ndarray) -> np.ndarray:
    """All positions of the chosen runs, as indexes."""
    sizes = (runs.end - runs.first)[chosen]
    return np.arange(int(sizes.sum())) + np.repeat(runs.first[chosen] - (np.cumsum(sizes) - sizes), sizes)


def _deal(parts: int, keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Keys and values by part; a key's part depends on it alone."""
    part = (_mix(keys) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        some = order[cuts[p] : cuts[p + 1]]
        if len(some):
            yield p, [x[some] for x in (keys, *values)]


def _array(blob: bytes | None, kind: type) -> np.ndarray:
    return np.frombuffer(blob or b"", kind)


class _Block:
    """The rows of a block that a batch holds."""

    def __init__(self, batch: pa.RecordBatch, copies: dict[bytes, int]) -> None:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        self.ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        self.texts = [t.encode("utf-8") for t in store.texts_of(batch)]
        # Later copies of a whole text take no part.
        self.copy = np.zeros(len(self.texts), bool)
        if copies:
            for i, text in enumerate(self.texts):
                if len(text) >= LENGTH:
                    first = copies.get(hashlib.sha256(text).digest())
                    self.copy[i] = first is not None and first < self.ids[i]
        self.rows = np.flatnonzero(~self.copy).tolist()

    def segments(self) -> Iterator[_Segment]:
        return _segments(self.texts, self.rows)


def _copies(side: str):
    def load(block: int) -> dict[bytes, int]:
        table = store.read_side(side, block, ["digest", "first"])
        if table is None:
            return {}
        return dict(zip(table.column("digest").to_pylist(), table.column("first").to_pylist(), strict=True))

    return load


def _shared(side: str):
    def load(block: int) -> np.ndarray:
        table = store.read_side(side, block, ["part", "grams"])
        if table is None:
            return np.zeros(0, np.uint64)
        rows = zip(table.column("part").to_pylist(), table.column("grams").to_pylist(), strict=True)
        return np.unique(np.concatenate([_array(blob, np.uint32).astype(np.uint64) | np.uint64(part << 32) for part, blob in rows]))

    return load


def _known(side: str, buckets: str = "buckets", owners: str = "owners"):
    """Buckets of a block in order, with their smallest documents."""

    def load(block: int) -> tuple[np.ndarray, np.ndarray]:
        table = store.read_side(side, block, [buckets, owners])
        if table is None:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([_array(b, np.uint64) for b in table.column(buckets).to_pylist()])
        values = np.concatenate([_array(b, np.int64) for b in table.column(owners).to_pylist()])
        keys, index = np.unique(keys, return_index=True)
        return keys, values[index]

    return load


def _edges(buckets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of rows sorted by bucket and document: those with a bucket's smallest, and its largest if it differs."""
    change = buckets[1:] != buckets[:-1]
    first, last = np.append(True, change)[: len(buckets)], np.append(change, True)[: len(buckets)]
    return first | (last & (ids != ids[np.flatnonzero(first)][np.cumsum(first) - 1]))


def _send_grams(copies: str, parts: int):
    """Pass 1: the least grams of each block, apart by whether the block has them in several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store.SideCache(_copies(copies))
        for block, batch in store.by_block(batches):
            held = _Block(batch, known.get(block))
            found = [(s.value, s.row[s.run]) for s in held.segments()]
            if not found:
                continue
            value, row = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(value, kind="stable")
            value, row = value[order], row[order]
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            last = np.append(first[1:], len(value)) - 1
            several = row[first] != row[last]
            for part, (grams, many) in _deal(parts, value[first], several):
                grams = grams.astype(np.uint32)  # the low bits
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "block": block, "once": np.sort(grams[~many]).tobytes(), "often": np.sort(grams[many]).tobytes()}]
                )

    return run


def _match_grams(table: pa.Table) -> pa.Table:
    """Which grams of a part occur in several documents, for each block that sent them."""
    once = [_array(b, np.uint32) for b in table.column("once").to_pylist()]
    often = [_array(b, np.uint32) for b in table.column("often").to_pylist()]
    values, counts = np.unique(np.concatenate([*once, *often, *often]), return_counts=True)
    shared = values[counts > 1]
    grams = [np.concatenate((o, a[_member(a, shared)])).tobytes() for a, o in zip(once, often, strict=True)]
    return pa.table({store.BLOCK: table.column("block"), "part": table.column("part"), "grams": pa.array(grams, pa.binary())})


def _send_runs(copies: str, shared: str, parts: int):
    """Pass 2: the buckets of runs of shared grams with the block's smallest and largest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, grams = store.SideCache(_copies(copies)), store.SideCache(_shared(shared))
        for block, batch in store.by_block(batches):
            of_block = grams.get(block)
            if not len(of_block):
                continue
            held = _Block(batch, known.get(block))
            found = [(r.gram, r.bucket, held.ids[r.row]) for r in (_shared_runs(s, of_block, parts) for s in held.segments())]
            if not found:
                continue
            gram, bucket, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((ids, bucket))
            gram, bucket, ids = gram[order], bucket[order], ids[order]
            keep = _edges(bucket, ids)
            for part, (some, buckets, owners) in _deal(parts, gram[keep], bucket[keep], ids[keep]):
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "block": block, "grams": some.tobytes(), "buckets": buckets.tobytes(), "owners": owners.tobytes()}]
                )

    return run


def _flat(table: pa.Table, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of the sending row, and the values of all rows in a row."""
    columns = [[_array(b, np.int64 if name == "owners" else np.uint64) for b in table.column(name).to_pylist()] for name in names]
    sender = np.repeat(np.arange(table.num_rows), [len(x) for x in columns[0]])
    return sender, [np.concatenate(c) for c in columns]


def _by_sender(table: pa.Table, sender: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """Values of each sending row, as binary columns."""
    order = np.argsort(sender, kind="stable")
    cuts = np.searchsorted(sender[order], np.arange(table.num_rows + 1))
    each = [order[cuts[i] : cuts[i + 1]] for i in range(table.num_rows)]
    return [pa.array([v[x].tobytes() for x in each], pa.binary()) for v in values]


def _match_runs(table: pa.Table) -> pa.Table:
    """For each block: runs that a smaller document has, and runs it has first but whose gram has other runs."""
    sender, (gram, bucket, owner) = _flat(table, "grams", "buckets", "owners")
    order = np.lexsort((owner, bucket, gram))
    sender, gram, bucket, owner = sender[order], gram[order], bucket[order], owner[order]
    new_gram = np.append(True, gram[1:] != gram[:-1])
    new_bucket = new_gram | np.append(True, bucket[1:] != bucket[:-1])
    least = owner[np.flatnonzero(new_bucket)][np.cumsum(new_bucket) - 1]
    number = np.cumsum(new_gram) - 1
    several = np.bincount(number[new_bucket])[number] > 1
    told, asked = owner > least, (owner == least) & several
    buckets, owners = _by_sender(table, sender[told], bucket[told], least[told])
    (open_,) = _by_sender(table, sender[asked], bucket[asked])
    return pa.table({store.BLOCK: table.column("block"), "buckets": buckets, "owners": owners, "open": open_})


def _open_runs(side: str):
    """Runs of a block whose positions are looked at one by one."""

    def load(block: int) -> np.ndarray:
        table = store.read_side(side, block, ["open"])
        return np.zeros(0, np.uint64) if table is None else np.unique(np.concatenate([_array(b, np.uint64) for b in table.column("open").to_pylist()]))

    return load


def _open_positions(segment: _Segment, ids: np.ndarray, shared: np.ndarray, parts: int, known, open_: np.ndarray):
    """(runs, those a smaller document has, positions of open runs as indexes)."""
    runs = _shared_runs(segment, shared, parts)
    whole = _owners_of(runs.bucket, known) < ids[runs.row]
    return runs, whole, _positions(runs, np.flatnonzero(~whole & _member(runs.bucket, open_)))


def _send_positions(copies: str, shared: str, runs: str, parts: int):
    """Pass 3: the buckets of the positions of open runs with the block's smallest and largest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copied, grams = store.SideCache(_copies(copies)), store.SideCache(_shared(shared))
        known, opened = store.SideCache(_known(runs)), store.SideCache(_open_runs(runs))
        for block, batch in store.by_block(batches):
            open_ = opened.get(block)
            if not len(open_):
                continue
            held, found = _Block(batch, copied.get(block)), []
            for segment in held.segments():
                _, _, at = _open_positions(segment, held.ids, grams.get(block), parts, known.get(block), open_)
                found.append((_buckets(segment, segment.position[at]), held.ids[segment.row[at]]))
            if not found:
                continue
            bucket, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((ids, bucket))
            bucket, ids = bucket[order], ids[order]
            keep = _edges(bucket, ids)
            for part, (buckets, owners) in _deal(parts, bucket[keep], ids[keep]):
                yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "buckets": buckets.tobytes(), "owners": owners.tobytes()}])

    return run


def _match_positions(table: pa.Table) -> pa.Table:
    """For each block, its buckets that a smaller document has, with the smallest one."""
    sender, (bucket, owner) = _flat(table, "buckets", "owners")
    order = np.lexsort((owner, bucket))
    sender, bucket, owner = sender[order], bucket[order], owner[order]
    first = np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]
    least = owner[np.flatnonzero(first)][np.cumsum(first) - 1]
    told = owner > least
    buckets, owners = _by_sender(table, sender[told], bucket[told], least[told])
    return pa.table({store.BLOCK: table.column("block"), "buckets": buckets, "owners": owners})


@dataclass(frozen=True)
class Sides:
    """What each block knows after three passes."""

    copies: str
    shared: str
    runs: str
    positions: str
    parts: int

    def spans(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[list[tuple[int, int]]]]]:
        """Last pass: batches with their texts in bytes and the runs of bytes to remove."""
        copied, grams = store.SideCache(_copies(self.copies)), store.SideCache(_shared(self.shared))
        known, opened = store.SideCache(_known(self.runs)), store.SideCache(_open_runs(self.runs))
        single = store.SideCache(_known(self.positions))
        for block, batch in store.by_block(batches):
            held, places = _Block(batch, copied.get(block)), {}
            for segment in held.segments() if len(known.get(block)[0]) or len(opened.get(block)) else ():
                runs, whole, at = _open_positions(segment, held.ids, grams.get(block), self.parts, known.get(block), opened.get(block))
                owner = _owners_of(_buckets(segment, segment.position[at]), single.get(block))
                marked = np.sort(np.concatenate((_positions(runs, np.flatnonzero(whole)), at[owner < held.ids[segment.row[at]]])))
                row, offset = segment.row[marked], segment.offset[marked]
                cuts = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row)) if len(row) else []
                for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                    places.setdefault(int(row[start]), []).append(offset[start:end])
            spans: list[list[tuple[int, int]]] = []
            for i, text in enumerate(held.texts):
                if held.copy[i]:
                    spans.append([(0, len(text))])
                elif i in places:
                    p = np.concatenate(places[i])
                    first = np.flatnonzero(np.append(True, np.diff(p) > LENGTH))
                    last = np.append(first[1:], len(p)) - 1
                    spans.append(list(zip(p[first].tolist(), (p[last] + LENGTH).tolist(), strict=True)))
                else:
                    spans.append([])
            yield batch, held.texts, spans


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in spans)]
    starts = [*(start for start, _ in spans), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, starts, strict=True))


def find_repeats(rows: DataFrame) -> Sides:
    """Passes 1 to 3 over doc_id, text and the block id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = materialise(
        rows.filter(F.octet_length("text") >= LENGTH).select(
            F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), store.BLOCK
        ),
        "digests",
    )
    several = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    of_blocks = keyed.select("digest", store.BLOCK).distinct()
    copies = store.write_side(of_blocks.join(several, "digest").select(store.BLOCK, "digest", "first"), "copies")
    # Parts of identifiers, so many that a part of all blocks' messages is about as large as a block's.
    parts = min(1 << 14, max(32, 2 * keyed.select(store.BLOCK).distinct().count()))
    source = rows.select("doc_id", "text", store.BLOCK)
    grams = source.mapInArrow(_send_grams(copies, parts), "part bigint, block bigint, once binary, often binary")
    shared = store.write_side(grams.groupBy("part").applyInArrow(_match_grams, f"{store.BLOCK} bigint, part bigint, grams binary"), "grams")
    runs = source.mapInArrow(_send_runs(copies, shared, parts), "part bigint, block bigint, grams binary, buckets binary, owners binary")
    matched = runs.groupBy("part").applyInArrow(_match_runs, f"{store.BLOCK} bigint, buckets binary, owners binary, open binary")
    of_runs = store.write_side(matched, "runs")
    single = source.mapInArrow(_send_positions(copies, shared, of_runs, parts), "part bigint, block bigint, buckets binary, owners binary")
    positions = store.write_side(
        single.groupBy("part").applyInArrow(_match_positions, f"{store.BLOCK} bigint, buckets binary, owners binary"), "positions"
    )
    return Sides(copies, shared, of_runs, positions, parts)


def _typed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed runs of every document."""
    rows = _typed(store.with_blocks(docs, "doc_id", "text", rows=ROWS))
    sides = find_repeats(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, spans in sides.spans(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([hashlib.sha256(kept(t, s)).hexdigest() for t, s in zip(texts, spans, strict=True)], pa.string()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(_SPAN)),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return rows.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    )


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for start, end in spans:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out, in whole characters; a text that goes entirely takes its row along."""
    # Neutral names, so that no column meets the block id's.
    neutral = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in neutral.items()])
    rows = _typed(store.with_blocks(renamed, *neutral.values(), rows=ROWS))
    sides, n_chars = find_repeats(rows), neutral.get("n_chars")
    schema = rows.drop(store.BLOCK).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, spans in sides.spans(batches):
            new = [kept(t, whole_characters(t, s)).decode("utf-8") for t, s in zip(texts, spans, strict=True)]
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name != store.BLOCK}
            columns["text"] = pa.array([t if o.is_valid else None for o, t in zip(columns["text"], new, strict=True)], pa.string())
            if n_chars:
                columns[n_chars] = pa.array([len(t) for t in new], pa.int64()).cast(columns[n_chars].type)
            stays = pa.array([bool(t) or not s for t, s in zip(new, spans, strict=True)])
            yield pa.RecordBatch.from_pydict(columns).filter(stays)

    return rows.mapInArrow(run, schema).select(*[F.col(n).alias(c) for c, n in neutral.items()])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(store.documents(spark, sf_dir)).drop("spans")
