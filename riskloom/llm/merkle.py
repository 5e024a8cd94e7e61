"""Merkle manifest of a dataset, with proofs made by multiproofs of whole leaf partitions.

Every row is a leaf, every language a tree of arity 8 over its leaves by doc_id, and one more tree of that kind stands over
the languages' roots. Leaves are numbered by one range shuffle of digests (texts never move), then packed into aligned
partitions of 8 ** 4 consecutive leaves of a tree. A partition is folded on its own up to one node; what remains is a tree
with a 4096th of the nodes, folded the same way.

Proofs are an octopus multiproof per leaf partition. The partition knows its leaves, so ``missing_nodes`` gives the least
set of coordinates (level, place) that no known node leads to. These are fetched once, by one join of the requests
with the stored nodes and one row back per partition; nodes that several proofs share are derived once inside the partition;
each leaf's own proof is then read off locally. A selection of leaves is proven the same way (``selected``).

Cases: null values are hashed as ``-``; rows without language are a tree of their own, the first; rows without doc_id come
first in their tree and are never tampered with; rows with one doc_id are ordered by leaf, and equal leaves are
interchangeable, so the result as a set of rows is determined. A tree of one leaf is that leaf. A table without rows has no
root and gives no rows. Texts are hashed whole, wherever they lie. Columns other than the five hashed ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

ARITY = 8
# Levels folded inside one partition of leaves.
LEVELS = 4
# Up to so many trees their proofs are broadcast (some KB each); beyond, they are joined.
FEW_TREES = 4096
TAMPERED_EACH = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes of a tree of n leaves at a level."""
    return -(-n // ARITY**level)


def height(n: int) -> int:
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def missing_nodes(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The least coordinates (level, place) that lead from the known leaves of a tree of n to its root."""
    out, level, have = [], 0, set(known)
    while width(n, level) > 1:
        runs = {i // ARITY for i in have}
        for run in sorted(runs):
            whole = range(ARITY * run, min(ARITY * (run + 1), width(n, level)))
            out += [(level, i) for i in whole if i not in have]
        have, level = runs, level + 1
    return out


class Part:
    """A leaf partition: consecutive leaves of a tree, and all nodes that they lead to by themselves."""

    def __init__(self, n: int, first: int, leaves: list[str], most: int, base: int = 0) -> None:
        # ``base`` is the level at which these "leaves" stand; n counts nodes at that level. ``most`` levels are folded.
        self.n, self.first, self.base = n, first, base
        self.levels = [leaves]
        while width(n, len(self.levels) - 1) > 1 and len(self.levels) <= most:
            row = self.levels[-1]
            self.levels.append([digest("".join(row[i : i + ARITY])) for i in range(0, len(row), ARITY)])

    def nodes(self) -> Iterator[tuple[int, int, str]]:
        for level, row in enumerate(self.levels):
            start = self.first // ARITY**level
            for i, node in enumerate(row):
                yield self.base + level, start + i, node

    def walks(self, fetched: dict[tuple[int, int], str]) -> Iterator[list[tuple[str, str]]]:
        """For each leaf the siblings before and after it, level by level to the root."""
        known = {(level - self.base, i): node for level, i, node in self.nodes()} | fetched
        sides: dict[tuple[int, int], tuple[str, str]] = {}
        top = height(self.n)

        def side(level: int, i: int) -> tuple[str, str]:
            found = sides.get((level, i))
            if found is None:
                start = i - i % ARITY
                stop = min(start + ARITY, width(self.n, level))
                found = ("".join(known[level, k] for k in range(start, i)), "".join(known[level, k] for k in range(i + 1, stop)))
                if level:  # a leaf's own sides are used once
                    sides[level, i] = found
            return found

        def climb(level: int, i: int) -> None:
            """Interior nodes above the partition, derived once from fetched ones."""
            while level < top:
                if (level, i) not in known:
                    start = i * ARITY
                    known[level, i] = digest("".join(known[level - 1, k] for k in range(start, min(start + ARITY, width(self.n, level - 1)))))
                level, i = level + 1, i // ARITY

        if top > len(self.levels) - 1:
            climb(len(self.levels), self.first // ARITY ** len(self.levels))
        for k in range(len(self.levels[0])):
            i = self.first + k
            yield [side(level, i // ARITY**level) for level in range(top)]


def climbed(leaf: str, walk: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings fold to."""
    for before, after in walk:
        leaf = digest(before + leaf + after)
    return leaf


# --- leaves ------------------------------------------------------------------------------------------------


def _value(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    parts = [_value(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*parts, _value(text)), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree, digest, and the digest as presented after tampering."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EACH == 0, F.lit(False))
    text = F.col("text").cast("string")
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # The mark keeps the null language apart from the empty one, and before it.
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        _leaf(text).alias("digest"),
        F.when(tampered, _leaf(F.translate(text, _UPPER, _LOWER))).alias("presented"),
    )
    return found.withColumn("presented", F.coalesce("presented", "digest"))


# --- trees -------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Trees by name: their leaf partitions, the nodes above them, and their roots (tree, n, digest)."""

    parts: DataFrame
    nodes: DataFrame
    roots: DataFrame
    levels: int


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``place``, the row's number in its tree, and ``n``, the rows of the tree."""
    # Where a file's row lies breaks ties, so equal rows are spread over range partitions too.
    rows = materialise(rows, "leaves").select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__row"))
    by = ["tree", *order, "__row"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()).drop("__row")
    ranged = materialise(ranged.withColumn("__part", F.shiftright("__at", 33)), "ranged")
    # One row per tree and partition that has some of it.
    counts = ranged.groupBy("tree", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("tree")).alias("n"))
    found = ranged.join(starts, ["tree", "__part"])
    return found.withColumn("place", F.col("__before") + F.col("__at") - F.col("__first")).drop("__part", "__at", "__first", "__before")


def _packed(rows: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """One row per leaf partition, its entries in order."""
    entry = F.struct("place", "digest", *payload)
    return rows.groupBy("tree", "n", F.floor(F.col("place") / ARITY**levels).alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


_NODES = "tree string, n bigint, level int, place bigint, digest binary"


def _fold(base: int, inner: bool, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                n = width(row["n"], base)
                part = Part(n, row["part"] * ARITY**levels, [e["digest"].hex() for e in row["entries"]], levels, base)
                found = list(part.nodes())
                # The leaves' own levels are derived again where they are needed; only their top is stored.
                found = [f for f in found if f[0] > base] if inner else found[-1:]
                out += [(row["tree"], row["n"], level, place, bytes.fromhex(node)) for level, place, node in found]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["tree", "n", "level", "place", "digest"])

    return run


def _width(level: int) -> Column:
    return F.ceil(F.col("n") / ARITY**level)


def build(rows: DataFrame, order: list[str], payload: list[str], levels: int = LEVELS) -> Tree:
    """Trees over rows (tree, digest, payload); leaves ascend by ``order``."""
    parts = materialise(_packed(_placed(rows, order), payload, levels), "leaf-parts")
    nodes = tops = materialise(parts.select("tree", "n", "part", "entries").mapInArrow(_fold(0, False, levels), _NODES), "nodes")
    level, largest = levels, parts.agg(F.max("n")).first()[0] or 0
    while width(largest, level) > 1:
        again = tops.filter((F.col("level") == level) & (_width(level) > 1)).select("tree", "n", "place", "digest")
        tops = materialise(_packed(again, [], levels).mapInArrow(_fold(level, True, levels), _NODES), "nodes")
        nodes, level = nodes.unionByName(tops), level + levels
    # Folding ends at one node, so only the root stands so high.
    roots = nodes.filter("place = 0 AND n <= shiftleft(1L, 3 * level)").select("tree", "n", "digest")
    return Tree(parts, nodes, materialise(roots, "roots"), levels)


_REQUEST = "tree string, part bigint, level int, place bigint"


def _requests(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, part, n, size = (batch.column(k).to_pylist() for k in range(4))
            starts = [p * ARITY**levels for p in part]
            out = [(t, p, level, place) for t, p, m, a, s in zip(tree, part, n, starts, size) for level, place in missing_nodes(range(a, a + s), m)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.string(), pa.int64(), pa.int32(), pa.int64()))], names=["tree", "part", "level", "place"])

    return run


def with_fetched(tree: Tree, parts: DataFrame | None = None) -> DataFrame:
    """Leaf partitions with the nodes they miss; what they can derive is not fetched."""
    parts = tree.parts if parts is None else parts
    asked = parts.select("tree", "part", "n", F.size("entries").alias("size")).mapInArrow(_requests(tree.levels), _REQUEST)
    stored = tree.nodes.select("tree", "level", "place", "digest")
    found = asked.join(stored, ["tree", "level", "place"]).groupBy("tree", "part").agg(F.collect_list(F.struct("level", "place", "digest")).alias("fetched"))
    return parts.join(found, ["tree", "part"], "left")


def _part_of(row: dict, levels: int) -> tuple[Part, dict[tuple[int, int], str]]:
    part = Part(row["n"], row["part"] * ARITY**levels, [e["digest"].hex() for e in row["entries"]], levels)
    return part, {(f["level"], f["place"]): f["digest"].hex() for f in row["fetched"] or ()}


_PATH = "array<struct<before:string,after:string>>"


def _paths(levels: int):
    """The way of each tree's root through the tree above."""
    path = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, walks = [], []
            for row in batch.to_pylist():
                part, fetched = _part_of(row, levels)
                for entry, walk in zip(row["entries"], part.walks(fetched), strict=True):
                    members.append(entry["member"])
                    walks.append([{"before": a, "after": b} for a, b in walk])
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.string()), pa.array(walks, path)], names=["member", "path"])

    return run


_PROOF = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())]
)
_PROOF_SQL = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(wanted: bool, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                part, fetched = _part_of(row, levels)
                above = [(s["before"], s["after"]) for s in row["path"]]
                tail = "".join(a + b for a, b in above)
                subroot = row["subroot"].hex()
                root = climbed(subroot, above)
                out = []
                for entry, walk in zip(row["entries"], part.walks(fetched), strict=True):
                    if wanted and not entry["wanted"]:
                        continue
                    folded = climbed(climbed(entry["presented"].hex(), walk), above)
                    proof = digest("".join(a + b for a, b in walk) + tail)
                    out.append((entry["doc_id"], entry["digest"].hex(), subroot, root, proof, folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out) if out else [()] * len(_PROOF), _PROOF)], schema=_PROOF)

    return run


def manifest(docs: DataFrame, selected: DataFrame | None = None, levels: int = LEVELS, few: int = FEW_TREES) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, or of those with selected doc_ids."""
    rows = leaves(docs)
    payload = ["doc_id", "presented"]
    if selected is not None:
        ids = selected.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("wanted", F.lit(True))
        rows = rows.join(ids, "doc_id", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
        payload.append("wanted")
    tree = build(rows, ["doc_id", "digest"], payload, levels)
    over = build(tree.roots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest"), ["member"], ["member"], levels)
    paths = with_fetched(over).select("n", "part", "entries", "fetched").mapInArrow(_paths(levels), f"member string, path {_PATH}")
    ends = materialise(tree.roots.select("tree", F.col("digest").alias("subroot")).join(paths.withColumnRenamed("member", "tree"), "tree"), "tree-paths")
    parts = tree.parts if selected is None else tree.parts.filter(F.exists("entries", lambda e: e["wanted"]))
    # Partitions of one large tree would meet at its name, so the few rows of the trees are sent to them.
    ends = F.broadcast(ends) if ends.limit(few + 1).count() <= few else ends
    ready = with_fetched(tree, parts).join(ends, "tree")
    return ready.select("n", "part", "entries", "fetched", "subroot", "path").mapInArrow(_prove(selected is not None, levels), _PROOF_SQL)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(store.documents(spark, sf_dir))


OP13_SQL = """
WITH RECURSIVE bytes AS (
  SELECT doc_id, source, lang, n_chars, text,
         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS codes
  FROM documents),
crc AS (
  SELECT *, xor(list_reduce(codes, lambda c, b: {step}, 4294967295), 4294967295) AS crc FROM bytes),
texts AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN translate(text, '{upper}', '{lower}') ELSE text END AS shown
  FROM crc),
coded AS (
  SELECT doc_id, lang, {head} AS head, {text} AS tail, {shown} AS shown FROM texts),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(head || tail) AS leaf, sha256(head || shown) AS shown FROM coded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes(tree, level, place, node) AS (
  SELECT tree, 0, place, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)) FROM nodes
  WHERE tree IN (SELECT tree FROM nodes GROUP BY tree HAVING count(*) > 1) GROUP BY tree, level + 1, place // 8),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
subroots AS (
  SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM nodes JOIN heights USING (tree) WHERE level = height),
above(level, place, node) AS (
  SELECT 0, place, subroot FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)) FROM above
  WHERE (SELECT count(*) FROM above) > 1 GROUP BY level + 1, place // 8),
top AS (SELECT max(level) AS height FROM above),
root AS (SELECT node AS root FROM above, top WHERE level = height),
steps AS (
  SELECT tree, level, place, node FROM nodes
  UNION ALL
  SELECT NULL, level, place, node FROM above),
sides AS (
  SELECT a.tree, a.level, a.place,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM steps a JOIN steps b ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.place // 8 = b.place // 8
  GROUP BY a.tree, a.level, a.place),
walk(doc_id, tree, level, place, folded, siblings) AS (
  SELECT doc_id, tree, 0, place, shown, '' FROM placed
  UNION ALL
  SELECT w.doc_id, w.tree, w.level + 1, w.place // 8, sha256(s.before || w.folded || s.after), w.siblings || s.before || s.after
  FROM walk w JOIN sides s ON s.tree = w.tree AND s.level = w.level AND s.place = w.place
  JOIN heights h ON h.tree = w.tree WHERE w.level < h.height),
climb(doc_id, tree, level, place, folded, siblings) AS (
  SELECT w.doc_id, w.tree, 0, r.place, w.folded, w.siblings
  FROM walk w JOIN heights h ON h.tree = w.tree AND h.height = w.level JOIN subroots r ON r.tree = w.tree
  UNION ALL
  SELECT c.doc_id, c.tree, c.level + 1, c.place // 8, sha256(s.before || c.folded || s.after), c.siblings || s.before || s.after
  FROM climb c JOIN sides s ON s.tree IS NULL AND s.level = c.level AND s.place = c.place, top t WHERE c.level < t.height),
ends AS (SELECT c.* FROM climb c, top t WHERE c.level = t.height)
SELECT n.doc_id, n.leaf, s.subroot, r.root, sha256(e.siblings) AS proof_sha256, e.folded AS folded_root, e.folded = r.root AS verified
FROM ends e JOIN placed n ON n.tree = e.tree AND n.doc_id IS NOT DISTINCT FROM e.doc_id JOIN subroots s ON s.tree = n.tree, root r
"""


def op13_sql() -> str:
    """The manifest in SQL; doc_ids are distinct there, as in the tables."""
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda x: xor(x >> 1, 3988292384 * (x & 1)))[1]"

    def value(name: str) -> str:
        return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"

    head = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return OP13_SQL.format(step=step, upper=_UPPER, lower=_LOWER, head=head, text=value("text"), shown=value("shown"))
