"""Row blocks of stored documents, and side tables that a task reads for its own block.

Several operators look at every text twice: first to say what they need to know about it, then,
once the answer is joined together, to use it. Shuffling the texts to their answers would move the
whole corpus. Instead every row gets a block id that depends only on its file and its place in that
file (so retries, other splits and lost executors see the same blocks), the small answers are
written to the shared folder by block, and the second scan reads the answers of its blocks there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import materialise, scratch_dir

BLOCK = "__block"
# Rows of a file that share side data; with texts of some KB a block is some tens of MB.
BLOCK_ROWS = 8192


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, reachable from Python tasks, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def with_blocks(docs: DataFrame, *columns: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """The named columns plus the block id; a frame that is no file scan is written to the shared folder first."""
    names = [F.col(f"`{c}`") for c in columns]
    block = F.xxhash64("_metadata.file_path", F.expr(f"_metadata.row_index div {int(rows)}")).alias(BLOCK)
    try:
        return docs.select(*names, block)
    except AnalysisException:
        return materialise(docs.select(*names), "documents").select(*names, block)


ROW = "__row"


def placed(docs: DataFrame) -> DataFrame:
    """All columns as ``doc``, plus block and row number, which together name a row; a frame that is no file scan is written first."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    block = F.xxhash64("_metadata.file_path", F.expr(f"_metadata.row_index div {BLOCK_ROWS}")).alias(BLOCK)
    row = F.col("_metadata.row_index").alias(ROW)
    try:
        return docs.select(doc, block, row)
    except AnalysisException:
        return materialise(docs, "documents").select(doc, block, row)


def write_side(df: DataFrame, purpose: str) -> str:
    """Write rows by block; the folder is read by ``read_side`` inside tasks."""
    path = scratch_dir(df.sparkSession, purpose)
    df.repartition(BLOCK).write.partitionBy(BLOCK).parquet(path)
    return path


def read_side(path: str, block: int, columns: list[str]) -> pa.Table | None:
    """The side rows of one block, None when it has none."""
    system, root = filesystem(f"{path}/{BLOCK}={block}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
    parts = []
    for file in sorted(files):
        with system.open_input_file(file) as handle:
            parts.append(pq.ParquetFile(handle).read(columns=columns))
    return pa.concat_tables(parts) if parts else None


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Cut batches into runs of one block."""
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(BLOCK)).to_numpy(zero_copy_only=False)
        start = 0
        for at in range(1, len(ids) + 1):
            if at == len(ids) or ids[at] != ids[start]:
                yield int(ids[start]), batch.slice(start, at - start)
                start = at


class SideCache:
    """Side data of the block at hand; a scan meets a block's rows together."""

    def __init__(self, load: Callable[[int], object]) -> None:
        self._load, self._block, self._value = load, None, None

    def get(self, block: int):
        if block != self._block:
            self._value = None
            self._block, self._value = block, self._load(block)
        return self._value


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer rows of text in the Arrow batches of what runs inside: each is held in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Files of a packed side table, each with the rows of many blocks.
PACKED_GROUPS = 512
GROUP = "__group"


def write_packed(df: DataFrame, purpose: str) -> str:
    """Write rows by groups of blocks, sorted by block; ``read_packed`` opens only the row groups of its block."""
    path = scratch_dir(df.sparkSession, purpose)
    grouped = df.withColumn(GROUP, F.pmod(F.col(BLOCK), F.lit(PACKED_GROUPS)))
    grouped.repartition(GROUP).sortWithinPartitions(GROUP, BLOCK).write.partitionBy(GROUP).option("parquet.block.size", 1 << 20).parquet(path)
    return path


def read_packed(path: str, block: int, columns: list[str]) -> pa.Table | None:
    """The side rows of one block, None when it has none."""
    system, root = filesystem(f"{path}/{GROUP}={block % PACKED_GROUPS}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
    parts = [pq.read_table(file, columns=columns, filters=[(BLOCK, "=", block)], filesystem=system, partitioning=None) for file in sorted(files)]
    return pa.concat_tables(parts) if parts else None
