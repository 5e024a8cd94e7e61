"""Sharding with a permutation-filled lookup table. DataFrame operations place the rows.

The table has a prime number of slots. Each shard has its own preference order over them: a start and a
step from digests of its name, walked modulo the prime, which visits every slot once. Shards take
turns; each claims its first slot that is still free, until none is left. All shards end up with the
same number of slots to within one, and when a shard goes, nearly all slots of the others stay.

The table has a fixed number of rows whatever the data (checked against ``MAX_SLOTS``), so it is
broadcast, and placing a row is one hash and one probe: no shuffle. Rows of one key share a shard, as
sharding by key means; ``spread`` adds a row digest for keys that are too frequent for one shard.

Cases: a null key has the digest of an empty string; equal keys have equal shards; extra columns are
kept, also those named like the helper columns; an empty table gives no rows; no shard is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
MAX_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and at most one per slot")
    if slots > MAX_SLOTS or not _is_prime(slots):
        raise ValueError(f"slots must be a prime of at most {MAX_SLOTS}")
    walks = []
    for name in shards:
        digest = hashlib.md5(name.encode("utf-8")).digest()
        walks.append([int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1 if slots > 2 else 1])
    owner, left = [-1] * slots, slots
    while True:
        for shard, walk in enumerate(walks):
            slot, step = walk
            while owner[slot] >= 0:
                slot = (slot + step) % slots
            owner[slot] = shard
            walk[0] = (slot + step) % slots
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS, spread: Column | None = None) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    if spread is not None:
        text = F.concat_ws(":", text, spread.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    owners = fill_table(shards, slots)
    return spark.createDataFrame(list(enumerate(owners)), "slot bigint, shard int")


def place(rows: DataFrame, key: Column, shards: Sequence[str] = SHARDS, slots: int = SLOTS, *, out: str = "shard", spread: Column | None = None) -> DataFrame:
    """Rows with the number of their shard in ``out``."""
    table = table_frame(rows.sparkSession, shards, slots)
    names = [c for c in rows.columns if c != out]
    # The row travels as one value, so its column names can't meet those of the table.
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), slot_of(key, slots, spread).alias("slot"))
    # The broadcast side has exactly ``slots`` rows.
    return packed.join(F.broadcast(table), "slot").select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("shard").alias(out))


def op5_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of each document, and its shard once the last of the shards has gone."""
    docs = store.documents(spark, sf_dir).select("doc_id", "source", slot_of(F.col("doc_id")).alias("slot"))
    return place(place(docs, F.col("doc_id")), F.col("doc_id"), SHARDS[:-1], out="shard_after")


def _list(owners: list[int]) -> str:
    return f"string_split('{','.join(map(str, owners))}', ',')"


def op5_sql() -> str:
    """The filled tables as lists; the filling itself is tested apart."""
    return f"""
WITH t AS MATERIALIZED (SELECT {_list(fill_table(SHARDS))} AS now, {_list(fill_table(SHARDS[:-1]))} AS later),
o AS (SELECT unnest(now) AS now, unnest(later) AS later, generate_subscripts(now, 1) - 1 AS slot FROM t),
d AS (SELECT doc_id, source, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents)
SELECT doc_id, source, slot, CAST(now AS INTEGER) AS shard, CAST(later AS INTEGER) AS shard_after FROM d JOIN o USING (slot)
"""
