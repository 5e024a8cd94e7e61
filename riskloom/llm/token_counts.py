"""Token counts through a digest cache.

A count depends only on the content and the tokenizer, so it is stored under both digests: SHA-256 of
the normalised text (null becomes empty; nothing else, since any other change could change the count)
and SHA-256 of the tokenizer's file. Documents are joined to the stored counts by digest; of the
contents that miss, one copy each is encoded and appended to the cache. Only digests move, the texts
of the copies to encode are met again in a second scan (see ``store``).

Cases: a null text counts as empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows give
repeated results; extra columns are ignored; an empty table gives no rows and leaves the cache as it is.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise, scratch_dir

CACHE_SCHEMA = "digest binary, version string, n_tokens bigint"
# Characters whose classes agree in every Unicode version in use: texts of these alone may be cut into pre-tokens here.
_PLAIN = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏ]")
# Pre-tokens whose counts a worker remembers; emptied when full. Results don't depend on it.
REMEMBERED = 150_000
PIECES_AT_ONCE = 4096
# Texts are counted together until they hold so many characters.
PORTION_CHARS = 4_000_000
_LOADED: dict[str, Counter] = {}


class Counter:
    """Token counts as the tokenizer's own library gives them."""

    def __init__(self, path: str, pattern: str) -> None:
        self._known: dict[str, int] = {}
        self._pattern = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._library = lambda texts: [len(ids) for ids in model.encode(list(texts), num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._library = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut = parts.get("pre_tokenizer") or {}
        if parts.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True):
            # Merges never cross pre-tokens, so counts of distinct pre-tokens add up to the text's count.
            self._pattern = regex.compile(pattern)
            self._added = [token["content"] for token in parts.get("added_tokens", [])]

    @classmethod
    def load(cls, path: str, pattern: str) -> Counter:
        if path not in _LOADED:
            _LOADED[path] = cls(path, pattern)
        return _LOADED[path]

    def _plain(self, text: str) -> bool:
        return self._pattern is not None and not _PLAIN.search(text) and not any(a in text for a in self._added)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        index: defaultdict[str, int] = defaultdict(count().__next__)
        uses = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self._plain(text):
                out[i] = self._library([text])[0]
                continue
            found = self._pattern.findall(text)
            uses.append((i, np.fromiter(map(index.__getitem__, found), np.int64, len(found))))
        known, missing = self._known, [piece for piece in index if piece not in self._known]
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = list(index)
        sizes: dict[str, int] = {}
        for start in range(0, len(missing), PIECES_AT_ONCE):
            part = missing[start : start + PIECES_AT_ONCE]
            sizes.update(zip(part, self._library(part), strict=True))
        each = np.fromiter((sizes[p] if p in sizes else known[p] for p in index), np.int64, len(index))
        if len(sizes) <= REMEMBERED:
            known.update(sizes)
        for i, use in uses:
            out[i] = each[use].sum()
        return out


def _encode_misses(side: str, path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.load(path, pattern)

        def wanted(block: int) -> set[bytes]:
            table = store.read_side(side, block, ["digest"])
            return set(table.column("digest").to_pylist()) if table is not None else set()

        def counted(digests: list[bytes], texts: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(counter.counts(texts), pa.int64())], names=["digest", "n_tokens"]
            )

        cache = store.SideCache(wanted)
        for block, batch in store.by_block(batches):
            misses = cache.get(block)
            digests, texts, held = [], [], 0
            for value in batch.column(batch.schema.get_field_index("text")):
                text = value.as_py() or ""
                digest = hashlib.sha256(text.encode("utf-8")).digest()
                if digest in misses:
                    misses.discard(digest)  # later copies of the block don't count again
                    digests.append(digest)
                    texts.append(text)
                    held += len(text)
                    if held > PORTION_CHARS:
                        yield counted(digests, texts)
                        digests, texts, held = [], [], 0
            yield counted(digests, texts)

    return run


def count_tokens(docs: DataFrame, tokenizer: str, pattern: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text; contents that are new to ``cache`` are added to it.

    ``tokenizer`` names a file that exists on the driver and every executor, ``cache`` a Parquet folder.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        version = hashlib.sha256(file.read()).hexdigest()
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache)

    def stored() -> DataFrame:
        table = spark.read.schema(CACHE_SCHEMA).parquet(cache)
        # Two runs at once may both add a content; its counts agree.
        return table.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    rows = store.with_blocks(docs, "doc_id", "text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = materialise(
        rows.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), store.BLOCK),
        "digests",
    )
    misses = keyed.groupBy("digest").agg(F.min(store.BLOCK).alias(store.BLOCK)).join(stored(), "digest", "left_anti")
    side = store.write_side(misses.select(store.BLOCK, "digest"), "misses")
    fresh = rows.select("text", store.BLOCK).mapInArrow(_encode_misses(side, tokenizer, pattern), "digest binary, n_tokens bigint")
    fresh.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(stored(), "digest").select("doc_id", "n_bytes", "n_tokens")


CONTEXT = 1024


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    cache = scratch_dir(spark, "token-cache")
    counted = count_tokens(store.documents(spark, sf_dir), public.path("byte_bpe_50k.json"), public.PATTERN, cache)
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)
