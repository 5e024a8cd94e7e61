"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The distinct pre-tokens of a batch of texts are laid into one linked list of bytes, with no pair
across their borders. Every merge rank has a bucket of list positions whose pair merges at that
rank; a two-level bitmap marks the non-empty buckets, so find-first-set on the upper level and then
on a lower word gives the next rank at once. A whole bucket is merged in one go: entries that an
earlier merge made stale are skipped, and only the pairs beside the merged nodes go into new buckets.
A pre-token of n bytes causes O(n) bucket entries, so one of megabytes is no problem.

The order inside a pre-token is that of the plain rule (lowest rank first, leftmost first). A merge
whose result could form an even lower rank with a neighbour (known for each rank from the
vocabulary) is done for the leftmost position of each pre-token alone before the queue goes on.

Cases: a null text encodes as an empty one (no ids, digests of the empty string); a null doc_id stays
null; repeated rows give repeated results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store

_WORD = 64
# Texts are encoded together until they hold so many characters; a longer text goes alone.
BATCH_CHARS = 24_000_000
_LOADED: dict[tuple[str, str], Codec] = {}


class RankQueue:
    """Positions by rank; ``pop`` gives the lowest rank with all its positions."""

    def __init__(self, ranks: int) -> None:
        self._low = [0] * (ranks // _WORD + 1)
        self._high = 0
        self._buckets: list[list[np.ndarray]] = [[] for _ in range(ranks + 1)]

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        if not len(positions):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        buckets, low = self._buckets, self._low
        for i, rank in enumerate(ranks[starts[:-1]].tolist()):
            bucket = buckets[rank]
            if not bucket:
                word = rank // _WORD
                low[word] |= 1 << rank % _WORD
                self._high |= 1 << word
            bucket.append(positions[starts[i] : starts[i + 1]])

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self._high:
            return None
        word = (self._high & -self._high).bit_length() - 1
        bits = self._low[word]
        rank = word * _WORD + (bits & -bits).bit_length() - 1
        self._low[word] = bits & (bits - 1)
        if not self._low[word]:
            self._high &= self._high - 1
        bucket, self._buckets[rank] = self._buckets[rank], []
        return rank, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


class Codec:
    """Encoder and decoder for one vocabulary of tokens and ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:cut]] * self.size + ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        # The last key is larger than any that is looked up.
        self._keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self._merged = np.append(table[:, 1], -1).astype(np.int32)
        self._inverted = np.zeros(self.size, bool)
        left, right, merged = table[:, 0] // self.size, table[:, 0] % self.size, table[:, 1]
        self._inverted[left[merged < left]] = True
        self._inverted[right[merged < right]] = True
        # Bytes of all tokens in a row, for decoding.
        tokens = sorted((rank, token) for token, rank in ranks.items())
        self._length = np.zeros(self.size, np.int64)
        self._length[[rank for rank, _ in tokens]] = [len(token) for _, token in tokens]
        self._offset = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        """One codec per worker process and file of base64 tokens with their ranks."""
        if (path, pattern) not in _LOADED:
            with open(path, "rb") as lines:
                pairs = (line.split() for line in lines if line.strip())
                _LOADED[path, pattern] = cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)
        return _LOADED[path, pattern]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank at which two tokens merge, -1 for never."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._merged[at], -1)

    def merge(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids of each piece)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        # Position n is the border of every piece.
        token = np.append(self.bytes[data], -1)
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        ends = np.cumsum(lengths)[lengths > 0]
        after[ends - 1] = n
        before[np.append(0, ends[:-1])[: len(ends)]] = n
        pair = np.full(n + 1, -1, np.int32)
        inner = np.flatnonzero(after[:n] < n)
        bytewise = self._rank(np.repeat(self.bytes, 256), np.tile(self.bytes, 256)).astype(np.int32)
        pair[inner] = bytewise[data[inner].astype(np.int32) * 256 + data[inner + 1]]
        queue = RankQueue(self.size)
        first = inner[pair[inner] >= 0].astype(np.int32)
        queue.push(first, pair[first])
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[pair[at] == rank]  # the rest is stale
            if not len(at):
                continue
            rest = None
            if self._inverted[rank] and len(at) > 1:
                leftmost = np.append(True, piece[at[1:]] != piece[at[:-1]])
                at, rest = at[leftmost], at[~leftmost]
            elif len(at) > 1:
                chained = after[at[:-1]] == at[1:]
                if chained.any():  # a run of one token: every other position, from the left
                    begins = np.flatnonzero(np.append(True, ~chained))
                    place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
                    at = at[place % 2 == 0]
            gone = after[at]
            behind = after[gone]
            token[at] = rank
            pair[gone] = -1
            after[at] = behind
            before[behind] = at
            ahead = before[at]
            ahead = ahead[ahead < n]
            changed = np.concatenate((ahead, at))
            follower = after[changed]
            new = np.where(follower < n, self._rank(token[changed], token[follower]), -1).astype(np.int32)
            pair[changed] = new
            live = new >= 0
            if live.any():
                queue.push(changed[live], new[live])
            if rest is not None and len(rest):
                queue.push(rest, np.full(len(rest), rank, np.int32))
            token[gone] = -1
        kept = token[:n] >= 0
        return token[:n][kept], np.bincount(piece[kept], minlength=len(pieces))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row as unsigned 32-bit, number of ids of each text), without special tokens."""
        index: defaultdict[str, int] = defaultdict(count().__next__)
        uses, per_text = [], []
        for text in texts:
            found = self.pattern.findall(text)
            uses.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
            per_text.append(len(found))
        ids, sizes = self.merge([piece.encode("utf-8") for piece in index])
        use = np.concatenate(uses) if uses else np.zeros(0, np.int32)
        flat = ids[_ranges((np.cumsum(sizes) - sizes)[use], sizes[use])]
        upto = np.append(0, np.cumsum(sizes[use]))
        ends = np.cumsum(per_text, dtype=np.int64)
        return flat.astype("<u4"), np.diff(np.append(0, upto[ends]))

    def decode(self, ids: np.ndarray) -> bytes:
        return self._bytes[_ranges(self._offset[ids], self._length[ids])].tobytes()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges start..start+size, in a row."""
    begins = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - begins, sizes)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts, start, held = store.texts_of(batch), 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > BATCH_CHARS:
            yield batch.slice(start, at - start), texts[start:at]
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded_sha256 of every whole text.

    ``vocabulary`` names a file that exists on every executor. Map-only: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(vocabulary, pattern)
        for batch in batches:
            for part, texts in _portions(batch):
                ids, counts = codec.encode(texts)
                ends = np.cumsum(counts)
                each = [ids[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array([x.tobytes() for x in each], pa.binary()),
                        pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in each], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    coded = encode(store.documents(spark, sf_dir), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
