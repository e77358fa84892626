"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue (operator 13).

A text is cut into pre-tokens by the vocabulary's pattern. Within a pre-token
the pair of neighbours whose joined bytes have the lowest rank merges first, the
leftmost of equals, until no pair has a rank. Pairs wait in one bucket for each
rank; a bitmap of three levels of 64-bit words tells which buckets hold any, so
three find-first-set steps give the next rank whatever the length. Tokens are
nodes of a linked list over byte positions, so a merge costs two new pairs; a
pair that a merge has overtaken stays in its bucket and is skipped when its turn
comes. A pre-token of n bytes thus costs about n steps, not n squared. Pre-tokens
never touch, so many are merged in one queue, and frequent ones are remembered.

A null text reads as empty and has no ids; names of special tokens in a text are
plain text; rows that repeat are encoded each; an empty table gives no rows; other
columns are kept where ``carry`` names them, whatever their names.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Bytes of different pre-tokens that share a queue.
QUEUE_BYTES = 1 << 18
#: Pre-tokens that each of the two generations of a worker's memory holds.
MEMORY = 300_000
#: Longer pre-tokens are not remembered.
REMEMBERED = 64
#: Bytes of text, or of ids, of an output batch.
STRETCH = 1 << 21

LITTLE = sys.byteorder == "little"


class RankQueue:
    """Buckets of places by rank, and which ranks have one: three levels of 64-bit words."""

    def __init__(self):
        self.low, self.middle, self.top = [0] * 4096, [0] * 64, 0
        self.buckets: dict[int, list[int]] = {}

    def put(self, rank: int, places: list[int]) -> None:
        """Adds ``places`` to the bucket of ``rank``."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += places
            return
        self.buckets[rank] = places
        word, upper = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.middle[upper] |= 1 << (word & 63)
        self.top |= 1 << upper

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank and its places, which leave; -1 when all are gone."""
        if not self.top:
            return -1, []
        upper = (self.top & -self.top).bit_length() - 1
        words = self.middle[upper]
        word = upper << 6 | ((words & -words).bit_length() - 1)
        bits = self.low[word]
        rank = word << 6 | ((bits & -bits).bit_length() - 1)
        self.low[word] = bits = bits & (bits - 1)
        if not bits:
            self.middle[upper] = words = words & (words - 1)
            if not words:
                self.top &= self.top - 1
        return rank, self.buckets.pop(rank)


class Vocabulary:
    """Ranks of byte strings, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << 18:
            raise ValueError("the queue holds ranks below 262144")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a rank")
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_pairs = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each (non-empty) word, as little-endian 32-bit numbers."""
        raw = b"".join(words)
        n, known, rank_of = len(raw), self.ranks, self.ranks.get
        codes = np.frombuffer(raw, np.uint8)
        starts = np.cumsum([0, *map(len, words)])
        edge = bytearray(n + 1)
        np.frombuffer(edge, np.uint8)[starts] = 1

        pair = np.full(n, -1, np.int32)
        pair[:-1] = self.of_pairs[codes[:-1].astype(np.int32) << 8 | codes[1:]]
        pair[starts[1:] - 1] = -1
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0):].astype(np.int32)
        present, begins = np.unique(pair[order], return_index=True)
        # the first places of a rank are listed when its turn comes
        waiting = dict(zip(present.tolist(), zip(begins.tolist(), [*begins[1:].tolist(), len(order)])))
        queue = RankQueue()
        put, take, buckets = queue.put, queue.take, queue.buckets
        for rank in waiting:
            put(rank, [])

        # lists are faster, arrays hold a very long pre-token in a tenth of the memory
        after, before, rank_at = range(1, n + 1), range(-1, n), pair.tolist()
        after, before = (list(after), list(before)) if n <= 2 * QUEUE_BYTES else (array("i", after), array("i", before))
        if n > 2 * QUEUE_BYTES:
            rank_at = array("i", pair.tobytes())
        while True:
            rank, bucket = take()
            if rank < 0:
                break
            if rank in waiting:
                begin, end = waiting.pop(rank)
                bucket += order[begin:end].tolist()
            bucket.sort()
            for at, i in enumerate(bucket):
                if rank_at[i] != rank:
                    continue  # stale: a merge has overtaken this pair
                gone = after[i]
                upto = after[i] = after[gone]
                rank_at[gone] = -1
                before[upto] = i
                lower = False
                if edge[upto]:
                    rank_at[i] = -1
                else:
                    new = rank_at[i] = rank_of(raw[i:after[upto]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            put(new, [i])
                            lower = new < rank
                if not edge[i]:
                    p = before[i]
                    new = rank_at[p] = rank_of(raw[p:upto], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(p)
                        else:
                            put(new, [p])
                            lower = lower or new < rank
                if lower:  # the rest of this rank waits
                    if at + 1 < len(bucket):
                        put(rank, bucket[at + 1:])
                    break

        out = []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            ids, i = array("I"), start
            while i < end:
                j = after[i]
                ids.append(known[raw[i:j]])
                i = j
            out.append(ids.tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes())
        return out

    def encode(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each word; a word that is a token by itself is that token."""
        queued, size = [], 0
        held: list[bytes | None] = []
        for word in words:
            known = self.ranks.get(word)
            if known is not None or not word:
                held.append(b"" if known is None else known.to_bytes(4, "little"))
                continue
            held.append(None)
            queued.append(word)
            size += len(word)
            if size >= QUEUE_BYTES:
                yield from self._settle(held, queued)
                held, queued, size = [], [], 0
        yield from self._settle(held, queued)

    def _settle(self, held: list[bytes | None], queued: list[bytes]) -> Iterator[bytes]:
        merged = iter(self.merge(queued) if queued else ())
        for ids in held:
            yield next(merged) if ids is None else ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


class Encoder:
    """Ids of texts, with a memory of pre-tokens in two generations: the older
    goes when the newer is full, and what is still in use moves on."""

    def __init__(self, vocabulary_: Vocabulary, pattern: str, memory: int = MEMORY):
        import regex
        self.vocabulary, self.split, self.memory = vocabulary_, regex.compile(pattern).findall, memory
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [self.split(t) for t in texts]
        known, different = self.newer, set().union(*words)
        new = [w for w in different if w not in known]
        if len(known) + len(new) > self.memory:
            self.older, known = known, {}
            new = list(different)
        kept = {w: ids for w in new if (ids := self.older.get(w)) is not None}
        known |= kept
        if kept:
            new = [w for w in new if w not in kept]
        for word, ids in zip(new, self.vocabulary.encode([w.encode() for w in new])):
            known[word] = ids
        out = [b"".join(map(known.__getitem__, some)) for some in words]
        # a few texts may have very many
        self.newer = known if len(known) <= self.memory else {}
        for word in new:
            if len(word) > REMEMBERED:
                self.newer.pop(word, None)
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str, pattern: str) -> Encoder:
    """The worker's encoder: its memory of bounded size outlives a task, since most
    pre-tokens of the next one are known."""
    return Encoder(vocabulary(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", carry: list[str] | None = None,
           out_col: str = "ids") -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) and ``out_col`` (in place
    of any column of that name): the ids of each text, as little-endian 32-bit
    numbers in one binary value. ``path`` is a file of ranks, ``pattern`` cuts the
    text before the merges."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != out_col]
    given = docs.select(*carry, F.col(text_col).cast("string").alias(C.OWN + "text"))

    def texts(batches):
        encoder = encoder_of(path, pattern)
        for batch in batches:
            for part in C.slices(batch, C.OWN + "text", STRETCH):
                ids = pa.array(encoder(C.texts(part, C.OWN + "text")), pa.binary())
                yield C.with_column(part.drop_columns([C.OWN + "text"]), out_col, ids)

    return given.mapInArrow(texts, C.schema_with(docs, carry, out_col, "binary"))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", carry: list[str] | None = None,
           out_col: str = "raw") -> DataFrame:
    """The columns ``carry`` of ``encoded`` (all by default) and ``out_col``: the
    bytes that the ids in ``ids_col`` stand for; null ids give no bytes."""
    carry = [c for c in (encoded.columns if carry is None else carry) if c != out_col]
    given = encoded.select(*carry, F.coalesce(F.col(ids_col), F.lit(b"")).alias(C.OWN + "ids"))

    def numbers(batches):
        known = vocabulary(path)
        for batch in batches:
            for part in C.slices(batch, C.OWN + "ids", STRETCH):
                raw = pa.array([known.decode(i) for i in part.column(C.OWN + "ids").to_pylist()], pa.binary())
                yield C.with_column(part.drop_columns([C.OWN + "ids"]), out_col, raw)

    return given.mapInArrow(numbers, C.schema_with(encoded, carry, out_col, "binary"))


def numbers(encoded: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the binary ids of a column as array<long>."""
    order = [c for c in encoded.columns if c != ids_col]

    def listed(batches):
        for batch in batches:
            for part in C.slices(batch, ids_col, STRETCH):
                ids = [None if i is None else np.frombuffer(i, dtype="<u4") for i in part.column(ids_col).to_pylist()]
                yield C.with_column(part.drop_columns([ids_col]), ids_col, pa.array(ids, pa.list_(pa.int64())))

    return encoded.select(*order, ids_col).mapInArrow(
        listed, C.schema_with(encoded, order, ids_col, "array<bigint>")).select(*encoded.columns)


def tokenizer() -> tuple[str, str]:
    """The file of ranks and the pattern of the query's vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op13_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    ids = encode(C.table(spark, sf_dir, "documents"), path, pattern, carry=["doc_id"])
    return decode(ids, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"))
