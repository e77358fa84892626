"""Tokens of two tokenizers aligned by interval coalescing (operator 11).

A text's tokens under two tokenizers, A and B, are intervals of bytes. All
intervals of many texts are sorted by start; the running maximum of the ends
says how far the tokens so far reach; where a token starts at that maximum, a
group ends, and within a group tokens overlap. Every A token of a group is
linked with every B token of it. An id pair's count is the number of documents
of the corpus that hold the pair linked; per document the links whose count is
the highest of their A id are told, and the sum of the counts.

Texts are encoded once. Their ids and group ends are stored, compressed, in
blocks of about ``BLOCK_TOKENS`` tokens with each block's different pairs; these
are summed over the corpus, and the sums go back to the blocks that asked, where
they meet the stored ids. A frequent pair is one row a block, not a row for each
document, and links are not expanded across documents. Nothing is broadcast.

A null or empty text, and one whose tokens do not spell it, has no tokens; names
of special tokens are plain text; rows that repeat are documents each; an empty
table gives no rows; other columns do not count, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Tokens of a block.
BLOCK_TOKENS = 3_000_000
#: Bytes of text that are encoded and aligned at a time.
STRETCH = 1 << 19
#: Links that are expanded at a time.
LINKS = 1 << 20
#: Different pairs of a task's block that are held before they are merged.
HELD = 1 << 19


# --- tokenizers ---------------------------------------------------------------

@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable Latin-1
    as it is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A, a byte-level one: ids of space and text.

    Where the file's merges are its tokens in order, as ranks are, ranks give the
    same ids in a third of the time; else the file's own library encodes.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as text:
            told = json.load(text)
        known, letters = told["model"]["vocab"], byte_alphabet()
        special = {t["content"] for t in told["added_tokens"]}
        self.tokens = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            if token not in special:
                self.tokens[i] = bytes(letters[c] for c in token)
        ranks = {raw: i for i, raw in enumerate(self.tokens) if raw}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in told["model"]["merges"]]
        split = told["pre_tokenizer"] or {}
        if (told["normalizer"] is None and told["post_processor"] is None and split.get("type") == "ByteLevel"
                and split["use_regex"] and not split["add_prefix_space"]
                and all(bytes([b]) in ranks for b in range(256)) and len(ranks) == 256 + len(merges)
                and all(known[m] == 256 + k for k, m in enumerate(merges))):
            import tiktoken
            encoding = tiktoken.Encoding("A", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [encoding.encode_to_numpy(t, disallowed_special=()) for t in texts]
        else:
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self.encode = lambda texts: [
                np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode([" " + t for t in texts])


class Pieces:
    """Tokenizer B, which puts the space in front itself."""

    SPACE = "▁"

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [b""] * self.model.get_piece_size()
        for i in range(len(self.tokens)):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.tokens[i] = bytes([int(piece[1:-1], 16)])
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.tokens[i] = piece.replace(self.SPACE, " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, path_b: str):
    return ByteLevel(path_a), Pieces(path_b)


# --- alignment ----------------------------------------------------------------

def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A and of B are the last of their kind in a group. Tokens of
    a kind follow each other without gaps from offset 0; ``ends_*`` ascend."""
    ends = np.concatenate([ends_a, ends_b])
    starts = np.concatenate([[0], ends_a[:-1], [0], ends_b[:-1]]) if len(ends_a) and len(ends_b) else ends[:0]
    kind = np.repeat([0, 1], [len(ends_a), len(ends_b)])
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    # a token that starts at the furthest end so far opens a group
    opens = np.ones(len(order), bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    group_a, group_b = group[:len(ends_a)], group[len(ends_a):]
    return np.append(group_a[1:] != group_a[:-1], True)[:len(group_a)], \
        np.append(group_b[1:] != group_b[:-1], True)[:len(group_b)]


@dataclass
class Aligned:
    """Tokens of several documents: ids, the document's number and whether the
    token is its kind's last in a group. Groups end with documents."""

    ids: tuple[np.ndarray, np.ndarray]
    lasts: tuple[np.ndarray, np.ndarray]
    counts: tuple[np.ndarray, np.ndarray]

    def __post_init__(self):
        self.docs = tuple(np.repeat(np.arange(len(n)), n) for n in self.counts)
        # groups are numbered alike on both sides
        self.groups = tuple(np.cumsum(last) - last for last in self.lasts)
        self.n_groups = int(self.lasts[0].sum())
        self.sizes = tuple(np.bincount(g, minlength=self.n_groups) for g in self.groups)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value for each A token, by document."""
        return np.bincount(self.docs[0], weights=values, minlength=len(self.counts[0])).astype(np.int64)

    def links(self) -> np.ndarray:
        """The links of each A token."""
        return self.sizes[1][self.groups[0]]

    def pairs(self):
        """(document, pair, times) of all links, about ``LINKS`` at a time; a
        token's links with several equal ids of its group are one with their number."""
        size_b = self.sizes[1]
        first_b = np.cumsum(size_b) - size_b
        ids_a, ids_b = (i.astype(np.int64) for i in self.ids)
        group_a, doc_a, links = self.groups[0], self.docs[0], self.links()
        upto = np.cumsum(links)
        at = 0
        while at < len(links):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, "right")))
            n = links[at:end]
            if end == at + 1 and n[0] > LINKS:  # one token against a huge group
                g = group_a[at]
                b, times = np.unique(ids_b[first_b[g]:first_b[g] + size_b[g]], return_counts=True)
                yield np.full(len(b), doc_a[at]), ids_a[at] << 32 | b, times
            else:
                of = np.repeat(np.arange(at, end), n)
                b = first_b[group_a[of]] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                yield doc_a[of], ids_a[of] << 32 | ids_b[b], np.ones(len(of), np.int64)
            at = end

    def texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        # where each token stands when groups follow each other, A first
        n_a, n_b = (np.cumsum(s) - s for s in self.sizes)
        place_a = np.arange(len(self.ids[0])) + n_b[self.groups[0]]
        place_b = np.arange(len(self.ids[1])) + (n_a + self.sizes[0])[self.groups[1]]
        shown = np.empty(len(place_a) + len(place_b), object)
        for place, ids, last, close in zip((place_a, place_b), self.ids, self.lasts, "|;"):
            names, inverse = np.unique(ids.astype(np.int64) << 1 | last, return_inverse=True)
            shown[place] = np.array([f"{k >> 1}{close if k & 1 else ','}" for k in names.tolist()], object)[inverse]
        ends = np.cumsum(self.counts[0] + self.counts[1])
        shown = shown.tolist()
        return ["".join(shown[s:e])[:-1] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def aligned(texts: list[str], a: ByteLevel, b: Pieces) -> Aligned:
    """The alignment of some texts; those that it cannot spell have no tokens."""
    ids: tuple[list, list] = ([], [])
    filled = [t for t in texts if t]
    encoded = iter(zip(a(filled), b(filled))) if filled else iter(())
    none = np.empty(0, np.uint32)
    for text in texts:
        ia, ib = next(encoded) if text else (none, none)
        raw = (" " + text).encode()
        if text and any(int(lengths(t)[i].sum()) != len(raw) or b"".join(map(t.tokens.__getitem__, i.tolist())) != raw
                        for t, i in ((a, ia), (b, ib))):
            ia = ib = none
        ids[0].append(ia)
        ids[1].append(ib)
    flat = tuple(np.concatenate([none, *side]).astype(np.int64) for side in ids)
    counts = tuple(np.array([len(one) for one in side], np.int64) for side in ids)
    # one line of bytes for all documents, so that a document's end is an end of both
    ends = tuple(np.cumsum(lengths(t)[f]) for t, f in zip((a, b), flat))
    return Aligned(flat, group_ends(*ends), counts)


def lengths(tokenizer) -> np.ndarray:
    if not hasattr(tokenizer, "lengths"):
        tokenizer.lengths = np.array([len(t) for t in tokenizer.tokens], np.int64)
    return tokenizer.lengths


# --- stored form --------------------------------------------------------------

ALIGNED = "id {id}, ids_a binary, ids_b binary, lasts_a binary, lasts_b binary"
BLOCKS = "block long, pairs binary, parcel binary"


def pack(part: pa.RecordBatch, found: Aligned) -> bytes:
    """The rows' ids and ends, compressed."""
    ends = [np.cumsum(n) for n in found.counts]

    def cut(values, side):
        return [values[e - n:e].tobytes() for e, n in zip(ends[side].tolist(), found.counts[side].tolist())]

    arrays = [pa.array(cut(found.ids[s].astype("<u4"), s), pa.binary()) for s in (0, 1)]
    arrays += [pa.array([np.packbits(np.frombuffer(x, bool)).tobytes() for x in cut(found.lasts[s], s)], pa.binary())
               for s in (0, 1)]
    batch = pa.RecordBatch.from_arrays([part.column("id"), *arrays],
                                       names=["id", "ids_a", "ids_b", "lasts_a", "lasts_b"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpack(parcel: bytes) -> tuple[pa.Array, Aligned]:
    """The ids of the rows and their alignment."""
    batch = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(parcel)).read_all().combine_chunks()
    ids = [[np.frombuffer(x, "<u4") for x in batch.column(c).to_pylist()] for c in ("ids_a", "ids_b")]
    counts = tuple(np.array([len(x) for x in side], np.int64) for side in ids)
    lasts = [[np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(batch.column(c).to_pylist(), counts[s])]
             for s, c in enumerate(("lasts_a", "lasts_b"))]
    whole = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts]).astype(kind)
    return batch.column("id").combine_chunks(), Aligned(
        tuple(whole(side, np.int64) for side in ids), tuple(whole(side, bool) for side in lasts), counts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, inverse = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pairs, np.bincount(inverse, weights=np.concatenate([n for _, n in parts]), minlength=len(pairs)).astype(np.int64)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          block_tokens: int = BLOCK_TOKENS) -> str:
    """The alignment of all documents as a table, whose name is returned (drop it when
    it is done with): rows of (block, pairs, parcel), where a parcel holds the ids and
    group ends of some documents and ``pairs`` a part of the block's different id
    pairs with the number of documents each. It is bucketed by block, so that parcels
    meet their counts where they are stored. ``groups`` and ``score`` read it."""
    schema = pa.schema([("block", pa.int64()), ("pairs", pa.binary()), ("parcel", pa.binary())])

    def row(block, pairs=None, parcel=None):
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, pairs, parcel), schema)],
                                          schema=schema)

    def run(batches):
        a, b = tokenizer_pair(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        tokens, held, size = 0, [], 0

        def close():
            pairs, n = merged(held)
            for at in range(0, len(pairs), 1 << 16):
                yield row(block, pairs=np.stack([pairs[at:at + (1 << 16)], n[at:at + (1 << 16)]]).tobytes())

        for batch in batches:
            for part in C.slices(batch, "text", STRETCH):
                found = aligned(C.texts(part), a, b)
                yield row(block, parcel=pack(part, found))
                tokens += len(found.ids[0]) + len(found.ids[1])
                # a document counts once for each of its pairs
                for pairs, n in document_pairs(found):
                    held.append((pairs, n))
                    size += len(pairs)
                    if size > HELD:
                        held = [merged(held)]
                        size = len(held[0][0]) // 2
                if tokens >= block_tokens:
                    yield from close()
                    block, tokens, held, size = block + 1, 0, [], 0
        if held:
            yield from close()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return C.bucketed(given.mapInArrow(run, BLOCKS), "aligned", "block", C.text_bytes(docs, text_col))


def document_pairs(found: Aligned):
    """(pairs, number of documents that hold them). A document's links may come in
    several runs, so what it had before is kept while it goes on."""
    open_doc, seen = -1, np.empty(0, np.int64)
    for docs, pairs, _ in found.pairs():
        order = np.lexsort((pairs, docs))
        docs, pairs = docs[order], pairs[order]
        new = np.append(True, (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1]))
        docs, pairs = docs[new], pairs[new]
        if docs[0] == open_doc:
            again = (docs == open_doc) & np.isin(pairs, seen)
            docs, pairs = docs[~again], pairs[~again]
        if not len(docs):
            continue
        last = docs[-1]
        mine = pairs[docs == last]
        seen = np.union1d(seen, mine) if last == open_doc else mine
        open_doc = last
        yield np.unique(pairs, return_counts=True)


def pair_counts(aligned_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair, n) of every block's pairs, and (pair, count, best) over the
    corpus: the documents that hold the pair linked, and whether no other pair of
    its A id has more."""
    def listed(batches):
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("pairs").to_pylist()):
                pairs, n = np.frombuffer(raw, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(n)],
                                                 names=["block", "pair", "n"])

    asked = aligned_.where("pairs is not null").select("block", "pairs").mapInArrow(listed, "block long, pair long, n long")
    counts = C.cut(asked.groupBy("pair").agg(F.sum("n").alias("count")), "pair_counts")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    told = counts.join(best, F.shiftright("pair", 32) == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))
    return asked.select("block", "pair"), told


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def groups(aligned_: DataFrame, id_kind: str) -> DataFrame:
    """(id, group, a, b): the groups of every document in order, with their ids."""
    schema = C.arrow_schema(f"id {id_kind}, group long, a array<bigint>, b array<bigint>")

    def run(batches):
        for batch in batches:
            for parcel in batch.column("parcel").to_pylist():
                ids, found = unpack(parcel)
                doc = found.docs[0][found.lasts[0]]
                first = np.searchsorted(doc, np.arange(len(ids)))
                sides = [pa.ListArray.from_arrays(pa.array(np.append(0, np.flatnonzero(last) + 1).astype(np.int32)),
                                                  pa.array(i)) for last, i in zip(found.lasts, found.ids)]
                yield C.to_batch({"id": ids.take(pa.array(doc)), "group": np.arange(len(doc)) - first[doc],
                                  "a": sides[0], "b": sides[1]}, schema)

    return aligned_.where("parcel is not null").select("parcel").mapInArrow(
        run, f"id {id_kind}, group long, a array<bigint>, b array<bigint>")


def score(aligned_: DataFrame, id_kind: str) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every
    document; see the module for their meaning."""
    asked, told = pair_counts(aligned_)
    answers = asked.join(told, "pair").select("block", "pair", "count", "best")
    kinds = (f"id {id_kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
             "groups_sha256 string")
    schema = C.arrow_schema(kinds)

    def rate(_, left: pa.Table, right: pa.Table) -> pa.Table:
        known, count = right.column("pair").to_numpy(), right.column("count").to_numpy()
        best = right.column("best").to_numpy()
        order = np.argsort(known)
        known, count, best = known[order], count[order], best[order]
        out = []
        for parcel in left.column("parcel"):
            ids, found = unpack(parcel.as_buffer())
            n_best, total = np.zeros((2, len(ids)), np.int64)
            for docs, pairs, times in found.pairs():
                at = np.searchsorted(known, pairs)
                np.add.at(n_best, docs[best[at]], times[best[at]])
                np.add.at(total, docs, times * count[at])
            out.append(C.to_batch({
                "id": ids, "n_a": found.counts[0], "n_b": found.counts[1], "n_best": n_best, "count_sum": total,
                "n_groups": found.per_document(found.lasts[0]), "n_links": found.per_document(found.links()),
                "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.texts()]}, schema))
        return pa.Table.from_batches(out, schema=schema)

    parcels = aligned_.where("parcel is not null").select("block", "parcel")
    return parcels.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(rate, kinds)


def tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_interval_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    with C.temporary(spark):
        table = align(docs, *tokenizers())
        scored = C.cut(score(spark.table(table), id_type(docs, "doc_id")), "alignment_scores", keep=True)
        spark.sql(f"DROP TABLE {table}")
    return scored.withColumnRenamed("id", "doc_id")
