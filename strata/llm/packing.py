"""Best-fit packing by bin completion (operator 4).

Documents become pieces of at most ``capacity`` tokens. The pieces, a few dozen
bytes each, are dealt round into blocks of bounded size, and a block is packed
by bin completion: around the largest piece left, the undominated fillings of
the sequence are tried, least waste first; a branch ends when its waste shows
that it cannot beat the incumbent, which best-fit decreasing supplies first. A
block whose incumbent meets the lower bound is optimal and searches nothing.

A null text is an empty document: one token, the end id. An empty table gives
no pieces; repeated rows are packed each; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 2048
END_ID = 0
#: Bytes of text that are tokenised together.
STRETCH = 1 << 21
#: Pieces in a block: what one task packs together.
BLOCK_PIECES = 32_768
#: Steps (a piece tried in a filling) that the search may take in a block, and
#: more of them for each sequence; then the incumbent stands.
SEARCH_STEPS = 50_000
STEPS_A_SEQUENCE = 40
#: Places along the first descent where best fit completes the packing.
INCUMBENTS = 32

#: The letters in which the vocabulary writes the bytes: printable Latin-1 as it
#: is, the others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: chr(b) for b in PRINTABLE} | {
    b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in PRINTABLE)}

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class Words:
    """Token ids of texts, through the different words of many texts.

    The vocabulary's splitter never joins what a space or a line end parts, so a
    word's ids do not depend on its neighbours. Arrow cuts the texts there, parts
    words that are letters and marks in two (the splitter does so too), puts the
    letters in lower case as the vocabulary does, and gives each spelling a number;
    only spellings pass through Python. What is of another form goes to the
    tokenizer whole. The memory of spellings has two generations: the older goes
    when the newer is full, and what is in use moves on.
    """

    MEMORY = 200_000
    #: Longer spellings are not remembered.
    REMEMBERED = 64
    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    PLAIN = rf"^(?P<letters>[{LETTERS}]*)(?P<marks>[.,!?;:#$%&*()-]*)$"

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer
        self.tokenizer, self.memory = Tokenizer.from_file(path), memory
        self.model = self.tokenizer.model
        # the model reads bytes as letters: two for each of Latin-1 beyond ASCII
        self.bytes = str.maketrans({c: "".join(BYTE_LETTERS[b] for b in c.encode())
                                    for c in map(chr, range(0xC0, 0x100))})
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, spelling: str) -> bytes:
        """The ids of letters in lower case, or of marks."""
        return np.array([t.id for t in self.model.tokenize(spelling.translate(self.bytes))], dtype="<u4").tobytes()

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def spellings(self, spelled: list[str], ids_of) -> list[bytes]:
        """The ids of different spellings."""
        known = self.newer
        new = [s for s in spelled if s not in known]
        if len(known) + len(new) > self.memory:
            self.older, known, new = known, {}, spelled
        older = self.older
        long = False
        for s in new:
            ids = older.get(s)
            known[s] = ids_of(s) if ids is None else ids
            long = long or len(s) > self.REMEMBERED
        out = [known[s] for s in spelled]
        # some texts may have very many
        self.newer = known if len(known) <= self.memory else {}
        if long:
            self.newer = {s: ids for s, ids in self.newer.items() if len(s) <= self.REMEMBERED}
        return out

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and each text's number of them."""
        lines = pc.replace_substring_regex(pa.array(texts, pa.large_string()), "[\n\r\t]", " ")
        words = pc.split_pattern(lines, " ")
        every = words.flatten().dictionary_encode()
        number, forms = every.indices.to_numpy(), every.dictionary
        parts = pc.extract_regex(forms, self.PLAIN)
        other = parts.is_null()
        letters = pc.if_else(other, "", pc.utf8_lower(pc.struct_field(parts, "letters"))).dictionary_encode()
        marks = pc.if_else(other, "", pc.struct_field(parts, "marks")).dictionary_encode()
        odd = forms.filter(other).to_pylist()

        ids, begin = [], [0]
        for side in (letters.dictionary.to_pylist(), marks.dictionary.to_pylist()):
            ids += self.spellings(side, self._plain)
            begin.append(len(ids))
        ids += self.spellings(odd, self._whole)
        # two numbers a word: of its letters, or all of it, and of its marks
        pairs = np.empty((len(forms), 2), np.int64)
        pairs[:, 0] = letters.indices.to_numpy()
        pairs[:, 1] = marks.indices.to_numpy() + begin[1]
        pairs[other.to_numpy(zero_copy_only=False), 0] = begin[2] + np.arange(len(odd))
        number = pairs[number].ravel()

        sizes = np.array([len(i) // 4 for i in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        # where each part's ids begin, and on
        lengths = sizes[number]
        ends = np.cumsum(lengths)
        begins = (np.cumsum(sizes) - sizes)[number]
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)
        bounds = np.append(0, ends)[2 * words.offsets.to_numpy()]
        return flat[at], np.diff(bounds)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """A row per piece: (doc_id, piece, start, length, ids_crc32[, ids])."""
    schema = PIECES.format(id=docs.schema[id_col].dataType.simpleString()) + ", ids array<long>" * with_ids
    arrow = C.arrow_schema(schema)

    def run(batches):
        words = Words(tokenizer)
        for batch in batches:
            for part in C.slices(batch, "text", STRETCH):
                yield C.to_batch(split(part, words), arrow)

    def split(batch, words):
        out = defaultdict(list)
        end = np.array([END_ID], dtype="<u4").tobytes()
        ids, counts = words(C.texts(batch))
        whole, at = ids.tobytes(), 0
        for row, n in enumerate(counts.tolist()):
            raw = whole[4 * at:4 * (at + n)] + end
            at += n
            for piece, begin in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[begin:begin + 4 * capacity]
                out["row"].append(row)
                out["piece"].append(piece)
                out["start"].append(begin // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if with_ids:
                    out["ids"].append(np.frombuffer(part, dtype="<u4"))
        return out | {"doc_id": batch.column("id").take(pa.array(out["row"], pa.int64()))}

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Sizes:
    """How many pieces of each size are left, with the sizes in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {s: n for s, n in counts.items() if n}
        self.order = sorted(self.left)

    def take(self, size: int) -> None:
        self.left[size] -= 1
        if not self.left[size]:
            del self.left[size]
            del self.order[bisect.bisect_left(self.order, size)]

    def put(self, size: int) -> None:
        if size not in self.left:
            self.left[size] = 0
            bisect.insort(self.order, size)
        self.left[size] += 1

    def best(self, room: int) -> int:
        """The largest size that fits, or 0."""
        k = bisect.bisect_right(self.order, room)
        return self.order[k - 1] if k else 0


def best_fit(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: every piece into the fullest sequence it fits."""
    by_room, rooms, packed = defaultdict(list), [], []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            k = bisect.bisect_left(rooms, size)
            if k < len(rooms):
                room = rooms[k]
                bin_ = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[k]
            else:
                room, bin_ = capacity, []
                packed.append(bin_)
            bin_.append(size)
            room -= size
            if room:
                if room not in by_room:
                    bisect.insort(rooms, room)
                by_room[room].append(bin_)
    return packed


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and Martello and Toth's L2."""
    best = math.ceil(sum(s * n for s, n in counts.items()) / capacity)
    sizes = sorted(counts)
    for k in {0, *(s for s in sizes if s <= capacity // 2)}:
        large = sum(n for s, n in counts.items() if s > capacity - k)
        middle = [(s, n) for s, n in counts.items() if capacity / 2 < s <= capacity - k]
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        room = sum(n * (capacity - s) for s, n in middle)
        best = max(best, large + sum(n for _, n in middle) + max(0, math.ceil((small - room) / capacity)))
    return best


def reaches(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """For each size the sums, as bits, that it and smaller ones can make up."""
    out, sums, limit = {}, 1, (1 << (capacity + 1)) - 1
    for size in sorted(counts):
        left, step = min(counts[size], capacity // size), 1
        while left > 0:
            take = min(step, left)
            sums |= sums << (take * size) & limit
            left, step = left - take, step * 2
        out[size] = sums
    return out


class Fillings:
    """Undominated fillings of a sequence's room, of any number of pieces, least
    waste first; lazily, since the first of them are often enough.

    A filling is dominated when a piece that is left could stand in for some of its
    pieces and still fit: to fill with that piece instead is never worse.
    """

    def __init__(self, sizes: Sizes, reach: dict[int, int], steps: int):
        self.sizes, self.reach, self.steps = sizes, reach, steps

    def __call__(self, room: int, allowed: int):
        """Fillings that waste ``allowed`` at most."""
        low, high = 0, 0
        while low <= min(allowed, room) and self.steps > 0:
            # one waste after the other; where nothing fills so well, many at a time
            high = min(high, allowed, room)
            found = self._of_waste(len(self.sizes.order), room, low, high, [])
            if high > low:
                found = sorted(found, key=lambda f: room - sum(f))
            for filling in found:
                if self._stands(filling, room):
                    yield filling
            low, high = high + 1, 2 * high + 2

    def _of_waste(self, upto: int, room: int, low: int, high: int, chosen: list[int]):
        if low <= room <= high:
            yield list(chosen)
        sizes, order = self.sizes, self.sizes.order
        wanted = ((1 << (high - low + 1)) - 1) << max(room - high, 0)
        if room < high:
            wanted = (1 << (room - low + 1)) - 1 if room >= low else 0
        for k in range(min(upto, bisect.bisect_right(order, room)) - 1, -1, -1):
            size = order[k]
            self.steps -= 1
            if self.steps <= 0 or not self.reach[size] & wanted:
                return
            for n in range(min(sizes.left[size], room // size), 0, -1):
                chosen.extend([size] * n)
                yield from self._of_waste(k, room - n * size, low, high, chosen)
                del chosen[-n:]

    def _stands(self, filling: list[int], room: int) -> bool:
        sizes, waste = self.sizes, room - sum(filling)
        used = Counter(filling)
        single, several = 0, 0  # sums of one piece, and of more
        for s in filling:
            several |= several << s | single << s
            single |= 1 << s
        sums = several | single | 1
        t = 0
        while sums >> t:
            if sums >> t & 1:
                # as much as one piece is no gain, as much as several is
                k = bisect.bisect_left(sizes.order, t + 1 - (several >> t & 1))
                while k < len(sizes.order) and sizes.order[k] <= t + waste:
                    if sizes.left[sizes.order[k]] > used[sizes.order[k]]:
                        return False
                    k += 1
            rest = sums >> (t + 1)
            if not rest:
                break
            t += (rest & -rest).bit_length()
        return True


def complete(counts: dict[int, int], capacity: int, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Branch and bound over bin completions; the sizes of each sequence."""
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    if len(best) <= bound:
        return best
    total = sum(s * n for s, n in counts.items())
    sizes, path, wasted = Sizes(counts), [], 0
    fillings = Fillings(sizes, reaches(counts, capacity), steps + STEPS_A_SEQUENCE * len(best))

    def options(allowed: int):
        big = sizes.order[-1]
        sizes.take(big)
        for filling in fillings(capacity - big, allowed):
            sizes.put(big)
            yield [big, *filling]
            sizes.take(big)
        sizes.put(big)

    def undo():
        nonlocal wasted
        undone = path.pop()
        wasted -= capacity - sum(undone)
        for s in undone:
            sizes.put(s)

    def finish():
        """The rest by best fit, as a new incumbent if it is better."""
        nonlocal best
        done = [*path, *best_fit(sizes.left, capacity)]
        if len(done) < len(best):
            best = [list(b) for b in done]

    stack = [options((len(best) - 1) * capacity - total)]
    deepest, stride = 0, max(1, len(best) // INCUMBENTS)
    while stack and len(best) > bound:
        # what a better packing may waste in all
        allowed = (len(best) - 1) * capacity - total
        bin_ = next(stack[-1], None)
        if bin_ is None or wasted + capacity - sum(bin_) > allowed:
            stack.pop()  # fillings come by waste: the rest of them waste more
            if path:
                undo()
            continue
        for s in bin_:
            sizes.take(s)
        path.append(bin_)
        wasted += capacity - sum(bin_)
        if len(path) > deepest and (len(path) % stride == 0 or fillings.steps <= 0):
            finish()
        deepest = max(deepest, len(path))
        if not sizes.order:
            finish()
            undo()
            continue
        stack.append(options(allowed - wasted))
    return best


def pack(pieces_: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES,
         length_col: str = "length") -> DataFrame:
    """``pieces_`` with (sequence_id, offset); give it stored rows, since they
    are counted first and read again."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([*pieces_.schema.fields, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])
    given, arrow = to_arrow_schema(pieces_.schema), to_arrow_schema(schema)

    def run(batches):
        rows = pa.Table.from_batches(list(batches), schema=given)
        if not rows.num_rows:
            return
        length = rows.column(length_col).to_numpy()
        waiting = defaultdict(list)
        for row, size in enumerate(length.tolist()):
            waiting[size].append(row)
        order, sequence, offset = [], [], []
        for n, bin_ in enumerate(complete({s: len(w) for s, w in waiting.items()}, capacity)):
            at = 0
            for size in bin_:
                order.append(waiting[size].pop())
                sequence.append(n)
                offset.append(at)
                at += size
        first = TaskContext.get().partitionId() << 33
        rows = rows.take(pa.array(order, pa.int64()))
        rows = rows.append_column("sequence_id", pa.array(np.array(sequence, dtype=np.int64) + first))
        rows = rows.append_column("offset", pa.array(offset, pa.int64()))
        yield from rows.cast(arrow).to_batches(max_chunksize=10_000)

    # dealt round, so a block's size does not depend on any key
    blocks = max(1, math.ceil(pieces_.count() / block_pieces))
    return pieces_.repartition(blocks).mapInArrow(run, schema)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack(C.cut(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def op4_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents"), tokenizer_path())
