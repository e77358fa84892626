"""Quality classifier: a modified Kneser-Ney model of trusted text (operator 1).

The model is an interpolated modified Kneser-Ney model of characters, four to a
gram, one for each language, trained on all trusted documents. (Word grams of
the corpus are nearly all different, so their joins would move several times
the text; grams of characters repeat.) Its tables stay distributed, sharded by
gram, and grow with the corpus: nothing of the model is collected or broadcast.

A character has 15 bits in a gram. Where a language's trusted text holds
characters beyond them (Hangul, part of the ideographs, emoji), these take the
codes of characters that it does not hold; should a language hold more than
there are codes, its rarest characters are spelled with two.

Scoring is a join of counts. Documents are taken in blocks of ``BLOCK_BYTES`` of
text, however many or long they are, and stored with the grams that the block
holds, in buckets of blocks. A block asks for the probabilities of its distinct grams; the
corpus' distinct grams are joined, order by order, with the counts of the model
(an unseen gram backs off); the answers go back to the blocks, where they meet
the texts where they are stored, and every document gets its perplexity. A document is rejected above
a quantile of the perplexities of trusted documents of its language that the
model was not trained on.

A null text reads as empty and is kept: it has no perplexity. A null language
is a language of its own; a language with little held-out trusted text takes the
threshold of all languages, and without any trusted text nothing is rejected. Rows that repeat are scored each; an empty table
gives no rows; other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import common as C

#: Characters of a gram.
ORDER = 4
#: Bits of a character. Those beyond get a code from their language's alphabet;
#: what no trusted text holds shares the last code.
BITS = 15
BEGIN, END, OTHER = 0, 1, (1 << BITS) - 1
#: Bytes of text that ask for their grams together.
BLOCK_BYTES = 1 << 24
#: Characters, or bytes, of text that go through numpy at a time.
STRETCH = 1 << 19
#: One trusted document in so many is held out to set the thresholds.
HELD_OUT = 10
#: Share of a language's held-out trusted documents that stay below the threshold.
QUANTILE = 0.99
#: Room above the quantile, in bits per character.
MARGIN = 0.25
#: Room for short texts, in bits per character times the root of the length.
SHORT = 6.0
#: Held-out documents that a language needs for a threshold of its own.
MIN_HELD_OUT = 50
#: Steps per bit in which thresholds are found.
STEP = 256

NO_LANG = "\x00"


class Alphabets:
    """Spells texts in codes that fit into a gram, language by language. No two
    characters of ``seen`` (lang to characters, most frequent first) are spelled
    the same; ASCII is as it is, and so is a language without an entry."""

    #: Languages whose tables are kept.
    MEMORY = 8
    #: Parts of characters that are spelled with two codes; no text holds them.
    PARTS = range(0xD800, 0xE000)

    def __init__(self, seen: dict[str, np.ndarray], room: int = OTHER - 128):
        self.seen, self.room, self.tables = seen, room, {}

    def table(self, lang: str) -> dict[int, int | str]:
        own = [c for c in self.seen[lang].tolist() if c >= 128]
        rare = []
        if len(own) > self.room:
            at = self.room - len(self.PARTS)
            own, rare = [*own[:at], *self.PARTS], own[at:]
        table = {c: c for c in own if c < OTHER}
        free = (c for c in range(OTHER - 1, 127, -1) if c not in table)
        code = dict(zip((c for c in own if c >= OTHER), free))
        pairs = {c: chr(code[0xD800 + (c >> 10)]) + chr(code[0xDC00 + (c & 1023)]) for c in rare}
        # a character whose code is taken was not seen
        return {c: OTHER for c in code.values()} | table | code | pairs

    def __call__(self, lang: str, texts: list[str]) -> list[str]:
        if lang not in self.seen:
            return texts
        if lang not in self.tables:
            if len(self.tables) >= self.MEMORY:
                self.tables.clear()
            self.tables[lang] = self.table(lang)
        return [t if t.isascii() else t.translate(self.tables[lang]) for t in texts]


def alphabets(trusted: DataFrame) -> Alphabets:
    """Of the languages whose trusted text goes beyond ``BITS``. ``trusted``: lang,
    text (zstandard frames)."""
    def count(batch):
        unpack = zstandard.ZstdDecompressor()
        seen: dict[str, Counter] = {}
        for lang, frame in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            text = unpack.decompress(frame).decode()
            if not text.isascii():
                seen.setdefault(lang, Counter()).update(set(text))
        rows = [(lang, ord(c), n) for lang in seen for c, n in seen[lang].items() if not c.isascii()]
        return dict(zip(("lang", "c", "n"), zip(*rows))) if rows else None

    found = (C.map_batches(trusted, count, "lang string, c int, n long")
             .groupBy("lang", "c").agg(F.sum("n").alias("n")))
    found = C.cut(found, "lm_alphabets")
    beyond = found.where(F.col("c") >= OTHER).select("lang").distinct()
    rows = found.join(beyond, "lang", "left_semi").orderBy("lang", F.desc("n"), "c").toArrow()
    langs, chars = np.array(rows.column("lang").to_pylist(), object), rows.column("c").to_numpy()
    return Alphabets({lang: chars[langs == lang] for lang in dict.fromkeys(langs)})


NO_ALPHABETS = Alphabets({})


def gram_codes(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts, one for each character and the end, and where
    each text's begin. A text stands between ``order - 1`` begin codes and an end."""
    pad = "\x00" * (order - 1)
    joined = "".join(f"{pad}{t}\x01" for t in texts)
    chars = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), OTHER).astype(np.int64)
    codes = np.zeros(len(chars) - order + 1, np.int64)
    for k in range(order):
        codes <<= BITS
        codes |= chars[k:k + len(codes)]
    del joined, chars
    lengths = np.array([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], np.cumsum(lengths + order - 1)[:-1]])
    keep = np.zeros(len(codes), np.int32)
    # a gram that ends in a text's padding is no gram
    keep[begins] += 1
    ends = begins + lengths
    np.add.at(keep, ends[ends < len(codes)], -1)
    return codes[np.cumsum(keep) > 0], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def by_language(batch: pa.RecordBatch, text_col: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(LANG).to_pylist(), C.texts(batch, text_col)):
        if text:
            out.setdefault(lang, []).append(text)
    return out


# --- training ---------------------------------------------------------------

def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One table of grams and counts from several."""
    g, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return g, np.bincount(inverse, weights=np.concatenate([c for _, c in parts]), minlength=len(g)).astype(np.int64)


def count_grams(docs: DataFrame, spell: Alphabets = NO_ALPHABETS) -> DataFrame:
    """(lang, g, c) over all ``docs``: lang, text (zstandard frames)."""
    def count(batch):
        unpack = zstandard.ZstdDecompressor()
        by_lang: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        parts: dict[str, list] = {}

        def settle(lang):
            grams = gram_codes(spell(lang, by_lang.pop(lang)))[0]
            parts.setdefault(lang, []).append(np.unique(grams, return_counts=True))
            size[lang] = 0

        for lang, frame in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            text = unpack.decompress(frame).decode()
            by_lang.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] > STRETCH:
                settle(lang)
        for lang in list(by_lang):
            settle(lang)
        langs, grams, counts = [], [], []
        for lang in parts:
            g, c = merged(parts[lang])
            langs += [lang] * len(g)
            grams.append(g)
            counts.append(c)
        return {"lang": langs, "g": np.concatenate(grams), "c": np.concatenate(counts)}

    return C.map_batches(docs, count, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def suffix(order: int, g: str = "g") -> Column:
    """The last ``order`` characters of a gram."""
    return F.col(g).bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def history(g: str = "g") -> Column:
    """A gram without its last character."""
    return F.shiftright(g, BITS)


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the three discounts from the counts of counts."""
    n = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (F.greatest(F.col(f"n{k}"), F.lit(1.0)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    bounded = lambda d, k: F.least(F.greatest(d, F.lit(0.05)), F.lit(k - 0.05))
    return counts.groupBy("lang").agg(*n).select(
        "lang", bounded(1 - 2 * y * n2 / n1, 1.0).alias("d1"), bounded(2 - 3 * y * n3 / n2, 2.0).alias("d2"),
        bounded(3 - 4 * y * n4 / n3, 3.0).alias("d3"))


class Model:
    """Tables of each order: ``grams`` (lang, g, c, d) with the count (below the
    highest order, of different left neighbours) and its discount, and ``contexts``
    (lang, h, total, rest) with the mass left for the lower order."""

    def __init__(self, grams: dict[int, DataFrame], contexts: dict[int, DataFrame], letters: DataFrame):
        self.grams, self.contexts, self.letters = grams, contexts, letters


def train(trusted: DataFrame, spell: Alphabets = NO_ALPHABETS) -> Model:
    """The model of ``trusted``: lang, text (zstandard frames). Every table is stored."""
    counts = C.cut(count_grams(trusted, spell), "lm_counts")
    grams, contexts = {}, {}
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            # different left neighbours: one row per gram of the order above
            counts = C.cut(counts.groupBy("lang", suffix(order).alias("g")).agg(F.count("*").alias("c")),
                           f"lm_counts_{order}")
        d = C.cut(discounts(counts), "lm_discounts")
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        with_d = counts.join(d, "lang").withColumn("d", discount)
        grams[order] = C.cut(with_d.select("lang", "g", "c", "d"), f"lm_grams_{order}")
        contexts[order] = C.cut(grams[order].groupBy("lang", history().alias("h")).agg(
            F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("rest")), f"lm_contexts_{order}")
    letters = C.cut(grams[1].groupBy("lang").agg((F.count("*") + 1).alias("v")), "lm_letters")
    return Model(grams, contexts, letters)


def probabilities(model: Model, wanted: DataFrame) -> DataFrame:
    """(lang, g, logp) of the ``wanted`` grams (lang, g), in bits."""
    levels = {ORDER: wanted}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = levels[order + 1].select("lang", suffix(order).alias("g")).distinct()
    p = None
    for order in range(1, ORDER + 1):
        asked = levels[order].select("lang", "g", history().alias("h"), suffix(order - 1).alias("low"))
        if p is None:
            lower = asked.join(model.letters, "lang", "left").withColumn(
                "p_low", 1 / F.coalesce("v", F.lit(float(1 << BITS)))).drop("v")
        else:
            lower = asked.join(p.select("lang", F.col("g").alias("low"), F.col("p").alias("p_low")), ["lang", "low"])
        seen = (lower.join(model.grams[order], ["lang", "g"], "left")
                .join(model.contexts[order], ["lang", "h"], "left"))
        own = F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0))
        value = F.when(F.col("total").isNull(), F.col("p_low")).otherwise(own + F.col("rest") * F.col("p_low"))
        p = C.cut(seen.select("lang", "g", value.alias("p")), f"lm_p_{order}")
    return p.select("lang", "g", F.log2("p").alias("logp"))


# --- scoring ----------------------------------------------------------------

LANG, TEXT, BLOCK, NO, GRAMS, RATED = (C.OWN + n for n in ("lang", "text", "block", "no", "grams", "rated"))


def in_blocks(docs: DataFrame, text_col: str, spell: Alphabets = NO_ALPHABETS,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (with ``LANG`` and the text) with ``BLOCK`` and the row's number ``NO``
    in it; between them rows of ``BLOCK``, ``LANG`` and ``GRAMS`` alone, each with a part
    of the block's distinct grams of a language. A row's block hangs on nothing but
    the task that read it, so the result is to be stored and read from there."""
    from pyspark.sql.pandas.types import to_arrow_schema
    added = StructType.fromDDL(f"`{BLOCK}` long, `{NO}` int, `{GRAMS}` binary")
    # every field may be null: rows of grams have none of a document
    schema = StructType([*(StructField(f.name, f.dataType) for f in docs.schema.fields), *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=3)
        size, no, held = 0, 0, {}

        def close():
            for lang in list(held):
                grams = np.unique(np.concatenate(held.pop(lang)))
                for at in range(0, len(grams), 50_000):
                    steps = np.diff(grams[at:at + 50_000], prepend=0)
                    own = {LANG: lang, BLOCK: block, GRAMS: pack.compress(steps.tobytes())}
                    yield pa.RecordBatch.from_arrays([pa.array([own.get(f.name)], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for part in C.slices(batch, text_col, STRETCH):
                for lang, texts in by_language(part, text_col).items():
                    held.setdefault(lang, []).append(np.unique(gram_codes(spell(lang, texts))[0]))
                    if len(held[lang]) > 16:
                        held[lang] = [np.unique(np.concatenate(held[lang]))]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name).cast(f.type) for f in arrow if f.name in part.schema.names),
                     pa.repeat(pa.scalar(block, pa.int64()), n), pa.array(np.arange(no, no + n, dtype=np.int32)),
                     pa.nulls(n, pa.binary())], schema=arrow)
                no += n
                size += part.column(text_col).nbytes
                if size >= block_bytes:
                    yield from close()
                    block, size, no = block + 1, 0, 0
        yield from close()

    return docs.mapInArrow(run, schema)


def requests(blocks: DataFrame) -> DataFrame:
    """(block, lang, g): the distinct grams of each block."""
    def listed(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for block, lang, frame in zip(*(batch.column(c).to_pylist() for c in (BLOCK, LANG, GRAMS))):
                grams = np.cumsum(np.frombuffer(unpack.decompress(frame), np.int64))
                yield pa.RecordBatch.from_arrays([pa.repeat(block, len(grams)), pa.repeat(lang, len(grams)),
                                                  pa.array(grams)], names=["block", "lang", "g"])

    return (blocks.where(F.col(GRAMS).isNotNull()).select(BLOCK, LANG, GRAMS)
            .mapInArrow(listed, "block long, lang string, g long"))


RATES = f"block long, `{RATED}` array<double>"


class Scored:
    """Documents in stored blocks with the stored scores of their texts."""

    def __init__(self, blocks: DataFrame, rates: DataFrame):
        self.blocks, self.rates = blocks, rates

    def rows(self, carry: list[str], out_col: str) -> DataFrame:
        """The columns ``carry`` of the documents and ``out_col``: the bits per
        character, null where there is no text. The documents are read where they are
        stored; a block's scores, one row, come to them."""
        bits = F.get(RATED, F.col(NO))
        return (self.blocks.where(F.col(NO).isNotNull()).select(*carry, BLOCK, NO)
                .join(self.rates, F.col(BLOCK) == F.col("block"))
                .select(*carry, F.when(~F.isnan(bits), bits).alias(out_col)))


def score(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> Scored:
    """The bits per character of each text under the model of its language, the
    logarithm of its perplexity, with the columns ``carry`` of ``docs`` (all by
    default). ``trusted`` has a column of ids."""
    with C.temporary(docs.sparkSession):
        return _score(docs, trusted, id_col, text_col, lang_col, block_bytes, docs.columns if carry is None else carry)


def _score(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, lang_col: str, block_bytes: int,
           carry: list[str]) -> Scored:
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    text = F.col(text_col).cast("string")

    trusted = trusted.toDF("doc").where("doc is not null").distinct()
    bitmap = C.key_filter(trusted)

    def likely(batch):
        kept = batch.filter(pa.array(C.passes(bitmap, batch.column("slot").to_numpy())))
        pack = zstandard.ZstdCompressor(level=3)
        return {"doc": kept.column("doc"), "lang": kept.column("lang"),
                "text": [pack.compress(raw) for raw in C.raw_texts(kept)]}

    with_text = docs.where(F.col(id_col).isNotNull() & (text != "")).select(
        F.col(id_col).alias("doc"), lang.alias("lang"), text.alias("text"), C.slot(F.col(id_col), bitmap).alias("slot"))
    some = C.map_batches(with_text, likely,
                         f"doc {docs.schema[id_col].dataType.simpleString()}, lang string, text binary")
    known = C.cut(some.join(trusted, "doc", "left_semi").select("lang", "text"), "lm_trusted")
    spell = alphabets(known)
    model = train(known, spell)

    # a text that is carried is not held twice
    own = text_col if text_col in carry and docs.schema[text_col].dataType.simpleString() == "string" else TEXT
    given = docs.select(*carry, lang.alias(LANG), *([] if own == text_col else [text.alias(TEXT)]))
    # texts meet their answers where they are stored, so they are not shuffled
    table = C.bucketed(in_blocks(given, own, spell, block_bytes), "lm_blocks", BLOCK, C.text_bytes(docs, text_col),
                       keep=True)
    blocks = spark.table(table)
    asked = requests(blocks)
    logp = probabilities(model, asked.select("lang", "g").distinct())
    answers = asked.join(logp, ["lang", "g"]).select("block", "lang", "g", F.col("logp").cast("float").alias("logp"))
    schema = C.arrow_schema(RATES)

    def rate(_, left: pa.Table, right: pa.Table):
        tables = {}
        names = right.column("lang").combine_chunks().dictionary_encode()
        codes = np.asarray(names.indices)
        g, p = right.column("g").to_numpy(), right.column("logp").to_numpy()
        for k, name in enumerate(names.dictionary.to_pylist()):
            mine = np.flatnonzero(codes == k)
            mine = mine[np.argsort(g[mine])]
            tables[name] = (g[mine], p[mine].astype(np.float64))
        bits = np.full(left.num_rows, np.nan)
        for part in (part for batch in left.to_batches() for part in C.slices(batch, own, STRETCH)):
            texts, langs, places = (part.column(c).to_pylist() for c in (own, LANG, NO))
            for name in dict.fromkeys(langs):
                at = [i for i, x in enumerate(langs) if x == name and texts[i]]
                if not at:
                    continue
                spelled = spell(name, [texts[i] for i in at])
                grams, begins = gram_codes(spelled)
                seen, value = tables[name]
                total = np.add.reduceat(value[np.searchsorted(seen, grams)], begins)
                bits[[places[i] for i in at]] = -total / [len(t) + 1 for t in spelled]
        return pa.Table.from_arrays([left.column(BLOCK).slice(0, 1).cast(pa.int64()),
                                     pa.array([bits], schema.field(RATED).type)], schema=schema)

    packed = blocks.where(F.col(NO).isNotNull()).select(BLOCK, NO, LANG, own)
    rates = packed.groupBy(BLOCK).cogroup(answers.groupBy("block")).applyInArrow(rate, RATES)
    return Scored(blocks, C.cut(rates, "quality_rates", keep=True))


def thresholds(scored: DataFrame, held_out: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
               id_col: str = "doc_id", lang_col: str = "lang", bits_col: str = "bits") -> DataFrame:
    """(lang, threshold) from the scores of the ``held_out`` ids; the null
    language's row, over all of them, is for languages with few."""
    held_out = held_out.toDF("doc").distinct()
    step = F.ceil(F.col(bits_col) * STEP).alias("step")
    trusted = C.cut(scored.where(F.col(bits_col).isNotNull())
                    .select(F.col(id_col).alias("doc"),
                            F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), step)
                    .join(held_out, "doc", "left_semi"), "quality_held_out")
    enough = trusted.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_HELD_OUT).select("lang")
    each = C.step_quantile(trusted.join(enough, "lang", "left_semi"), ["lang"], "step", quantile)
    pooled = C.step_quantile(trusted.withColumn("lang", F.lit(None).cast("string")), ["lang"], "step", quantile)
    return each.unionByName(pooled).select("lang", (F.col("step") / STEP + F.lit(margin)).alias("threshold"))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN,
             carry: list[str] | None = None, out_col: str = "quality") -> DataFrame:
    """The columns ``carry`` of ``docs`` and ``out_col`` (in place of any column of
    that name): struct<perplexity, threshold, kept>.

    ``trusted`` holds the ids of the trusted documents (one column); one in
    ``HELD_OUT`` of them sets the thresholds, the rest train the model.
    """
    bits, length = C.OWN + "bits", C.OWN + "length"
    carry = [c for c in (docs.columns if carry is None else carry) if c != out_col]
    key = trusted.columns[0]
    held = F.pmod(F.xxhash64(F.lit("held out"), F.col(key)), F.lit(HELD_OUT)) == 0
    sized = docs.withColumn(length, F.coalesce(F.length(text_col), F.lit(0)))
    needed = list(dict.fromkeys([*carry, id_col, lang_col, length]))
    told = score(sized, trusted.where(~held), id_col, text_col, lang_col, carry=needed)
    scored = told.rows(list(dict.fromkeys([*carry, lang_col, length])), bits)
    narrow = told.rows([id_col, lang_col], bits)
    limit = C.cut(thresholds(narrow, trusted.where(held), quantile, margin, id_col, lang_col, bits),
                  "quality_thresholds")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    own = limit.where("lang is not null").select(F.col("lang").alias(C.OWN + "lang"),
                                                 F.col("threshold").alias(C.OWN + "own"))
    pooled = limit.where("lang is null").select(F.max("threshold")).scalar()
    judged = scored.join(own, lang == F.col(C.OWN + "lang"), "left")
    # a short text's mean scatters with the root of its length
    threshold = F.coalesce(F.col(C.OWN + "own"), pooled) + F.lit(SHORT) / F.sqrt(F.col(length) + 1)
    return judged.select(*[scored[c] for c in carry], F.struct(
        F.pow(F.lit(2.0), F.col(bits)).alias("perplexity"), F.pow(F.lit(2.0), threshold).alias("threshold"),
        F.coalesce(F.col(bits) <= threshold, F.lit(True)).alias("kept")).alias(out_col))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids that are labelled good and not toxic."""
    return labels.where("quality = 1 and toxic = 0").select("doc_id").distinct()


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return classify(docs, trusted_ids(C.table(spark, sf_dir, "labels")), carry=["doc_id", "lang"]).select(
        "doc_id", "lang", "quality.*")
