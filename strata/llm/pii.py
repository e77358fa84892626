"""Information-theoretic removal of personal data (operator 10).

Fixed patterns find the protected entities: e-mail and IP addresses, payment
cards, phone numbers. A term that stands near an entity can give it away even
when the entity itself is gone. How much it gives away is estimated from the
whole corpus: with p(e) the share of word positions near entity e and p(e|t)
the share of t's occurrences that are near e, the disclosure of e by t is

    PMI(e; t) / IC(e)  =  log(p(e|t) / p(e)) / log(1 / p(e)),

1 when t occurs near e only, 0 when t says nothing about e. Terms that stand
near an entity in enough different contexts and reach the threshold are spans
of kind ``term`` wherever they occur in any document; :func:`sanitise`
generalises entities to their kind and removes terms.

Entities are stored as keyed digests only. Copies of a context count once towards support. Null texts read as empty and
give no spans; repeated rows each give a row; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable
from hashlib import blake2b, sha256
from itertools import accumulate
from secrets import token_bytes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common as C

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans. E-mail is split at the @ so
# that a long run of local characters is read once.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins: from inside the run
# the rest is the same, and every match ends with a whole run.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{4,40}")

WORDS = re.compile(r"\S+")

#: Words on each side of an entity that count as near.
WINDOW = 8
#: Characters of a word, on the entity's side, in which terms are looked for.
WORD = 256
#: Different contexts in which a term must stand near an entity.
SUPPORT = 3
#: Least disclosure of a term that goes.
DISCLOSURE = 0.9

SPANS = "array<struct<kind:string,start:int,end:int>>"
HITS = "array<struct<term:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and EMAIL_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return found


def entities(text: str) -> list[tuple[str, int, int]]:
    """The base spans, by kind as listed, then start."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text)
              if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def near(text: str, spans: list[tuple[str, int, int]], window: int) -> list[list[str]]:
    """For each span the terms among ``window`` words on each side, entities left
    out; of a word only what is within ``WORD`` characters counts."""
    words = [m.span() for m in WORDS.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    own = {text[s:e] for _, s, e in spans}
    out = []
    for _, start, end in spans:
        k = bisect_left(starts, start)
        around = [(max(s, min(e, start) - WORD), min(e, start)) for s, e in words[max(0, k - window):k]]
        k = bisect_right(ends, end)
        around += [(max(s, end), min(e, max(s, end) + WORD)) for s, e in words[k:k + window]]
        out.append([t.lower() for s, e in around if text[s:e] not in own for t in TERM.findall(text[s:e])])
    return out


def contexts(docs: DataFrame, window: int) -> DataFrame:
    """(entity, term, context, size) for each term near an entity; ``size`` terms are
    near it in all. Entities are keyed digests, of a key that only this call knows:
    what is stored tells equal ones, not what they are."""
    key = token_bytes(16)

    def collect(batch):
        rows = []
        for text in C.texts(batch):
            spans = entities(text)
            for (kind, start, end), terms in zip(spans, near(text, spans, window) if spans else ()):
                entity = blake2b(f"{kind}:{text[start:end]}".encode(), key=key, digest_size=16).hexdigest()
                terms.sort()
                seen = xxhash.xxh64_intdigest("\x00".join(terms)) >> 1
                rows += [(entity, t, seen, len(terms)) for t in set(terms)]
        return dict(zip(("entity", "term", "context", "size"), zip(*rows))) if rows else None

    return C.map_batches(docs, collect, "entity string, term string, context long, size int")


class TermFilter:
    """Which words of a text may be terms of a key filter; remembers recent words."""

    MEMORY = 200_000

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.seen, self.idle = bitmap, {}, not bitmap.any()

    def __call__(self, words) -> dict[str, str]:
        """The words that pass, with the term that each stands for."""
        if self.idle:
            return {}
        new = [w for w in words if w not in self.seen]
        if new:
            if len(self.seen) > self.MEMORY:
                self.seen.clear()
                new = list(words)
            terms = [w.lower() for w in new]
            mask = (len(self.bitmap) << 5) - 1
            slots = [xxhash.xxh64_intdigest(t.encode(), seed=42) & mask for t in terms]
            for w, t, ok in zip(new, terms, C.passes(self.bitmap, slots).tolist()):
                self.seen[w] = t if ok else None
        return {w: t for w in words if (t := self.seen[w]) is not None}


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences in all documents of (at least) ``terms``; the null term
    counts every word."""
    bitmap = C.key_filter(terms)

    def count(batch):
        wanted, counts, words = TermFilter(bitmap), Counter(), 0
        for text in C.texts(batch):
            found = TERM.findall(text)
            words += len(found)
            if not wanted.idle:
                counts.update(found)
        totals = Counter()
        for word, term in wanted(counts.keys()).items():
            totals[term] += counts[word]
        return {"term": [None, *totals], "n": [words, *totals.values()]}

    return (C.map_batches(docs, count, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n_term")))


def disclosing_terms(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, disclosure) of the terms that give an entity away.

    ``docs`` has a column ``text``; every count is over all documents.
    """
    seen = C.cut(contexts(docs, window).groupBy("entity", "term", "context", "size").agg(F.count("*").alias("n")),
                 "pii_contexts")
    pairs = (seen.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("support"))
             .where(F.col("support") >= support))
    pairs = C.cut(pairs, "pii_pairs")
    counts = C.cut(term_counts(docs, pairs.select("term").distinct()), "pii_counts")
    n_words = counts.where("term is null").select(F.max("n_term")).scalar()
    # an entity's windows, by the terms that they hold
    near_entity = (seen.groupBy("entity", "context", "size").agg(F.max("n").alias("n"))
                   .groupBy("entity").agg(F.sum(F.col("n") * F.col("size")).alias("n_entity")))
    scored = (pairs.join(counts, "term").join(near_entity, "entity")
              .withColumn("p", F.least(F.col("n_entity") / n_words, F.lit(0.5)))
              .withColumn("given", F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0)))
              .withColumn("disclosure", F.log(F.col("given") / F.col("p")) / F.log(1 / F.col("p"))))
    return scored.where(F.col("disclosure") >= disclosure).select("entity", "term", "disclosure")


Finish = Callable[[str | None, list[dict]], str | None]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                       support: int = SUPPORT, disclosure: float = DISCLOSURE, carry: list[str] | None = None,
                       out_col: str = "spans", finish: Finish | None = None, finish_col: str = "clean") -> DataFrame:
    """One row per row of ``docs``: its columns ``carry`` (its id by default) and
    ``out_col`` (in place of any column of that name), the spans by kind (email, ip,
    card, phone, term), then start. With ``finish`` also ``finish_col``, what it makes of
    a row's text and all its spans. A text is only stored where terms may stand in it."""
    out = [out_col] if finish is None else [out_col, finish_col]
    carry = [c for c in ([id_col] if carry is None else carry) if c not in out]
    text, key, hits = (C.OWN + n for n in ("text", "text_key", "hits"))
    given = docs.select(*carry, F.col(text_col).cast("string").alias(text))
    terms = C.cut(disclosing_terms(docs.select(F.col(text_col).alias("text")), window, support, disclosure)
                  .select("term").distinct(), "pii_terms")
    bitmap = C.key_filter(terms)
    extra = [(key, "long"), (out_col, SPANS), (hits, HITS), (text, "string"), (finish_col, "string")]
    kinds = C.arrow_schema(f"spans {SPANS}, hits {HITS}")

    def scan(batches):
        wanted = TermFilter(bitmap)
        for batch in batches:
            for part in C.slices(batch, text, 1 << 21):
                base, found, keys, left, done = [], [], [], [], []
                for raw in part.column(text).to_pylist():
                    t = raw or ""
                    spans = entities(t)
                    base.append([dict(kind=k, start=s, end=e) for k, s, e in spans])
                    words = wanted(dict.fromkeys(TERM.findall(t))) if not wanted.idle else {}
                    covered = Covered(spans)
                    found.append([dict(term=words[m[0]], start=m.start(), end=m.end())
                                  for m in TERM.finditer(t) if m[0] in words
                                  and not covered(m.start(), m.end())] if words else [])
                    keys.append(xxhash.xxh64_intdigest(t) - (1 << 63))
                    left.append(raw if found[-1] and finish else None)
                    done.append(finish(raw, base[-1]) if finish and not found[-1] else None)
                part = part.drop_columns([text])
                for name, values, kind in ((key, keys, pa.int64()), (out_col, base, kinds.field("spans").type),
                                           (hits, found, kinds.field("hits").type), (text, left, pa.string()),
                                           (finish_col, done, pa.string())):
                    part = C.with_column(part, name, pa.array(values, kind))
                yield part

    schema = StructType([*(docs.schema[c] for c in carry), *(C.schema_with(docs, [], *e).fields[0] for e in extra)])
    found = C.cut(given.mapInArrow(scan, schema), "pii_found")
    plain, told = found.where(F.size(hits) == 0), found.where(F.size(hits) > 0)
    # hits that only passed the filter go here; rows of equal text share theirs
    sure = (told.select(key, F.explode(hits).alias("hit")).select(F.col(key).alias("key"), "hit.*")
            .join(terms, "term", "left_semi")
            .groupBy("key").agg(F.array_sort(F.collect_set(F.struct(
                F.lit("term").alias("kind"), "start", "end"))).alias("terms")))
    told = told.join(sure, F.col(key) == F.col("key"), "left").withColumn(
        out_col, F.concat(out_col, F.coalesce(sure["terms"], F.array().cast(SPANS))))
    told = told.select(*carry, out_col, text)

    def settle(batches):
        for batch in batches:
            for part in C.slices(batch, text, 1 << 21):
                done = [finish(*row) for row in zip(*(part.column(c).to_pylist() for c in (text, out_col)))]
                yield C.with_column(part.drop_columns([text]), finish_col, pa.array(done, pa.string()))

    if finish is not None:
        told = told.mapInArrow(settle, StructType([*told.drop(text).schema.fields,
                                                   *C.schema_with(docs, [], finish_col, "string").fields]))
    return plain.select(*carry, *out).unionByName(told.select(*carry, *out))


class Covered:
    """Whether a place meets one of some spans."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.spans = sorted((s, e) for _, s, e in spans)
        self.upto = [*accumulate((e for _, e in self.spans), max)]

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_left(self.spans, (end,))
        return k > 0 and self.upto[k - 1] > start


def generalised(text: str | None, spans: list[dict]) -> str | None:
    """The text with entities as their kind and without terms."""
    return text and C.rewritten(text, [
        (s["start"], s["end"], "" if s["kind"] == "term" else f"<{s['kind'].upper()}>") for s in spans])


def sanitise(docs: DataFrame, text_col: str = "text", window: int = WINDOW, support: int = SUPPORT,
             disclosure: float = DISCLOSURE) -> DataFrame:
    """``docs`` with entities generalised to ``<KIND>`` and disclosing terms removed;
    overlapping spans go as one. A row carries its spans, so ids may be missing or
    repeat. Null texts stay null."""
    found = find_personal_data(docs, text_col=text_col, window=window, support=support, disclosure=disclosure,
                               carry=docs.columns, out_col=C.OWN + "spans", finish=generalised, finish_col=text_col)
    return found.select(*docs.columns)


def clean_digest(text: str | None, spans: list[dict]) -> str:
    return sha256((generalised(text, spans) or "").encode()).hexdigest()


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(C.table(spark, sf_dir, "documents"), finish=clean_digest, finish_col="clean_sha256")
    spans = F.col("spans")
    return found.select(
        "doc_id", *[F.size(C.of_kinds(spans, k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(C.span_text(C.of_kinds(spans, *KINDS)), 256).alias("base_sha256"),
        C.span_text(spans).alias("spans"), F.size(C.of_kinds(spans, "term")).cast("long").alias("n_term"),
        "clean_sha256")
