"""Secret scan by dictionary-primed compression (operator 2).

Fixed patterns find the base spans. Beside them, every long string that
follows a sensitive word, on its line or soon after, and the body of every
private key block is a candidate: its novelty is the number of bytes a
zstandard frame of the surrounding code grows by when the candidate is put in,
with a dictionary of the corpus' identifiers primed. Names and prose shrink
against the dictionary and the surroundings, a random key does not, so a
candidate whose marginal bytes stay above a share of its length is reported.
Candidates and copies of the string itself are no surroundings: only other text
makes a candidate cheap.

Null texts read as empty; an empty table gives no rows; repeated rows each give
their own row; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

# The patterns of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# [0-9a-f]+ of 16 characters or more: a shorter run ends where a longer could
# not begin, so the bound inside the pattern finds the same matches.
HEX = re.compile(r"[0-9a-f]{16,}")

#: Words after which a string counts as sensitive: whole ones, or between the
#: humps of a camel-case name.
HUMP = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
CONTEXT = re.compile(rf"(?:(?<![A-Za-z])|{HUMP})(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_\x20-]?key|"
                     r"private[_\x20-]?key|access[_\x20-]?key|credentials?|authorization|bearer|signature)"
                     rf"(?:(?![A-Za-z])|{HUMP})", re.ASCII)
CONTEXT_WORDS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "authorization",
                 "bearer", "signature")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PEM = re.compile(r"-----BEGIN [A-Z0-9\x20]{0,40}PRIVATE KEY(?: BLOCK)?-----")
#: The body of a block whose end is missing: strings with only space between.
PEM_LINES = re.compile(r"(?:(?:\s|\\[nr])*[A-Za-z0-9+/=]{16,})+")
IDENTIFIER = re.compile(r"[A-Za-z_]{3,24}")

#: Characters after a sensitive word in which a candidate may begin.
REACH = 64
#: Characters of surrounding text on each side of a candidate.
SURROUND = 256
#: Identifiers in the dictionary, the most frequent ones (a bound on the model).
DICTIONARY_SIZE = 4096
#: Least marginal compressed bytes per character of a secret. Hex digits carry
#: 0.5 bytes, base64 0.75; words against the dictionary 0.1 to 0.35.
NOVELTY = 0.45

SPANS = "array<struct<kind:string,start:int,end:int,novelty:double>>"
ORDER = {"assign": 0, "access": 1, "hex": 2, "novel": 3}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def pem_bodies(text: str) -> list[tuple[int, int]]:
    """What stands between the lines of each private key block."""
    found = []
    head = PEM.search(text)
    while head:
        start, after = head.end(), PEM.search(text, head.end())
        upto = after.start() if after else len(text)
        end = text.find("-----END", start, upto)
        if end < 0:
            lines = PEM_LINES.match(text, start, upto)
            end = lines.end() if lines else start
        body = text[start:end]
        start, end = start + len(body) - len(body.lstrip()), start + len(body.rstrip())
        if end - start >= 16:
            found.append((start, end))
        head = after
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    """Long strings that begin within reach of a sensitive word, on its line or
    a later one, and the bodies of private key blocks."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    bodies = pem_bodies(text)
    found = {}
    for word in CONTEXT.finditer(text):
        last = word.end() + REACH
        at = word.end()
        while (m := CANDIDATE.search(text, at, last + 15)) and m.start() < last:
            m = CANDIDATE.match(text, m.start())  # all of it
            found[m.span()] = None
            at = m.end()
    strings = sorted(found)
    if bodies:
        starts = [s for s, _ in bodies]
        strings = [(s, e) for s, e in strings if not ((i := bisect_right(starts, s)) and s < bodies[i - 1][1])]
    return sorted(strings + bodies)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint spans. ``spans``: sorted."""
    out = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def surroundings(text: str, start: int, end: int, taken: list[tuple[int, int]]) -> tuple[str, str]:
    """The text on each side without copies of the candidate and without the
    places ``taken`` by candidates (disjoint and sorted)."""
    low, high, own = max(0, start - SURROUND), min(len(text), end + SURROUND), text[start:end]
    cuts = []
    for at in range(bisect_right(taken, low, key=lambda s: s[1]), len(taken)):
        if taken[at][0] >= high:
            break
        cuts.append(taken[at])
    # a copy may lie across the edge
    for at, upto in ((max(0, low - len(own) + 1), start), (end, high + len(own) - 1)):
        while (at := text.find(own, at, upto)) >= 0:
            cuts.append((at, at + len(own)))
            at += len(own)

    def left(at: int, upto: int) -> str:
        parts = []
        for s, e in merged(sorted(cuts)):
            if e > at and s < upto:
                parts.append(text[at:max(at, s)])
                at = e
        return "".join([*parts, text[at:upto]])

    return left(low, start), left(end, high)


def identifier_dictionary(docs: DataFrame, size: int = DICTIONARY_SIZE) -> bytes:
    """The ``size`` most frequent identifiers around the candidates of all
    documents, rarest first (zstandard prefers what stands last)."""
    def count(batch):
        seen = Counter()
        for text in C.texts(batch):
            found = candidates(text)
            taken = merged(found)
            for start, end in found:
                for part in surroundings(text, start, end, taken):
                    seen.update(IDENTIFIER.findall(part))
        return {"word": list(seen), "n": list(seen.values())}

    words = C.map_batches(docs.select("text"), count, "word string, n long")
    top = (words.groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(size).toArrow())
    return " ".join(reversed(top.column("word").to_pylist())).encode()


class Novelty:
    """Marginal compressed bytes per character against surroundings and dictionary."""

    def __init__(self, dictionary: bytes):
        primed = {}
        if len(dictionary) >= 8:
            primed["dict_data"] = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.frame = zstandard.ZstdCompressor(level=12, write_content_size=False, **primed)

    def __call__(self, text: str, start: int, end: int, taken: list[tuple[int, int]]) -> float:
        before, after = surroundings(text, start, end, taken)
        without = len(self.frame.compress((before + after).encode()))
        return (len(self.frame.compress((before + text[start:end] + after).encode())) - without) / (end - start)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = NOVELTY, dictionary_size: int = DICTIONARY_SIZE,
                 carry: list[str] | None = None, out_col: str = "spans") -> DataFrame:
    """One row per row of ``docs``: its columns ``carry`` (its id by default) and
    ``out_col`` (in place of any column of that name), the spans by start, then kind.

    Kinds are the base ones (assign, access, hex) and ``novel``, an
    incompressible string in a sensitive context that no base span covers.
    """
    carry = [c for c in ([id_col] if carry is None else carry) if c != out_col]
    text = C.OWN + "text"
    read = text_col if text_col in carry else text
    given = docs.select(*carry, *([] if read == text_col else [F.col(text_col).alias(text)]))
    dictionary = identifier_dictionary(docs.select(F.col(text_col).alias("text")), dictionary_size)
    kind = C.arrow_schema(f"spans {SPANS}").field("spans").type

    def spans_of(text: str, novelty: Novelty) -> list[dict]:
        spans = [(*s, None) for s in base_spans(text)]
        found = candidates(text)
        taken = merged(found)
        for start, end in found:
            if any(s <= start and end <= e for _, s, e, _ in spans):
                continue
            if (score := novelty(text, start, end, taken)) >= threshold:
                spans.append(("novel", start, end, score))
        spans.sort(key=lambda s: (s[1], ORDER[s[0]]))
        return [dict(zip(("kind", "start", "end", "novelty"), s)) for s in spans]

    def scan(batches):
        novelty = Novelty(dictionary)
        for batch in batches:
            for part in C.slices(batch, read, 1 << 21):
                spans = pa.array([spans_of(t, novelty) for t in C.texts(part, read)], kind)
                yield C.with_column(part if read == text_col else part.drop_columns([text]), out_col, spans)

    return given.mapInArrow(scan, C.schema_with(docs, carry, out_col, SPANS))


def redact(docs: DataFrame, text_col: str = "text", threshold: float = NOVELTY,
           dictionary_size: int = DICTIONARY_SIZE) -> DataFrame:
    """``docs`` with every secret found in a row's text replaced by ``<SECRET>``; the
    row carries its spans, so ids may be missing or repeat. Null texts stay null."""
    spans = C.OWN + "spans"
    found = find_secrets(docs, text_col=text_col, threshold=threshold, dictionary_size=dictionary_size,
                         carry=docs.columns, out_col=spans)
    return C.rewrite(found, text_col, spans, lambda kind: "<SECRET>")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(C.table(spark, sf_dir, "documents"), carry=["doc_id", "text"])
    clean = C.rewrite(found.withColumn("cut", F.col("spans")), "text", "cut", lambda kind: "<SECRET>")
    count = lambda kind: F.size(C.of_kinds(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
    return clean.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(C.span_text(C.of_kinds(F.col("spans"), "assign", "access", "hex")), 256).alias("base_sha256"),
        C.span_text(F.col("spans")).alias("spans"), count("novel"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("clean_sha256"))
