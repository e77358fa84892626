"""Text expressions: cleaning and keyword tagging, as pure Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four keyword groups the tagger assigns, in order.
KEYWORD_GROUPS: tuple[tuple[str, ...], ...] = (
    ("ai", "machine learning", "innovation"),
    ("sports", "football", "health"),
    ("travel", "food", "culture"),
    ("technology", "mobile", "data"),
)

# The cleaning patterns (Java regex syntax).
URL_PATTERN = r"https?://\S+"
# Replacing runs of non-word characters by a space and then runs of white space
# by a space turns every maximal run of characters that are not letters or
# digits into one space; one pass with this pattern gives the same string.
NON_ALNUM_RUN = r"[^\p{L}\p{N}]+"


def clean_text_col(text: Column | str) -> Column:
    """Normalise free text for tokenising.

    NULL or the literal ``nan`` (any case) become the empty string; then
    lower-case, strip http(s) URLs, turn every run of characters that are not
    letters, digits or whitespace into one space, collapse whitespace, trim.
    """
    raw = (F.col(text) if isinstance(text, str) else text).cast("string")
    # lower-casing never shortens a string, so only a 3-character value can be
    # "nan": the length test spares long texts a second lower-casing pass
    is_nan = (F.length(raw) == 3) & (F.lower(raw) == F.lit("nan"))
    safe = F.when(raw.isNull() | is_nan, F.lit("")).otherwise(raw)
    out = F.regexp_replace(F.lower(safe), URL_PATTERN, "")
    return F.trim(F.regexp_replace(out, NON_ALNUM_RUN, " "))


def keyword_bucket(key: Column | str, n_buckets: int) -> Column:
    """A stable bucket in ``[0, n_buckets)`` from the md5 of the key's text.

    Deterministic, so a retried task tags a row exactly as the first attempt
    did; the same function is expressible in SQL for the oracle.
    """
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    head = F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(n_buckets)).cast("int")


def keyword_group_col(key: Column | str,
                      groups: Sequence[Sequence[str]] = KEYWORD_GROUPS) -> Column:
    """The keyword array picked for a row by :func:`keyword_bucket`."""
    choices = F.array(*[F.array(*[F.lit(w) for w in g]) for g in groups])
    bucket = keyword_bucket(key, len(groups))
    # explicit NULL guard: element_at on a literal array does not return NULL
    # for a NULL index in every code path
    return F.when(bucket.isNotNull(), F.element_at(choices, bucket + 1))
