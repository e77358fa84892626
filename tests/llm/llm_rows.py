"""Documents for the tests of the training-data operators."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, spans string, kind string, h1 long, k1 string, bits string, slot string, row string, deleted string")


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with columns whose names clash
    with those the operators use inside."""
    full = []
    for r in rows:
        doc, text, lang, source = (*r, *("en", "s")[len(r) - 2:]) if len(r) < 4 else r
        full.append((doc, text, lang, source, None if text is None else len(text), *["x"] * 3, 1, *["x"] * 5))
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    """``n`` words that hardly any other seed shares five of."""
    rng = random.Random(seed)
    parts = "an ber con de en fi gor hal in jo ka lem mi no os per qui ra so ti un ve wi".split()
    return [rng.choice(parts) + rng.choice(parts) + rng.choice(parts) for _ in range(n)]


ODD = [(None, None, None, None), (1, None, "en", "s"), (2, "", "en", None), (3, " \n\t\n ", None, "s"),
       (4, "word", "en", "s"), (5, "word", "en", "s"), (5, "word", "en", "s"), (None, "word", "en", "s"),
       (6, "x" * 200_000, "en", "s"), (7, "a b c d e\n" * 5000, "en", "s"),
       (8, "\x00   \U0001F600 é ß", "de", "t"), (-9, "1 " * 3000, "fr", "t")]
