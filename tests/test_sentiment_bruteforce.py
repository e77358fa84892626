"""The MLlib sentiment path and the table of weights against brute-force scorers.

The pipeline's predictions are recomputed without Spark: tokens split on
white space, hashed with MurmurHash3 (x86, 32 bit, seed 42) into the model's
feature space, term counts scaled by the fitted IDF weights, and the class with
the largest ``log prior + theta . x`` wins. The table's weights are recomputed
from their definition over the words of a small labelled set.
"""

import math
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from strata.fixtures import Fixture
from strata.operators import nlp, sentiment
from strata.plans.registry import all_queries

SEED = 42
QUERIES = {name: q.build for name, q in all_queries().items()}


def murmur3_32(data: bytes, seed: int = SEED) -> int:
    """MurmurHash3 x86 32-bit of ``data``, as a signed int."""
    c1, c2, mask = 0xCC9E2D51, 0x1B873593, 0xFFFFFFFF
    h = seed & mask
    n_blocks = len(data) // 4
    for i in range(n_blocks):
        k = int.from_bytes(data[4 * i:4 * i + 4], "little")
        k = (k * c1) & mask
        k = ((k << 15) | (k >> 17)) & mask
        k = (k * c2) & mask
        h ^= k
        h = ((h << 13) | (h >> 19)) & mask
        h = (h * 5 + 0xE6546B64) & mask
    tail = data[4 * n_blocks:]
    k = 0
    for i, b in enumerate(tail):
        k |= b << (8 * i)
    if tail:
        k = (k * c1) & mask
        k = ((k << 15) | (k >> 17)) & mask
        k = (k * c2) & mask
        h ^= k
    h ^= len(data)
    h ^= h >> 16
    h = (h * 0x85EBCA6B) & mask
    h ^= h >> 13
    h = (h * 0xC2B2AE35) & mask
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def test_murmur3_reference_values():
    # published test vectors of MurmurHash3_x86_32
    assert murmur3_32(b"", 0) == 0
    assert murmur3_32(b"", 1) == 0x514E28B7
    assert murmur3_32(b"hello", 0) == 0x248BFA47
    assert murmur3_32(b"The quick brown fox jumps over the lazy dog", 0x9747B28C) == 0x2FA826CD


def brute_force_predictions(model, texts):
    hashing, idf, nb = model.stages[1], model.stages[2], model.stages[3]
    n = hashing.getNumFeatures()
    weights = idf.idf.toArray()
    pi, theta = nb.pi.toArray(), nb.theta.toArray()
    out = []
    for text in texts:
        x = np.zeros(n)
        for token in text.split(" "):   # cleaned text is single-spaced and trimmed
            x[murmur3_32(token.encode("utf-8")) % n] += 1.0
        raw = pi + theta @ (x * weights)
        out.append(float(np.argmax(raw)))
    return out


def test_pipeline_equals_brute_force(spark):
    f = Fixture(spark, SF_SMALL)
    model = nlp.train_sentiment(f.table("documents"), f.table("labels"))
    scored = nlp.score_sentiment(nlp.clean_text(f.posts_kw(), "content"), model)
    rows = scored.select("text_clean", "sentiment").collect()
    want = brute_force_predictions(model, [r.text_clean for r in rows])
    assert [r.sentiment for r in rows] == want
    # both classes occur, so the check has teeth
    assert set(want) == {0.0, 1.0}


def brute_weights(train, smoothing=1.0):
    """{(feature, class): weight} by definition; train: [(words, class)]."""
    classes = Counter(c for _, c in train)
    df = Counter(w for ws, _ in train for w in set(ws))
    idf = {w: math.log((len(train) + 1) / (n + 1)) for w, n in df.items()}
    mass = Counter()
    for ws, c in train:
        for w in ws:
            mass[w, c] += idf[w]
    out = {}
    for c, n in classes.items():
        total = sum(m for (_, k), m in mass.items() if k == c)
        out["", c] = math.log((n + smoothing) / (len(train) + smoothing * len(classes)))
        for w in df:
            out[w, c] = idf[w] * math.log((mass[w, c] + smoothing) / (total + smoothing * len(df)))
    return out


TRAIN = [("good fine good day", 1.0), ("fine words", 1.0), ("bad day", 0.0), ("awful bad bad words", 0.0),
         ("", 0.0), ("plain day", 2.0), (None, 1.0)]


def test_weights_equal_their_definition(spark):
    train = spark.createDataFrame(TRAIN, "text_clean string, label double")
    got = {(r["feature"], r["class"]): r["weight"] for r in sentiment.fit_weights(train).collect()}
    want = brute_weights([((t or "").split(), c) for t, c in TRAIN])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_scores_of_odd_texts(spark):
    weights = sentiment.fit_weights(spark.createDataFrame(TRAIN, "text_clean string, label double"))
    want = brute_weights([((t or "").split(), c) for t, c in TRAIN])
    texts = ["good", "bad bad", "", None, "unknown words only here", "plain", "good bad"] * 2 + ["good " * 3000 + "bad"]
    rows = spark.createDataFrame([(i, t, 9.0) for i, t in enumerate(texts)], "id int, text_clean string, sentiment double")
    got = {r.id: r.sentiment for r in sentiment.score_by_weights(rows, weights).collect()}

    def best(text):
        words = [w for w in (text or "").split() if (w, 0.0) in want]
        score = {c: want["", c] + sum(want[w, c] for w in words) for c in (0.0, 1.0, 2.0)}
        return min(c for c in score if score[c] == max(score.values()))

    assert got == {i: best(t) for i, t in enumerate(texts)}
    # without labels there is nothing to tell
    none = sentiment.fit_weights(spark.createDataFrame([], "text_clean string, label double"))
    assert {r.sentiment for r in sentiment.score_by_weights(rows, none).collect()} == {None}


def test_content_is_cleaned_when_needed(spark):
    weights = sentiment.fit_weights(spark.createDataFrame(TRAIN, "text_clean string, label double"))
    rows = spark.createDataFrame([("GOOD!! https://x.example/bad",), (None,)], "content string")
    got = sentiment.score_by_weights(rows, weights).collect()
    assert [(r.text_clean, r.sentiment) for r in got if r.content] == [("good", 1.0)] and len(got) == 2


def test_report_of_a_confusion_matrix(spark):
    cells = spark.createDataFrame([(0.0, 0.0, 6), (0.0, 1.0, 2), (1.0, 1.0, 3), (2.0, 0.0, 1)],
                                  "label double, predicted double, n long")
    got = {r["class"]: r for r in sentiment.class_report(cells).collect()}
    assert (got[0.0]["support"], got[0.0]["predicted"], got[0.0]["hits"]) == (8, 7, 6)
    assert abs(got[0.0]["precision"] - 6 / 7) < 1e-12 and abs(got[0.0]["recall"] - 6 / 8) < 1e-12
    assert abs(got[0.0]["f1"] - 2 * 6 / 15) < 1e-12
    assert got[2.0]["recall"] == 0 and got[2.0]["precision"] == 0 and got[2.0]["f1"] == 0
    assert all(abs(r["accuracy"] - 9 / 12) < 1e-12 for r in got.values())


def test_held_out_labels_are_not_trained_on(spark):
    """The evaluation splits by the key's digest: the shares are as asked and disjoint."""
    keys = spark.range(4000)
    out = {r.id for r in keys.where(sentiment.held_out("id", 250)).collect()}
    assert 850 < len(out) < 1150
    assert not keys.where(sentiment.held_out("id", 0)).count()
    report = all_queries()["sentiment_eval"].build(spark, SF_SMALL).collect()
    f = Fixture(spark, SF_SMALL)
    held = f.table("labels").where(sentiment.held_out("doc_id", 250)).where("quality is not null")
    assert sum(r["support"] for r in report) == held.join(f.table("documents"), "doc_id").count()


def test_texts_are_read_once_for_a_fit(spark):
    """The labelled texts feed one count of words; totals and weights come from the stored counts."""
    train = spark.createDataFrame(TRAIN, "text_clean string, label double")
    plan = sentiment.fit_weights(train)._jdf.queryExecution().optimizedPlan().toString()
    assert "text_clean" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("head_words", [0, 1, 3, 1000])
def test_rare_words_score_as_frequent_ones(spark, head_words):
    """Few frequent words are broadcast, the others shuffled: scores are those of all the words."""
    train = [(f"good common w{k} v{k % 3}", 1.0) for k in range(20)] + [(f"bad common u{k} v{k % 4}", 0.0) for k in range(15)]
    weights = sentiment.fit_weights(spark.createDataFrame(train, "text_clean string, label double")).persist()
    want = brute_weights([(t.split(), c) for t, c in train])
    texts = [f"{a} {b} common u{k} w{k + 3} unknown" for k in range(12) for a in ("good", "bad", "v1") for b in ("u1", "w2 w2 w2", "")]
    texts = texts * 2 + ["", None, "unknown", "u1", "w1"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text_clean string")
    scored = sentiment.score_by_weights(rows, weights, head_words)
    assert ("BroadcastExchange" in scored._jdf.queryExecution().executedPlan().toString())

    def best(text):
        known = [w for w in (text or "").split() if (w, 0.0) in want]
        score = {c: want["", c] + sum(want[w, c] for w in known) for c in (0.0, 1.0)}
        return max((0.0, 1.0), key=lambda c: score[c])

    assert {r.id: r.sentiment for r in scored.collect()} == {i: best(t) for i, t in enumerate(texts)}
    weights.unpersist()


def test_a_text_is_digested_once_not_per_word(spark):
    """No digest is taken above the explode, where each word would take its whole text's."""
    train = spark.createDataFrame(TRAIN, "text_clean string, label double")
    rows = spark.createDataFrame([(1, "good bad")], "id int, text_clean string")
    scored = sentiment.score_by_weights(rows, sentiment.fit_weights(train))
    lines = scored._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line and "feature" in line)
    digests = [i for i, line in enumerate(lines) if "md5(" in line and "Project" in line]
    assert digests and min(digests) > at


@pytest.mark.parametrize("hot_words", [0, 2, 1000])
def test_frequent_words_are_told_without_a_row_each(spark, hot_words, monkeypatch):
    """Where there are rare words, no text is exploded; scores are those of all the words."""
    train = [(f"good common é{k % 2} w{k} v{k % 3}", 1.0) for k in range(20)] + [
        (f"bad common u{k} v{k % 4}", 0.0) for k in range(15)]
    weights = sentiment.fit_weights(spark.createDataFrame(train, "text_clean string, label double"))
    want = brute_weights([(t.split(), c) for t, c in train])
    texts = ["", None, "unknown", "  good   bad ", "é1 é1 bad", "common", "w1 w1 bad", " ", "u1 " * 500 + "good"]
    texts += [f"{a} common u{k} w{k + 3} v{k} unknown" for k in range(12) for a in ("good", "bad")]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "id int, text_clean string")
    monkeypatch.setattr(sentiment, "TOLD_AT_ONCE", 7)
    model = sentiment.tiers(weights, 12, hot_words)
    scored = sentiment.score_by_weights(rows, model)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan

    def best(text):
        known = [w for w in (text or "").split() if (w, 0.0) in want]
        score = {c: want["", c] + sum(want[w, c] for w in known) for c in (0.0, 1.0)}
        return max((0.0, 1.0), key=lambda c: score[c])

    assert {r.id: r.sentiment for r in scored.collect()} == {i: best(t) for i, t in enumerate(texts * 2)}


def test_texts_are_not_shuffled_for_their_digest(spark):
    """The digest is a column, so the cleaned text, which the silver rows do not hold, stays where it is read."""
    weights = sentiment.fit_weights(spark.createDataFrame(TRAIN, "text_clean string, label double"))
    f = Fixture(spark, SF_SMALL)
    for scored in nlp.sentiment_job(*nlp.keyword_job(f.posts().drop("sentiment"), f.comments().drop("sentiment")), weights):
        lines = scored._jdf.queryExecution().executedPlan().toString().splitlines()
        assert not [line for line in lines if "Exchange hashpartitioning(md5(" in line or "Sort [md5(" in line]


def test_repeated_rows_are_made_once(spark):
    """One row in 25 comes again an hour later, from one pass over the rows."""
    rows = [(None, "2024-01-01 00:00:00"), (25, "2024-01-01 00:00:00"), (25, None), (-50, "2024-01-01 23:30:00"),
            (0, "2024-01-02 00:00:00"), (7, "2024-01-03 00:00:00"), (7, None)]
    df = spark.createDataFrame(rows, "k long, t string").selectExpr("k", "to_timestamp(t) AS created_at", "k + 1 AS x")
    got = Fixture(spark, SF_SMALL)._repeated(df, "k")
    want = df.unionByName(df.where("k % 25 = 0").selectExpr("k", "created_at + INTERVAL 1 HOUR AS created_at", "x"))
    assert got.schema == want.schema and got.count() == want.count() == 11
    assert not got.exceptAll(want).count() and not want.exceptAll(got).count()
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
