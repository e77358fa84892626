import math
import random
from collections import Counter, defaultdict

import zstandard
from llm_rows import ODD, documents, prose
from pyspark.sql import functions as F

from strata.llm import quality
from strata.llm.queries import QUERIES

N = quality.ORDER


def grams(text, n=N):
    padded = "\x00" * (N - 1) + text + "\x01"
    return [padded[i - n + 1:i + 1] for i in range(N - 1, len(padded))]


class Brute:
    """Interpolated modified Kneser-Ney, straight from its definition."""

    def __init__(self, texts):
        self.counts = {N: Counter(g for t in texts for g in grams(t))}
        for n in range(N - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.d, self.by_history = {}, {}
        for n, counts in self.counts.items():
            many = Counter(counts.values())
            n1, n2, n3, n4 = (max(many[k], 1) for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            self.d[n] = [min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)]
            self.by_history[n] = defaultdict(list)
            for g, c in counts.items():
                self.by_history[n][g[:-1]].append(c)

    def p(self, g):
        n = len(g)
        low = self.p(g[1:]) if n > 1 else 1 / (len(self.counts[1]) + 1)
        seen = self.by_history[n].get(g[:-1])
        if not seen:
            return low
        c, d = self.counts[n][g], self.d[n]
        return (max(0, c - d[min(c, 3) - 1]) if c else 0) / sum(seen) + sum(d[min(x, 3) - 1] for x in seen) / sum(seen) * low

    def bits(self, text):
        return -sum(math.log2(self.p(g)) for g in grams(text)) / (len(text) + 1)


def test_gram_codes():
    texts = ["abc", "", "é漢\U0001F600", "x" * 9]
    codes, begins = quality.gram_codes([t for t in texts])
    code = lambda g: sum(min(ord(c), quality.OTHER) << (quality.BITS * (N - 1 - i)) for i, c in enumerate(g))
    assert codes.tolist() == [code(g) for t in texts for g in grams(t)]
    assert begins.tolist() == [0, 4, 5, 9]


def test_scores_match_the_definition(spark):
    rng = random.Random(0)
    rows = [(i, " ".join(prose(i, rng.randint(1, 30))) + "é" * (i % 3), "ab"[i % 2]) for i in range(60)]
    rows += [(100, "ZZZ!! ???", "a"), (101, "qwx" * 50, "b"), (102, "unseen language", "c"), (103, "", "a"), (104, None, "a")]
    docs = documents(spark, rows)
    trusted = spark.createDataFrame([(i,) for i in range(0, 60) if i % 5], "doc_id long")
    got = {r["doc_id"]: r["bits"] for r in quality.score(docs, trusted, block_bytes=900).rows(["doc_id"], "bits").collect()}
    models = {x: Brute([t for i, t, lang in rows if lang == x and i < 60 and i % 5]) for x in "ab"}
    for doc, text, lang in rows:
        if not text:
            assert got[doc] is None
        elif lang in models:
            assert abs(got[doc] - models[lang].bits(text)) < 1e-4, doc
        else:
            assert abs(got[doc] - quality.BITS) < 1e-4


def test_scripts_beyond_the_code_range(spark):
    rng = random.Random(4)
    words = ["".join(chr(rng.randint(0xAC00, 0xD7A3)) for _ in range(3)) for _ in range(40)]
    words += ["".join(chr(rng.randint(0x8000, 0x9FA5)) for _ in range(2)) for _ in range(20)] + ["\U0001F600\U0001F680", "\u7ffe\u7fff"]
    rows = [(i, " ".join(rng.choices(words, k=20)), "ko") for i in range(80)]
    junk = "".join(rows[0][1])
    rows += [(100, "".join(rng.sample(junk, len(junk))), "ko"), (101, "\u7ffd\u7ffc unseen \U0001F923", "ko")]
    trusted = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r["doc_id"]: r["bits"] for r in quality.score(documents(spark, rows), trusted, block_bytes=900).rows(["doc_id"], "bits").collect()}
    model = Brute([t for i, t, _ in rows if i < 60])
    assert all(abs(got[i] - model.bits(t)) < 1e-4 for i, t, _ in rows)
    assert got[100] > max(got[i] for i in range(80)) + 1


def test_alphabets_spell_no_two_characters_the_same():
    chars = [*range(0xE0, 0x180), *range(0x8000, 0x9000), *range(0x1F600, 0x1F640)]
    for room in (quality.OTHER - 128, 2048 + 100):
        spell = quality.Alphabets({"x": quality.np.array(chars)}, room)
        spelled = spell("x", [chr(c) for c in chars] + ["abc", "\u7ffe"])
        assert len(set(spelled[:len(chars)])) == len(chars) and spelled[len(chars)] == "abc"
        assert all(ord(c) < quality.OTHER for t in spelled[:len(chars)] for c in t)
        assert spelled[-1] == chr(quality.OTHER)
        assert all(len(t) == 1 for t in spelled[:100])
    assert spell("y", ["\uac00"]) == ["\uac00"]


def test_probabilities_add_up(spark):
    texts = [" ".join(prose(i, 20)) for i in range(10)]
    pack = zstandard.ZstdCompressor().compress
    model = quality.train(spark.createDataFrame([("a", pack(t.encode())) for t in texts], "lang string, text binary"))
    letters = sorted(set("".join(texts)) | {"\x01"})
    code = lambda g: sum(ord(c) << (quality.BITS * (N - 1 - i)) for i, c in enumerate(g))
    histories = [texts[0][i:i + N - 1] for i in (0, 7, 20)] + ["z" * (N - 1), "\x00" * (N - 1)]
    wanted = spark.createDataFrame([("a", code(h + c)) for h in histories for c in [*letters, "\x00"]], "lang string, g long")
    by_history = Counter()
    for r in quality.probabilities(model, wanted).collect():
        by_history[r["g"] >> quality.BITS] += 2 ** r["logp"]
    # the letters, and one share of the uniform base for all that was never seen
    assert all(abs(p - 1) < 1e-6 for p in by_history.values())


def test_blocks_are_bounded_by_bytes(spark, tmp_path):
    """Few long texts or many short ones: a block closes at its bytes, and every row stands in one."""
    long, size = [(i, "".join(prose(i, 20_000)), "en") for i in range(40)], quality.STRETCH
    rows = long + [(100 + i, " ".join(prose(i, 5)), "fr") for i in range(3000)]
    docs = documents(spark, rows).coalesce(2).select("doc_id", "text", F.col("lang").alias(quality.LANG))
    path = str(tmp_path / "blocks")
    quality.in_blocks(docs, "text", block_bytes=4 * size).write.parquet(path)
    blocks = spark.read.parquet(path)
    bytes_, seen, places = Counter(), [], defaultdict(list)
    for r in blocks.where(F.col(quality.NO).isNotNull()).collect():
        assert r[quality.GRAMS] is None
        bytes_[r[quality.BLOCK]] += len(r["text"])
        places[r[quality.BLOCK]].append(r[quality.NO])
        seen.append(r["doc_id"])
    assert sorted(seen) == sorted(i for i, *_ in rows)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # a block closes with the run of rows that fills it
    assert len(bytes_) > 2 and max(bytes_.values()) <= 5 * size
    asked = {(r["block"], r["lang"]) for r in quality.requests(blocks).collect()}
    assert {b for b, _ in asked} == set(bytes_)


def test_junk_goes_and_clean_documents_stay(spark):
    rows = [(i, " ".join(prose(i, 60)), "en" if i % 2 else "fr") for i in range(1400)]
    rows += [(2000 + i, " ".join(w.upper() + "!!" for w in prose(5000 + i, 40)), "en") for i in range(20)]
    rows += [(3000, "###", "xx"), (3001, " ".join(prose(1, 50)), "few")]
    trusted = spark.createDataFrame([(i,) for i in range(1200)], "doc_id long")
    docs = documents(spark, rows)
    out = quality.classify(docs, trusted)
    assert out.columns == [*docs.columns, "quality"]
    kept = {r["doc_id"]: r["quality"]["kept"] for r in out.collect()}
    assert len(kept) == len(rows) and all(kept[i] for i in range(1400))
    assert not any(kept[2000 + i] for i in range(20)) and not kept[3000]


def test_odd_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    some = spark.createDataFrame([(4,), (5,), (None,), (77,)], "doc_id long")
    for trusted in (none, some):
        out = quality.classify(documents(spark, ODD), trusted).collect()
        assert len(out) == len(ODD)
        assert all(r["quality"]["kept"] for r in out)
        assert all(r["quality"]["perplexity"] is None for r in out if not r["text"])
    assert quality.classify(documents(spark, []), some).count() == 0


def test_query_covers_every_document(spark):
    from conftest import SF_SMALL
    out = QUERIES["op1_kneser_ney"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert out.count() == docs.count() and out.where("perplexity is null").count() == 0


def test_texts_are_not_shuffled(spark):
    rows = [(i, " ".join(prose(i, 30)), "en") for i in range(60)]
    trusted = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    told = quality.score(documents(spark, rows), trusted, block_bytes=900)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = told.rows(["doc_id"], "bits")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "Python" not in plan
