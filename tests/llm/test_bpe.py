import hashlib
import random
import time
from functools import lru_cache

import numpy as np
import pytest
import tiktoken
from llm_rows import ODD, documents
from pyspark.sql import functions as F

from strata.llm import bpe
from strata.llm.queries import QUERIES

PATH, PATTERN = bpe.tokenizer()
SMALL = {bytes([b]): b for b in range(256)} | {
    # xyz comes from yz, yet wxyz has a lower rank than xyz: a merge may put a lower rank in front
    w: 256 + k for k, w in enumerate([b"aa", b"yz", b"wxyz", b"xyz", b"aaa", b"ab", b"aaaa", b"ba", b"abab", b"zz"])}


@lru_cache
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.vocabulary(PATH).ranks, special_tokens={})


def tiktoken_ids(text):
    return encoding().encode_ordinary(text)


def own_ids(encoder, text):
    return np.frombuffer(encoder([text])[0], dtype="<u4").tolist()


def plain(ranks, word):
    """Merges by looking at every pair each time."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_queue_gives_ranks_in_order():
    queue, rng = bpe.RankQueue(), random.Random(1)
    ranks = {rng.randrange(1 << 18) for _ in range(2000)}
    for r in ranks:
        queue.put(r, [r])
        queue.put(r, [0])
    out = []
    while (r := queue.take())[0] >= 0:
        assert r[1] == [r[0], 0]
        out.append(r[0])
    assert out == sorted(ranks)


@pytest.mark.parametrize("seed", range(5))
def test_merges_equal_plain_search(seed):
    rng, known = random.Random(seed), bpe.Vocabulary(SMALL)
    words = ["".join(rng.choices("aabwxyzz", k=rng.randint(1, 40))).encode() for _ in range(300)]
    got = [np.frombuffer(i, dtype="<u4").tolist() for i in known.encode(words)]
    assert got == [plain(SMALL, w) for w in words]
    assert [known.decode(i) for i in known.encode(words)] == words


@pytest.mark.parametrize("seed", range(4))
def test_ids_are_tiktoken_s(seed):
    rng, encoder = random.Random(seed), bpe.Encoder(bpe.vocabulary(PATH), PATTERN, memory=500)
    parts = ["the", " of", "Quick", "n't", "'s", "'RE", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "1", "２", "é",
             "漢字", "한국어", "\U0001F600", "़", "<|endoftext|>", "_", "==", "#!", "\x00", "İ", "ß", "a" * 90, "᠎", "​"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert own_ids(encoder, text) == tiktoken_ids(text), text


def test_every_character_is_split_as_tiktoken_does():
    encoder = bpe.Encoder(bpe.vocabulary(PATH), PATTERN)
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x1FB00), 0x20000, 0xE0001]]
    for at in range(0, len(chars), 4096):
        text = "".join(f"x{c}x {c}{c}1" for c in chars[at:at + 4096])
        assert own_ids(encoder, text) == tiktoken_ids(text), at


def test_long_pre_tokens():
    rng, encoder = random.Random(3), bpe.Encoder(bpe.vocabulary(PATH), PATTERN)
    for text in ("a" * 20_000, "".join(rng.choices("etaoinshr", k=20_000)), " " * 5000, "-=" * 4000, "é漢" * 3000):
        assert own_ids(encoder, text) == tiktoken_ids(text)


def test_steps_grow_with_length():
    known, rng = bpe.vocabulary(PATH), random.Random(5)

    def seconds(n):
        word = "".join(rng.choices("etaoinshrdlu", k=n)).encode()
        begin = time.process_time()
        known.merge([word])
        return time.process_time() - begin

    seconds(1000)
    assert seconds(400_000) < 40 * max(seconds(40_000), 0.01)


def test_memory_in_two_generations():
    encoder = bpe.Encoder(bpe.vocabulary(PATH), PATTERN, memory=20)
    for k in range(200):
        text = f" word{k} again x{k % 7}y"
        assert own_ids(encoder, text) == tiktoken_ids(text)
        assert len(encoder.newer) <= 20 and len(encoder.older) <= 20
    some = [f" one{k} two x{k % 5}" for k in range(30)]
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder(some)] == [tiktoken_ids(t) for t in some]
    many = " ".join(f"w{k}" for k in range(300))
    assert own_ids(encoder, many) == tiktoken_ids(many)


def test_refuses_ranks_it_cannot_hold():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):
        bpe.Vocabulary({bytes([b]): b for b in range(256)} | {b"ab": 1 << 18})


def test_query_against_tiktoken(spark):
    from conftest import SF_SMALL
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_rank_queue_bpe"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = tiktoken_ids(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_and_empty_table(spark):
    ids = bpe.encode(documents(spark, ODD), PATH, PATTERN, out_col="kind")
    back = bpe.numbers(bpe.decode(ids, PATH, "kind", out_col="row"), "kind").collect()
    assert len(back) == len(ODD)
    for r in back:
        assert bytes(r["row"]).decode() == (r["text"] or "")
        assert r["kind"] == tiktoken_ids(r["text"] or "")
        assert r["id"] == "x" and r["h1"] == 1
    assert bpe.decode(bpe.encode(documents(spark, []), PATH, PATTERN), PATH).count() == 0
    null = bpe.encode(documents(spark, ODD[:2]), PATH, PATTERN).withColumn("ids", F.lit(None).cast("binary"))
    assert [bytes(r["raw"]) for r in bpe.decode(null, PATH).collect()] == [b"", b""]
