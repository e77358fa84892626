import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from llm_rows import ODD, documents
from tokenizers import Tokenizer

from strata.llm import align as L
from strata.llm.queries import QUERIES

A_PATH, B_PATH = L.tokenizers()


def plain_groups(ends_a, ends_b):
    """Cuts where both end."""
    cuts = sorted(set(ends_a) & set(ends_b))
    return tuple([bisect_left(cuts, e) for e in ends] for ends in (ends_a, ends_b))


def tokenised(texts):
    """By definition: (ids, ends) of A and B of each text, or nothing."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    letters = L.byte_alphabet()
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    out = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            out.append(None)
        else:
            out.append((ids_a, np.cumsum([len(r) for r in raw_a]).tolist(),
                        ids_b, np.cumsum([len(r) for r in raw_b]).tolist()))
    return out


def brute_force(rows):
    """rows: (doc_id, text)."""
    found, count = [], Counter()
    for one in tokenised([t or "" for _, t in rows]):
        groups = defaultdict(lambda: ([], []))
        if one:
            ga, gb = plain_groups(one[1], one[3])
            for i, g in zip(one[0], ga):
                groups[g][0].append(i)
            for i, g in zip(one[2], gb):
                groups[g][1].append(i)
        groups = [groups[g] for g in sorted(groups)]
        found.append(groups)
        count.update({(a, b) for xs, ys in groups for a in xs for b in ys})
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, _), groups in zip(rows, found):
        links = [(a, b) for xs, ys in groups for a in xs for b in ys]
        told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

TEXTS = ["The quick brown fox", "the quick brown fox", "unbelievable internationalisation", "a▁b", "  leading", "trailing  ",
         "tab\tand\nnewline\r\n\r\n", "\U0001F600\U0001F601 emoji", "漢字かな交じり文", "<s> </s> <unk> <|endoftext|> <0x41>",
         "é combining é", "\x00\x01", "ﬁ ligature １２", "x" * 3000, "    " * 200, "1234567890" * 50, " ", "\n", "　", "’’’"]


@pytest.mark.parametrize("seed", range(10))
def test_groups_end_where_both_end(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 200)
    ends = [sorted({n, *rng.choices(range(1, n + 1), k=rng.randint(0, n))}) for _ in "ab"]
    lasts = L.group_ends(*(np.array(e) for e in ends))
    for last, group in zip(lasts, plain_groups(*ends)):
        assert (np.cumsum(last) - last).tolist() == group
    assert [x.tolist() for x in L.group_ends(np.array([], int), np.array([], int))] == [[], []]


def test_links_in_small_runs(monkeypatch):
    """Documents and groups that are cut by the runs count once."""
    texts = TEXTS + ["x" * 3000 + " y"] * 2
    found = L.aligned(texts, *L.tokenizer_pair(A_PATH, B_PATH))
    whole = Counter()
    for d, p, t in found.pairs():
        whole.update(dict(zip(zip(d.tolist(), p.tolist()), [0] * len(d))))
        for k, n in zip(zip(d.tolist(), p.tolist()), t.tolist()):
            whole[k] += n
    want = Counter(p for _, p in whole)
    for links in (1, 3, 50, 1 << 20):
        monkeypatch.setattr(L, "LINKS", links)
        some, docs = Counter(), Counter()
        for d, p, t in found.pairs():
            for k, n in zip(zip(d.tolist(), p.tolist()), t.tolist()):
                some[k] += n
        for p, n in L.document_pairs(found):
            docs.update(dict(zip(p.tolist(), n.tolist())))
        assert some == whole and docs == want
    assert sum(whole.values()) == found.links().sum()


def test_pack_and_unpack():
    import pyarrow as pa
    found = L.aligned(TEXTS, *L.tokenizer_pair(A_PATH, B_PATH))
    ids, back = L.unpack(L.pack(pa.RecordBatch.from_pydict({"id": [*range(len(TEXTS))]}), found))
    assert ids.to_pylist() == [*range(len(TEXTS))]
    for x, y in zip((*found.ids, *found.lasts, *found.counts), (*back.ids, *back.lasts, *back.counts)):
        assert x.tolist() == y.tolist()
    assert found.texts() == back.texts()


@pytest.mark.parametrize("block_tokens", [1, 400, 10 ** 9])
def test_score_equals_brute_force(spark, block_tokens):
    rows = [(k % 30, t) for k, t in enumerate(TEXTS * 3)] + [(99, None), (None, "the fox"), (98, "")]
    docs = documents(spark, rows)
    out = L.score(spark.table(L.align(docs, A_PATH, B_PATH, block_tokens=block_tokens)), "long").withColumnRenamed("id", "doc_id")
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == brute_force(rows)


def test_query_equals_brute_force(spark):
    from conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op11_interval_alignment"](spark, SF_SMALL)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == brute_force(rows)


def test_groups(spark):
    docs = documents(spark, [(1, "unbelievable tokens"), (2, "a▁b"), (3, "tokens")])
    got = L.groups(spark.table(L.align(docs, A_PATH, B_PATH)), "long").orderBy("id", "group").collect()
    assert {r["id"] for r in got} == {1, 3}
    told = ";".join(",".join(map(str, r["a"])) + "|" + ",".join(map(str, r["b"])) for r in got if r["id"] == 1)
    assert [hashlib.sha256(told.encode()).hexdigest()] == [r[-1] for r in brute_force([(1, "unbelievable tokens")])]
    assert [r["group"] for r in got if r["id"] == 1] == [*range(sum(r["id"] == 1 for r in got))]


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark, ODD)
    out = L.score(spark.table(L.align(docs, A_PATH, B_PATH)), "long")
    assert sorted(map(tuple, out.collect()), key=repr) == brute_force([(r[0], r[1]) for r in ODD])
    assert L.score(spark.table(L.align(documents(spark, []), A_PATH, B_PATH)), "long").count() == 0


def test_parcels_are_not_shuffled(spark):
    docs = documents(spark, [(k, f"some text {k}") for k in range(50)])
    plan = L.score(spark.table(L.align(docs, A_PATH, B_PATH, block_tokens=20)), "long")
    text = plan._jdf.queryExecution().executedPlan().toString()
    left = text.split("FlatMapCoGroupsInArrow")[1].split(":- ")[1].split("+- Sort")[0]
    assert "parcel" in left and "Exchange" not in left and "Bucketed: true" in left
