import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_rows import ODD, documents
from pyspark.sql import functions as F

from strata.llm import manifest as M
from strata.llm.queries import QUERIES, SQL


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return sha(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(leaves):
    """All levels of a tree, by definition."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels, pos):
    """(left, right) siblings of a leaf, level by level."""
    out = []
    for level in levels[:-1]:
        other = pos ^ 1
        sibling = level[other] if other < len(level) else None
        out.append((sibling, None) if other < pos else (None, sibling))
        pos >>= 1
    return out


def brute_force(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for k, row in enumerate(rows):
        trees[row[2]].append(((row[0] is not None, row[0] or 0, leaf(*row)), k))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    below = {t: climb([key[2] for key, _ in sorted(trees[t])]) for t in order}
    top = climb([below[t][-1][0] for t in order])
    out = {}
    for at, t in enumerate(order):
        for pos, (key, k) in enumerate(sorted(trees[t])):
            doc, source, lang, n, text = rows[k]
            start = key[2]
            if doc is not None and n is not None and zlib.crc32(str(doc).encode()) % 7 == 0:
                start = leaf(doc, source, lang, n + 1, text)
            steps = path(below[t], pos) + path(top, at)
            for left, right in steps:
                start = sha(left or "", start, right or "")
            out[k] = (doc, key[2], below[t][-1][0], top[-1][0], sha(*(x or "" for s in steps for x in s)), start,
                      start == top[-1][0])
    return sorted(out.values(), key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def query(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op12_octopus_manifest"](spark, str(tmp_path))
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def as_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("count", [*range(1, 20), 37, 64, 100])
def test_missing_is_the_least_union(count):
    levels = climb([sha(str(i)) for i in range(count)])
    rng = random.Random(count)
    for _ in range(20):
        first = rng.randrange(count)
        upto = rng.randint(first + 1, count)
        lacking = M.missing(first, upto, count)
        assert len(set(lacking)) == len(lacking)
        # what single proofs ask for, without what the run can derive from its leaves
        wanted, own = set(), set(range(first, upto))
        for level in range(len(levels) - 1):
            wanted |= {(level, i ^ 1) for i in own if i ^ 1 < len(levels[level]) and i ^ 1 not in own}
            own = {i >> 1 for i in own}
        assert set(lacking) == wanted


@pytest.mark.parametrize("count,levels", [(0, 0), (1, 0), (2, 1), (3, 2), (4, 2), (5, 3), (1024, 10), (1025, 11)])
def test_depth(count, levels):
    assert M.depth(count) == levels


def test_runs_and_passes(spark, tmp_path, monkeypatch):
    """With runs of four leaves, trees of several passes."""
    monkeypatch.setattr(M, "LEVELS", 2)
    rng = random.Random(1)
    rows = [(k if rng.random() < 0.95 else rng.randrange(300), f"text {k} é", rng.choice(["en", "en", "en", "de", None, ""]),
             rng.choice(["a", None])) for k in range(300)] + [(7000 + k, "x", f"lang{k:02}", "s") for k in range(21)]
    df = documents(spark, rows)
    assert query(spark, df, tmp_path) == brute_force(as_rows(df))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, tmp_path, n):
    df = documents(spark, [(k, "t", "en") for k in range(n)])
    assert query(spark, df, tmp_path) == brute_force(as_rows(df))


def test_odd_rows_and_empty_table(spark, tmp_path):
    df = documents(spark, ODD).withColumn("n_chars", F.when(F.col("doc_id") != 6, F.col("n_chars")))
    assert query(spark, df, tmp_path / "odd") == brute_force(as_rows(df))
    assert query(spark, documents(spark, []), tmp_path / "none") == []


def test_one_row_repeated(spark, tmp_path):
    df = documents(spark, [(5, "same", "en", "s")] * 3000 + [(6, "other", "en", "s")])
    assert query(spark, df, tmp_path) == brute_force(as_rows(df))


def test_proofs_are_whole(spark):
    rows = documents(spark, [(k, f"t{k}", "en" if k % 3 else "fr") for k in range(50)])
    proved = M.manifest(rows.select("doc_id", "lang", "kind", M.leaf(F.col("doc_id"), F.col("text")).alias(M.LEAF)),
                        "lang", ["doc_id"])
    out = proved.withColumn("again", M.folded(F.col(M.LEAF), F.col("proof"))).collect()
    assert len(out) == 50 and len({r["root"] for r in out}) == 1
    assert all(r["again"] == r["root"] and r["kind"] == "x" for r in out)
    assert len({r["subroot"] for r in out}) == 2


def test_query_tells_tampered_rows_and_equals_sql(spark):
    import duckdb
    from conftest import SF_SMALL
    rows = QUERIES["op12_octopus_manifest"](spark, SF_SMALL).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    assert sorted(map(tuple, rows)) == sorted(con.execute(SQL["op12_octopus_manifest"]).fetchall())
    told = {r["doc_id"] for r in rows if not r["verified"]}
    assert told == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
