import numpy as np
import pytest

from strata.llm import ann
from strata.llm.queries import QUERIES


def frame(spark, ids, x, kind="float"):
    rows = [(int(i), [float(c) for c in v], "x", 1.0) for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, id string, score double")


def brute(ids, x, query, k):
    scores = (x[list(ids).index(query)] * x).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_scores(spark, lengths):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.uniform(0.5, 2, (1500, 1))
    x, ids = x.astype(np.float32).astype(float), np.arange(1500) * 3
    vectors = frame(spark, ids, x)
    got = found(ann.search(vectors, vectors.where("vec_id % 60 = 0"), 20))
    assert set(got) == set(range(0, 4500, 60))
    right = 0
    for query, rows in got.items():
        want = brute(ids, x, query, 20)
        exact = dict(brute(ids, x, query, 1500))
        assert len(rows) == 20 and all(exact[i] == s for i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        right += len({i for i, _ in rows} & {i for i, _ in want})
    assert right >= 0.9 * 20 * len(got)


def test_equal_vectors_by_smaller_id(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)).astype(np.float32).astype(float)
    x = np.concatenate([np.repeat(x[:1], 300, axis=0), x])
    ids = rng.permutation(len(x))
    vectors = frame(spark, ids, x)
    got = found(ann.search(vectors, vectors.where("vec_id % 7 = 0"), 20))
    for query, rows in got.items():
        if x[list(ids).index(query)].tolist() == x[0].tolist():
            assert rows == brute(ids, x, query, 20)


def test_matrices_are_merged_however_small_a_plan_takes_them(spark, monkeypatch):
    plans, products = [], ann.products

    def seen(pairs, *args, **more):
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return products(pairs, *args, **more)

    monkeypatch.setattr(ann, "products", seen)
    x = np.random.default_rng(5).normal(size=(300, 8))
    vectors = frame(spark, range(300), x)
    assert len(found(ann.search(vectors, vectors.where("vec_id % 50 = 0"), 5))) == 6
    # the fit's and the search's: a matrix has hundreds of rows, the plan expects a hundred bytes
    assert len(plans) >= 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)


@pytest.mark.parametrize("n", [1, 2, 12, 20, 21])
def test_small_tables_are_searched_whole(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 5)).astype(np.float32).astype(float)
    vectors = frame(spark, np.arange(n), x)
    got = found(ann.search(vectors, vectors, 20))
    for query in range(n):
        assert got.get(query, []) == brute(np.arange(n), x, query, 20)


def test_each_dimension_is_searched_among_itself(spark):
    rng = np.random.default_rng(5)
    parts = [(n, rng.normal(size=(m, n)).astype(np.float32).astype(float)) for n, m in ((6, 30), (7, 1), (3, 5))]
    parts[2][1][:] *= [[1], [2], [4], [8], [16]]
    rows, at = [], 0
    for n, x in parts:
        rows.append((np.arange(at, at + len(x)), x))
        at += len(x)
    vectors = frame(spark, [i for ids, _ in rows for i in ids], [v for _, x in rows for v in x])
    got = found(ann.search(vectors, vectors, 40))
    for ids, x in rows:
        for query in ids:
            assert got.get(query, []) == brute(ids, x, query, 40)


def test_odd_rows_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 1.0]), (9, [-0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(ann.search(vectors, vectors, 20))
    assert got == {0: [(1, 0.5), (9, 0.0)], 1: [(0, 0.5), (9, 0.5)], 9: [(1, 0.5), (0, 0.0)]}
    empty = vectors.where("false")
    assert ann.search(empty, empty, 20).count() == 0
    assert ann.search(empty, vectors, 20).count() == 0


def test_query(spark):
    from conftest import SF_SMALL
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = found(QUERIES["op3_cross_polytope"](spark, SF_SMALL))
    assert set(got) == {i for i in ids if i % 20 == 0}
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in brute(ids, x, q, 20)}) for q in got)
    assert hit >= 0.9 * 20 * len(got)


def compared(x, queries, k=20):
    """(share of the rows that a query is compared with, recall) under the fitted probes."""
    u = ann.units(x, None)
    near = [np.argsort(-(u @ u[q]), kind="stable")[1:k + 1] for q in queries]
    sample = range(0, len(queries), 2)
    probes = ann.fitted_probes(u[queries[::2]], [u[near[i]] for i in sample])
    hit = np.zeros((len(queries), len(x)), bool)
    for table in range(ann.TABLES):
        a, b = ann.cell(u, table)
        one, two, _ = ann.cells(u[queries], table, probes)
        for i in range(len(queries)):
            hit[i] |= np.isin(a * 10_000 + b, one[i] * 10_000 + two[i])
    others = range(1, len(queries), 2)  # the probes were not fitted on these
    return hit[others].mean(), np.mean([hit[i][near[i]].mean() for i in others])


def test_clustered_vectors_are_compared_with_few():
    rng = np.random.default_rng(8)
    shares = []
    for n in (3000, 12_000):
        centres = rng.normal(size=(n // 40, 48))
        x = np.repeat(centres, 40, axis=0) + 0.35 * rng.normal(size=(n // 40 * 40, 48))
        share, recall = compared(x, rng.choice(len(x), 60, replace=False))
        shares.append(share)
        assert share <= 0.1 and recall >= 0.9, (n, share, recall)
    assert shares[1] < shares[0]


def test_share_falls_with_the_table():
    """On random vectors too, which have no near neighbours to speak of."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(24_000, 48))
    (few, r1), (many, r2) = (compared(x[:n], rng.choice(n, 60, replace=False)) for n in (1500, 24_000))
    assert many < few < 1 and min(r1, r2) >= 0.9


def test_probed_cells_are_the_cheapest():
    x = ann.units(np.random.default_rng(2).normal(size=(20, 8)), None)
    one, two, cost = ann.cells(x, 3, 30)
    s = ann.signed(x, 3)
    every = np.square(s[0].max(1, keepdims=True) - s[0])[:, :, None] + np.square(s[1].max(1, keepdims=True) - s[1])[:, None, :]
    for i in range(20):
        assert np.allclose(np.sort(cost[i]), np.sort(every[i].ravel())[:30])
        assert np.allclose(every[i][one[i], two[i]], cost[i])
        a, b = ann.cell(x[i:i + 1], 3)
        assert every[i][a[0], b[0]] == 0


def test_common_places():
    rng = np.random.default_rng(4)
    places = rng.integers(0, 6, 40)
    asked = [rng.choice(6, rng.integers(0, 4), replace=False) for _ in range(9)]
    q, r = ann.common(np.concatenate(asked), np.array([len(a) for a in asked]), places)
    assert sorted(zip(q.tolist(), r.tolist())) == [(i, j) for i, a in enumerate(asked) for j in range(40) if places[j] in a]


def test_columns_with_clashing_names(spark):
    x = np.random.default_rng(6).normal(size=(200, 6)).astype(np.float32).astype(float)
    names = ["id", "v", "k1", "k2", "rank", "dim", "tab", "bucket", "places", "query", "cls", "score", "part", "salt", "m", "ids"]
    vectors = frame(spark, np.arange(200), x).select("vec_id", "embedding")
    for name in names:
        vectors = vectors.withColumn(name, vectors.vec_id * 0 + 7)
    got = found(ann.search(vectors, vectors.where("vec_id % 50 = 0"), 5))
    assert set(got) == {0, 50, 100, 150}
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in brute(np.arange(200), x, q, 5)}) for q in got)
    assert hit >= 18


def test_a_hot_vector_and_a_hot_bucket(spark):
    """A third of the rows in one direction, another third equal."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 16))
    x[:300] = x[0] + 0.01 * rng.normal(size=(300, 16))
    x[300:600] = x[300]
    x = x.astype(np.float32).astype(float)
    vectors = frame(spark, np.arange(900), x)
    got = found(ann.search(vectors, vectors.where("vec_id % 45 = 0"), 20))
    assert set(got) == set(range(0, 900, 45))
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in brute(np.arange(900), x, q, 20)}) for q in got)
    assert hit >= 0.9 * 20 * len(got) and all(len(r) == 20 for r in got.values())
