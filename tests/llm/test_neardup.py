import random
from collections import defaultdict

import numpy as np
from llm_rows import ODD, documents, prose

from strata.llm import common, neardup
from strata.llm.queries import QUERIES


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """The least id of each component over all pairs."""
    sets = {doc: shingles(text) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for doc in sorted(sets):
        both = defaultdict(int)
        for s in sets[doc]:
            for other in having[s]:
                both[other] += 1
            having[s].append(doc)
        for other, n in both.items():
            if 100 * n >= 85 * (len(sets[doc]) + len(sets[other]) - n):
                a, b = sorted((find(doc), find(other)))
                root[b] = a
    return {doc: (len(s), find(doc), find(doc) == doc) for doc, s in sets.items()}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def edited(words, rng, share):
    return [w if rng.random() > share else w + "q" for w in words]


def test_planted_groups_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(prose(i, rng.randint(3, 200)))) for i in range(60)]
    base = prose(500, 300)
    rows += [(100 + i, " ".join(edited(base, rng, 0.012))) for i in range(150)]      # one crowded region
    template = prose(501, 220)
    rows += [(300 + i, " ".join(template + prose(600 + i, 40))) for i in range(60)]  # near the threshold
    rows += [(400 + i, " ".join(base)) for i in range(40)]
    for i in range(40):
        one = prose(900 + i, 120)
        rows += [(1000 - 2 * i, " ".join(one)), (1001 - 2 * i, " ".join(edited(one, rng, 0.02)).upper())]
    rng.shuffle(rows)
    assert result(neardup.near_duplicates(documents(spark, rows))) == brute(rows)


def test_query_matches_brute_force(spark):
    from conftest import SF_SMALL
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(QUERIES["op9_lsh_forest"](spark, SF_SMALL)) == brute(rows)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(1)
    names = list(range(500))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(199)]                # a path
    edges += [(names[200], names[i]) for i in range(201, 400)]            # a star
    edges += [(names[i], names[i + 1]) for i in range(400, 499, 2)]       # pairs
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for group in (names[:200], names[200:400], *(names[i:i + 2] for i in range(400, 500, 2))):
        assert all(got.get(n, n) == min(group) for n in group)


def test_signature_estimates_similarity():
    a, b = neardup.permutations(neardup.TREES * neardup.DEPTH)
    make = neardup.Shingles()
    words = [w.encode() for w in prose(1, 400)]
    x, y = make(words), make(words[:360] + [w.encode() for w in prose(2, 40)])
    same = (neardup.signature_of(x, a, b) == neardup.signature_of(y, a, b)).mean()
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs(same - true) < 0.12


def test_key_filter_agrees_with_spark(spark):
    import xxhash
    words = [f"wörd{i}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    bitmap = common.key_filter(df)
    slots = [xxhash.xxh64_intdigest(w.encode(), seed=42) & (32 * len(bitmap) - 1) for w in words]
    assert common.passes(bitmap, slots).all()
    others = [xxhash.xxh64_intdigest(f"other{i}".encode(), seed=42) & (32 * len(bitmap) - 1) for i in range(5000)]
    assert common.passes(bitmap, others).mean() < 0.01


def test_odd_rows_and_empty_table(spark):
    out = neardup.near_duplicates(documents(spark, ODD)).collect()
    assert len(out) == len(ODD)
    for r in out:
        if r["doc_id"] in (None, 1, 2, 3):
            assert r["component_id"] == r["doc_id"] and r["kept"]
        if r["doc_id"] == 5:
            assert (r["component_id"], r["kept"]) == (4, False)
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def joined(nodes, links):
    lead = {n: n for n in nodes}

    def find(n):
        while lead[n] != n:
            n = lead[n]
        return n

    for a, b in links:
        lead[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_a_crowded_region_in_parts(spark):
    """However a region is dealt over parts, what its links connect is what all pairs would."""
    import numpy as np
    rng = np.random.default_rng(5)
    base = [rng.choice(10 ** 6, 60, replace=False) for _ in range(12)]
    sets = {}
    for k in range(150):
        s = base[k % 12].copy()
        s[rng.integers(0, 60, k % 6)] = rng.integers(10 ** 6, 2 * 10 ** 6, k % 6)
        sets[k] = np.unique(s).astype(np.uint64)
    want = joined(sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b]))
                         >= 85 * len(np.union1d(sets[a], sets[b]))])
    for part_rows in (1000, 40, 7):
        rows = spark.createDataFrame([(r, k, k, 150, bytearray(sets[k].tobytes())) for k in sets for r in (1, 2)],
                                     "region long, doc_id long, root long, n long, shingles binary")
        packed = neardup.blocks(rows, part_rows)
        links = neardup.block_links(packed, 85).collect()
        assert joined(sets, [(r["a"], r["b"]) for r in links]) == want
        assert packed.select("part").distinct().count() >= (150 // part_rows + 1) // 2


def test_recall_where_regions_are_crowded(spark):
    """Some 2,000 near copies of three texts: regions of far more classes than a
    region's bound. What is found is held against all pairs on full sets."""
    rng, rows = random.Random(12), []
    for base in range(3):
        words = prose(9000 + base, 200)
        for k in range(700):
            some = list(words)
            for at in rng.sample(range(200), rng.choice([1, 1, 2, 3])):
                some[at] = f"w{base}x{k}y{at}"
            rows.append((base * 1000 + k, " ".join(some)))
    rows += [(5000 + k, " ".join(prose(k, 60))) for k in range(100)]
    shingles, numbers = [], {}
    for _, text in rows:
        words = text.split()
        shingles.append([numbers.setdefault(tuple(words[i:i + 5]), len(numbers)) for i in range(len(words) - 4)])
    held = np.zeros((len(rows), len(numbers)), np.float32)
    for k, s in enumerate(shingles):
        held[k, s] = 1
    both, sizes = held @ held.T, held.sum(axis=1)
    linked = 100 * both >= 85 * (sizes[:, None] + sizes[None, :] - both)
    ids = [doc for doc, _ in rows]
    want = joined(ids, [(ids[i], ids[j]) for i, j in np.argwhere(np.triu(linked, 1)).tolist()])
    docs = documents(spark, rows)
    classes = neardup.signatures(docs.select("doc_id", "text"))
    regions = neardup.forest(classes.select("doc_id", "h1", "h2", "signature")).groupBy("region").count()
    assert regions.agg({"count": "max"}).first()[0] > neardup.CROWD
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert len(set(want.values())) > 103  # copies of three changes stand apart
    assert got == want
