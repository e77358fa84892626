import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_rows import ODD, documents
from oracle import compare, duck

from strata.llm import mixing
from strata.llm.queries import QUERIES, SQL


def units(weights):
    """Weights as units that add up, as the operator deals them."""
    n, total = len(weights), sum(weights)
    exact = [w / total * (mixing.UNITS - n) for w in weights]
    a = [int(x) + 1 for x in exact]
    for i in sorted(range(n), key=lambda i: (-(exact[i] - int(exact[i])), i))[:mixing.UNITS - sum(a)]:
        a[i] += 1
    return a


def edf(a, slots):
    """Earliest deadline first over all slots, one after the other."""
    done, out = [0] * len(a), []
    for t in range(slots):
        _, i = min((-(-(c + 1) * mixing.UNITS // w), i) for i, (c, w) in enumerate(zip(done, a))
                   if c * mixing.UNITS // w <= t)
        out.append((i, done[i], t))
        done[i] += 1
    return out


def schedule(spark, a, slots, stretch):
    plan = spark.createDataFrame(list(enumerate(a)), "idx int, a long")
    return sorted((r["t"], r["idx"], r["block"]) for r in mixing.schedule(plan, slots, stretch).collect())


def held(spark, rows, **args):
    return mixing.mix(documents(spark, rows), **args).select("doc_id", "source", "mix.*").collect()


@pytest.mark.parametrize("seed", range(4))
def test_stretches_give_the_schedule_of_one_pass(spark, seed):
    rng = random.Random(seed)
    a = units([rng.random() ** rng.choice([1, 4]) + 1e-9 for _ in range(rng.choice([1, 2, 7, 23]))])
    assert sum(a) == mixing.UNITS
    got = schedule(spark, a, 600, rng.choice([16, 37, 64]))
    assert [(i, j, t) for t, i, j in got][:600] == edf(a, 600)


@pytest.mark.parametrize("slots", [1000, 200_000])
def test_deviation_stays_below_a_block(spark, slots):
    """At any length: against the weights themselves, tiny ones too."""
    weights = [0.9999 - 0.25 - 1 / 3, 0.0001, 1 / 3, 0.25]
    got = schedule(spark, units(weights), slots, mixing.STRETCH)
    assert [t for t, *_ in got] == list(range(len(got))) and len(got) >= slots
    done, total = [0] * 4, sum(map(Fraction, weights))
    exact = [Fraction(w) / total for w in weights]
    for t, i, j in got:
        assert j == done[i]
        done[i] += 1
        # a source that does not run falls behind, one that runs gets ahead
        if t % 97 == 0 or t > slots - 50:
            assert all(abs(d - (t + 1) * w) < 1 + 1e-6 for d, w in zip(done, exact))
    assert abs(done[1] - len(got) * 0.0001) < 1


def test_a_tiny_source_is_not_repeated_beyond_its_weight(spark):
    rows = [(i, "x" * 92, "en", "big") for i in range(3000)] + [(9000, "y" * 92, "en", "tiny")]
    out = held(spark, rows, weights={"big": 0.9999, "tiny": 0.0001}, block_bytes=100)
    n = Counter(r["source"] for r in out)
    assert n["tiny"] == 1 and n["big"] >= 3000
    assert {r["doc_id"] for r in out} == {r[0] for r in rows}


def test_prefixes_hold_the_weights_to_a_block(spark):
    rows = [(i, "x" * (20 + i % 50), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    weights = {"hot": 0.41, **{f"s{k}": (0.09, 0.01, 0.2, 0.03, 0.11, 0.08, 0.07)[k] for k in range(7)}}
    out = held(spark, rows, weights=weights, block_bytes=64)
    taken, share, q = {}, {}, out[0]["units"]
    for r in out:
        taken.setdefault(r["slot"], set()).add(r["source"])
        share[r["source"]] = r["share"]
    assert all(len(s) == 1 for s in taken.values()) and sum(share.values()) == q
    assert all(abs(share[s] / q - w) < 1e-11 for s, w in weights.items())
    assert {r["doc_id"] for r in out} == set(range(900))
    # a slot may only hold the rest of a long document of the block before
    blocks = defaultdict(list)
    for r in out:
        blocks[r["source"]].append((r["block"], r["slot"]))
    for source, pairs in blocks.items():
        for block, slot in set(pairs):
            # Pfair: block j runs within floor(j q / a) .. ceil((j + 1) q / a)
            assert block * q // share[source] <= slot < -(-(block + 1) * q // share[source])
            assert abs((block + 1) - (slot + 1) * weights[source]) < 1 + 1e-6


def test_sources_that_end_begin_again(spark):
    rows = [(i, "y" * 92, "en", "big") for i in range(80)] + [(100 + i, "y" * 92, "en", "small") for i in range(10)]
    out = held(spark, rows, weights={"big": 0.5, "small": 0.5}, block_bytes=100)
    n = Counter((r["source"], r["epoch"]) for r in out)
    assert n["big", 0] == 80 and ("big", 1) not in n
    assert [n["small", e] for e in range(7)] == [10] * 7


def test_finer_buckets_change_nothing(spark, monkeypatch):
    rows = [(i, "x" * (20 + i % 50), "en", f"s{i % 3}") for i in range(400)]
    want = sorted(map(tuple, held(spark, rows, block_bytes=256)))
    monkeypatch.setattr(mixing, "DIGITS", (1, 4))
    monkeypatch.setattr(mixing, "BUCKET_BYTES", 200)
    assert sorted(map(tuple, held(spark, rows, block_bytes=256))) == want


def test_query_matches_sql(spark):
    from conftest import SF_SMALL
    compare(spark, duck(SF_SMALL), QUERIES["op8_pfair_mix"], SQL["op8_pfair_mix"], SF_SMALL)


def test_no_python_in_the_plan(spark):
    from conftest import SF_SMALL
    plan = QUERIES["op8_pfair_mix"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas", "MapIn"))


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark, ODD)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix"]
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows if r["mix"]["epoch"] == 0) == Counter(r[0] for r in ODD)
    assert mixing.mix(documents(spark, [])).count() == 0
