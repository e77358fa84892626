import zlib
from collections import Counter, defaultdict

from llm_rows import ODD, documents

from strata.llm import common, sharding
from strata.llm.queries import QUERIES


def test_query_keeps_the_law(spark):
    from conftest import SF_MID
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    out = QUERIES["op5_virtual_slots"](spark, SF_MID).collect()
    assert len(out) == len(texts)
    places, sizes = defaultdict(list), Counter()
    for r in out:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes"
        places[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(places) == set(range(24))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sizes.values()) < 1.01 * min(sizes.values())


def test_rebalancing_edits_the_map(spark):
    docs = documents(spark, [(i, "x" * (i % 700)) for i in range(3000)])
    slotted = sharding.with_slots(docs, n_slots=512)
    loads = sharding.slot_loads(slotted)
    path = common.scratch_path(spark, "map_test")
    first = sharding.new_map(spark, loads, 6, 512)
    sharding.save_map(first, path)
    grown = sharding.rebalance(sharding.load_map(spark, path), loads, 7)
    sharding.save_map(grown, path)
    old = {r["vslot"]: r["shard"] for r in sharding.load_map(spark, path, 1).collect()}
    new = {r["vslot"]: r["shard"] for r in sharding.load_map(spark, path).collect()}
    moved = [v for v in old if old[v] != new[v]]
    assert {new[v] for v in moved} == {6}
    assert len(moved) < 0.25 * len(old)
    total = Counter()
    for r in grown.collect():
        total[r["shard"]] += r["bytes"]
    assert max(total.values()) < 1.05 * min(total.values())
    again = sharding.rebalance(grown, loads)
    assert {r["vslot"]: r["shard"] for r in again.collect()} == new


def test_odd_rows_and_empty_table(spark):
    slotted = sharding.with_slots(documents(spark, ODD))
    out = sharding.assign(slotted, sharding.new_map(spark, sharding.slot_loads(slotted), 3)).collect()
    assert len(out) == len(ODD)
    assert [r["size"] for r in out if r["doc_id"] in (1, 2)] == [8, 8]
    empty = sharding.with_slots(documents(spark, []))
    slot_map = sharding.new_map(spark, sharding.slot_loads(empty), 3)
    assert slot_map.count() == sharding.N_SLOTS and sharding.assign(empty, slot_map).count() == 0
