import glob
import os

from strata.llm import common as C
from strata.session import shared_dir


def folders(spark, name):
    return {os.path.basename(p) for p in glob.glob(f"{shared_dir(spark)}/strata/{name}/*")}


def test_what_is_temporary_goes_and_what_is_kept_stays(spark):
    with C.temporary(spark):
        with C.temporary(spark):
            a = C.cut(spark.range(5), "scope_a")
            kept = C.cut(a, "scope_b", keep=True)
            table = C.bucketed(spark.range(9), "scope_t", "id", 100)
            assert spark.table(table).count() == 9
            spark.sql(f"DROP TABLE {table}")
        assert folders(spark, "scope_a") == set() == folders(spark, "scope_t")
        assert kept.count() == 5
        last = C.cut(kept, "scope_c", keep=True)
    assert folders(spark, "scope_b") == set() and last.count() == 5
    assert C.cut(spark.range(2), "scope_d").count() == 2


def test_a_scope_that_fails_leaves_nothing(spark):
    try:
        with C.temporary(spark):
            C.cut(spark.range(3), "scope_e")
            raise ValueError
    except ValueError:
        pass
    assert folders(spark, "scope_e") == set() and spark.range(3).count() == 3


def test_cutting_leaves_the_session_s_settings(spark):
    before = {key: spark.conf.get(key) for key in C.WRITING}
    df = spark.range(1000).repartition(5).groupBy((C.F.col("id") % 7).alias("k")).count()
    a = C.cut(df, "scope_f")
    assert {key: spark.conf.get(key) for key in C.WRITING} == before
    # the same frame may be used again
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, df.collect()))


def test_slices_cover_all_rows():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n if n else None for n in (3, 0, 50, 1, 1, 1, 200, 0, 2)]})
    for limit in (1, 5, 60, 10 ** 6):
        parts = [p.column("t").to_pylist() for p in C.slices(batch, "t", limit)]
        assert sum(parts, []) == batch.column("t").to_pylist()
        assert all(sum(len(t or "") for t in p) <= limit or len(p) == 1 for p in parts)
    assert list(C.slices(batch.slice(0, 0), "t", 5)) == []
