"""Sources, sinks and schema shaping."""

import datetime as dt
import glob
import os

import pyarrow.parquet as papq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import shape
from strata.sources import parquet as pq
from strata.sources import sinks

D = dt.datetime


def test_write_sized_caps_rows_per_file(spark, tmp_uri):
    df = spark.range(95).withColumn("v", F.col("id") * 2)
    sinks.write_sized(df, tmp_uri, rows_per_file=10)
    files = glob.glob(os.path.join(tmp_uri, "*.parquet"))
    sizes = [papq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(sizes) == 95 and max(sizes) <= 10
    assert not os.path.exists(os.path.join(tmp_uri, "_SUCCESS"))
    assert pq.read_parquet(spark, tmp_uri).count() == 95


def test_write_sized_rebalance_flag(spark, tmp_path):
    # four tiny partitions: the rebalance shuffle lets AQE merge them into one
    # file; without it the write keeps the input's partitions (no shuffle)
    df = spark.range(0, 40, 1, 4)
    for flag, n_files in ((True, 1), (False, 4)):
        uri = str(tmp_path / f"rebalance_{flag}")
        sinks.write_sized(df, uri, rebalance=flag)
        assert len(glob.glob(os.path.join(uri, "*.parquet"))) == n_files
        assert pq.read_parquet(spark, uri).count() == 40


def test_write_chunked_folders(spark, tmp_uri):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 8, 1)), (3, D(2024, 1, 16)),
                                (4, D(2024, 1, 9))], "id int, created_at timestamp")
    sinks.write_chunked(df, tmp_uri, "2024-01-08", 7)
    folders = sorted(os.path.basename(p) for p in glob.glob(os.path.join(tmp_uri, "chunk_start=*")))
    assert folders == ["chunk_start=2024-01-08", "chunk_start=2024-01-15", "chunk_start=initial"]
    back = sinks.read_chunked(spark, tmp_uri, df.schema)
    got = {r.id: r.chunk_start for r in back.collect()}
    assert got == {1: "initial", 2: "2024-01-08", 3: "2024-01-15", 4: "2024-01-08"}


def test_write_chunked_spreads_a_hot_chunk(spark, tmp_uri):
    # one chunk holds almost every row; with a tiny advisory size AQE must cut
    # it into several tasks (files), each written in time order
    rows = [(i, D(2024, 1, 9) + dt.timedelta(seconds=i)) for i in range(4000)]
    rows += [(10_000 + i, D(2024, 1, 1) + dt.timedelta(days=i % 5)) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, created_at timestamp").repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        sinks.write_chunked(df, tmp_uri, "2024-01-08", 7)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = glob.glob(os.path.join(tmp_uri, "chunk_start=2024-01-08", "*.parquet"))
    assert len(hot) > 1
    for f in hot:
        times = papq.read_table(f).column("created_at").to_pylist()
        assert times == sorted(times)
    assert sinks.read_chunked(spark, tmp_uri, df.schema).count() == len(rows)


def test_date_window_modes_and_pushdown(spark, tmp_uri):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 15)), (3, D(2024, 1, 15, 10)),
                                (4, D(2024, 1, 16)), (5, D(2023, 12, 31, 23))],
                               "like_id int, created_at timestamp")
    df.write.parquet(tmp_uri)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    src = pq.read_parquet(spark, tmp_uri)
    inst = shape.date_window(src, "2024-01-01", "2024-01-15")
    day = shape.date_window(src, "2024-01-01", "2024-01-15", end_mode="day")
    assert sorted(r.like_id for r in inst.collect()) == [1, 2]
    assert sorted(r.like_id for r in day.collect()) == [1, 2, 3]
    plan = inst._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in plan
    assert "LessThanOrEqual(created_at" in plan
    # no time column, or no window: whole table
    users = spark.createDataFrame([(1,)], "user_id int")
    assert shape.date_window(users, "2024-01-01", "2024-01-15").count() == 1
    assert shape.date_window(src, None, None).count() == 5


def test_align_to_schema(spark):
    df = spark.createDataFrame([("7", "x", 1), ("oops", "y", 2)], "post_id string, content string, label int")
    schema = T.StructType([T.StructField("post_id", T.IntegerType()),
                           T.StructField("user_id", T.IntegerType()),
                           T.StructField("content", T.StringType())])
    out = shape.align_to_schema(df, schema)
    assert out.schema == schema
    assert [tuple(r) for r in out.collect()] == [(7, None, "x"), (None, None, "y")]


def test_drop_helpers(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert shape.drop_null_key(df).collect()[0].a == 2


def test_layer_path():
    assert pq.layer_path("s3a://bkt/", "silver", "2025-01-01", "2025-01-31", "posts") == \
        "s3a://bkt/silver/2025-01-01_2025-01-31/posts"


def test_shared_dir_without_configured_checkpoint(tmp_path, monkeypatch):
    from strata import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        dir = None
        master = "local[2]"

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = "file:" + d + "/abc"

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path / "ck"))
    s = Session()
    first = session.shared_dir(s)
    assert first == f"file:{tmp_path}/ck/abc"
    assert session.shared_dir(s) == first
    assert session.scratch_path(s, "x").startswith(first + "/strata/x/")


def test_shared_dir_refuses_local_fallback_on_cluster():
    import pytest
    from strata import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
