"""Incremental chunk load: every row once, restart loads nothing twice."""

import datetime as dt

from strata.sources import sinks
from strata.streaming.chunk_ingest import ingest_chunks, parquet_sink, read_loaded

D = dt.datetime


def test_ingest_chunks_exactly_once(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i, D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(30)],
                               "id int, created_at timestamp")
    sinks.write_chunked(df, f"{root}/src", "2024-01-08", 7)
    ingest_chunks(spark, f"{root}/src", df.schema, parquet_sink(f"{root}/out", f"{root}/ckpt"),
                  f"{root}/ckpt", max_files=2)
    first = read_loaded(spark, f"{root}/out", df.schema)
    assert sorted(r.id for r in first.collect()) == list(range(30))
    assert "chunk_start" not in first.columns
    # new chunk arrives; the restart loads only it
    more = spark.createDataFrame([(100, D(2024, 3, 1))], "id int, created_at timestamp")
    sinks.write_chunked(more, f"{root}/src", "2024-01-08", 7, mode="append")
    ingest_chunks(spark, f"{root}/src", df.schema, parquet_sink(f"{root}/out", f"{root}/ckpt"),
                  f"{root}/ckpt", max_files=2)
    ids = sorted(r.id for r in read_loaded(spark, f"{root}/out", df.schema).collect())
    assert ids == list(range(30)) + [100]


def test_ingest_chunks_failed_batch_is_replayed_once(spark, tmp_path):
    import pytest
    root = str(tmp_path)
    df = spark.createDataFrame([(i, D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(30)],
                               "id int, created_at timestamp")
    sinks.write_chunked(df, f"{root}/src", "2024-01-08", 7)
    write = parquet_sink(f"{root}/out", f"{root}/ckpt")
    failed = []

    def flaky(batch, batch_id):
        write(batch, batch_id)              # the batch lands, then the run dies
        if batch_id == 1 and not failed:    # before the batch is committed
            failed.append(batch_id)
            raise RuntimeError("lost the driver after writing batch 1")

    with pytest.raises(Exception):
        ingest_chunks(spark, f"{root}/src", df.schema, flaky, f"{root}/ckpt", max_files=1)
    ingest_chunks(spark, f"{root}/src", df.schema, flaky, f"{root}/ckpt", max_files=1)
    ids = sorted(r.id for r in read_loaded(spark, f"{root}/out", df.schema).collect())
    assert failed == [1] and ids == list(range(30))   # replayed, written once


def test_a_fresh_checkpoint_on_an_old_dataset_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda days: spark.createDataFrame(
        [(i, D(2024, 1, 1) + dt.timedelta(days=i)) for i in days], "id int, created_at timestamp")
    for name, days in (("a", range(10)), ("b", range(10, 15))):
        sinks.write_chunked(rows(days), f"{root}/src_{name}", "2024-01-08", 7)
        checkpoint = f"{root}/ckpt_{name}"
        ingest_chunks(spark, f"{root}/src_{name}", rows([]).schema, parquet_sink(f"{root}/out", checkpoint), checkpoint)
    ids = sorted(r.id for r in read_loaded(spark, f"{root}/out", rows([]).schema).collect())
    assert ids == list(range(15))


def test_readers_see_whole_batches_only(spark, tmp_path, monkeypatch):
    """A batch whose files are there but whose entry is not does not count yet."""
    import pytest
    from strata.sources.commits import CommitLog
    root = str(tmp_path)
    df = spark.createDataFrame([(i, D(2024, 1, 1)) for i in range(5)], "id int, created_at timestamp")
    sinks.write_chunked(df, f"{root}/src", "2024-01-08", 7)
    run = lambda: ingest_chunks(spark, f"{root}/src", df.schema,
                                parquet_sink(f"{root}/out", f"{root}/ckpt"), f"{root}/ckpt")
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            run()
    assert read_loaded(spark, f"{root}/out", df.schema).count() == 0
    run()
    assert read_loaded(spark, f"{root}/out", df.schema).count() == 5


def test_one_batch_by_default(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i, D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(60)],
                               "id int, created_at timestamp")
    sinks.write_chunked(df, f"{root}/src", "2024-01-08", 2)
    seen = []
    ingest_chunks(spark, f"{root}/src", df.schema, lambda batch, i: seen.append((i, batch.count())), f"{root}/ckpt")
    assert seen == [(0, 60)]


def test_jdbc_sink_inserts_each_batch(spark, monkeypatch):
    """At least once: a replayed batch is inserted again, as documented."""
    from strata.streaming import chunk_ingest
    calls = []
    monkeypatch.setattr(chunk_ingest, "write_table", lambda df, url, table, props, batch_size: calls.append(df.count()))
    sink = chunk_ingest.jdbc_sink("jdbc:x", "posts", {})
    sink(spark.range(3), 0)
    sink(spark.range(3), 0)
    assert calls == [3, 3]
