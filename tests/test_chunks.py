"""Time chunking."""

import datetime as dt

from strata.operators import chunks

D = dt.datetime


def test_chunk_labels_and_folders(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 7, 23, 59, 59)), (2, D(2024, 1, 8)),
                                (3, D(2024, 1, 14, 23, 59)), (4, D(2024, 1, 15)),
                                (5, D(2024, 3, 1)), (6, None)], "id int, created_at timestamp")
    out = {r.id: (r.date_chunk, r.folder) for r in chunks.assign_chunk(df, "2024-01-08", 7)
           .withColumn("folder", chunks.chunk_folder("created_at", "2024-01-08", 7)).collect()}
    assert out == {1: ("initial", "initial"), 2: ("chunk_0", "2024-01-08"),
                   3: ("chunk_0", "2024-01-08"), 4: ("chunk_1", "2024-01-15"),
                   5: ("chunk_7", "2024-02-26"), 6: (None, None)}


def test_chunk_ranges_from_data(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 20),), (D(2024, 1, 21),)],
                               "created_at timestamp")
    out = {r.date_chunk: (r.start_date, r.end_date, r.records)
           for r in chunks.chunk_ranges(df, "2024-01-08", 7).collect()}
    assert out == {"initial": (None, dt.date(2024, 1, 7), 1),
                   "chunk_1": (dt.date(2024, 1, 15), dt.date(2024, 1, 21), 2)}


def test_string_times_are_parsed(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-20",), ("no time",), (None,)], "created_at string")
    got = [r.date_chunk for r in chunks.assign_chunk(df, "2024-01-08", 7).collect()]
    assert got == ["initial", "chunk_1", None, None]
    ranges = {r.date_chunk: r.records for r in chunks.chunk_ranges(df, "2024-01-08", 7).collect()}
    assert ranges == {"initial": 1, "chunk_1": 1}
    summary = {r.date_chunk: (r.records, r.first_at) for r in chunks.chunk_summary(df, "2024-01-08", 7).collect()}
    assert summary["chunk_1"] == (1, D(2024, 1, 20)) and summary[None][0] == 2
