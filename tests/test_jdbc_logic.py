"""JDBC source/sink logic without a database: the reader and writer are
stubbed, so these tests check the arguments Spark would receive (bounds,
partitions, window, batch size, truncate) and the filters on the result."""

import datetime as dt

from strata.sources import jdbc

D = dt.datetime


class _Reader:
    def __init__(self, spark, table_df, calls):
        self.spark, self.table_df, self.calls = spark, table_df, calls

    def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None,
             numPartitions=None, properties=None):
        self.calls.append(dict(url=url, table=table, column=column, lower=lowerBound,
                               upper=upperBound, n=numPartitions))
        return self.table_df


class _Session:
    def __init__(self, spark, table_df, calls):
        self._spark = spark
        self.read = _Reader(spark, table_df, calls)


def test_read_table_bounds_from_data_and_window(spark):
    rows = [(i, D(2024, 1, 1) + dt.timedelta(hours=12 * i)) for i in range(5, 60)]
    likes = spark.createDataFrame(rows, "like_id int, created_at timestamp")
    calls = []
    df = jdbc.read_table(_Session(spark, likes, calls), "jdbc:x", "likes", "like_id", {},
                         start="2024-01-03", end="2024-01-10", num_partitions=4)
    assert calls[0]["column"] is None                       # bounds probe
    assert calls[1] == dict(url="jdbc:x", table="likes", column="like_id", lower=5, upper=19,
                            n=4)
    got = sorted(r.like_id for r in df.collect())
    assert got == [i for i, t in rows if D(2024, 1, 3) <= t <= D(2024, 1, 10)]


def test_read_table_given_bounds_and_no_time_column(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    calls = []
    df = jdbc.read_table(_Session(spark, users, calls), "jdbc:x", "users", "user_id", {},
                         start="2024-01-01", end="2024-01-31", lower_bound=1, upper_bound=100000)
    assert len(calls) == 1 and calls[0]["lower"] == 1 and calls[0]["upper"] == 100001
    assert df.count() == 2                                   # no created_at: whole table


def test_read_table_empty_table_reads_unpartitioned(spark):
    empty = spark.createDataFrame([], "like_id int, created_at timestamp")
    calls = []
    jdbc.read_table(_Session(spark, empty, calls), "jdbc:x", "likes", "like_id", {})
    assert calls[1]["column"] is None


class _Writer:
    def __init__(self, log):
        self.log = log

    def option(self, k, v):
        self.log.setdefault("options", {})[k] = v
        return self

    def mode(self, m):
        self.log["mode"] = m
        return self

    def jdbc(self, url, table, properties):
        self.log["target"] = (url, table)


class _Frame:
    def __init__(self):
        self.log = {}
        self.write = _Writer(self.log)


def test_write_table_options():
    f = _Frame()
    jdbc.write_table(f, "jdbc:x", "posts", {}, batch_size=1000)
    assert f.log == {"options": {"batchsize": 1000}, "mode": "append",
                     "target": ("jdbc:x", "posts")}
    g = _Frame()
    jdbc.write_table(g, "jdbc:x", "posts", {}, truncate_first=True, cascade=True,
                     column_types="content CLOB")
    assert g.log["mode"] == "overwrite"
    assert g.log["options"] == {"batchsize": 1000, "createTableColumnTypes": "content CLOB",
                                "truncate": "true", "cascadeTruncate": "true"}


def test_read_table_warns_without_time_column(spark, caplog):
    users = spark.createDataFrame([(1,)], "user_id int")
    with caplog.at_level("WARNING"):
        jdbc.read_table(_Session(spark, users, []), "jdbc:x", "users", "user_id", {},
                        start="2024-01-01", end="2024-01-31", lower_bound=1, upper_bound=9)
    assert "has no created_at column" in caplog.text


def test_load_table_aligns_and_drops_null_keys(spark, monkeypatch):
    from strata.schemas import LIKES
    seen = {}

    def fake_write(df, url, table, properties, batch_size=1000, truncate_first=False, **kw):
        seen.update(rows=sorted(map(tuple, df.collect())), cols=df.columns,
                    truncate=truncate_first, table=table)

    monkeypatch.setattr(jdbc, "write_table", fake_write)
    src = spark.createDataFrame([(1, 10, 5, D(2024, 1, 1), 0), (None, 11, 6, D(2024, 1, 2), 1)],
                                "like_id int, post_id int, user_id int, created_at timestamp, "
                                "label int")
    jdbc.load_table(src, "jdbc:x", "likes", {}, schema=LIKES, clear_first=True)
    assert seen["cols"] == ["like_id", "post_id", "user_id", "created_at"]
    assert seen["rows"] == [(1, 10, 5, D(2024, 1, 1))] and seen["truncate"] is True


def test_load_tables_in_order_then_counts(spark, monkeypatch):
    loaded, counted = [], []
    monkeypatch.setattr(jdbc, "load_table", lambda df, url, table, props, schema=None,
                        clear_first=False, batch_size=1000:
                        loaded.append((table, schema, clear_first)))
    monkeypatch.setattr(jdbc, "table_counts", lambda sp, url, tables, props:
                        counted.extend(tables) or "counts")
    from strata.fixtures import Fixture
    from conftest import SF_SMALL
    f = Fixture(spark, SF_SMALL)
    sources = {"users": f.users(), "likes": f.likes(), "posts": f.posts().drop("sentiment"),
               "comments": f.comments().drop("sentiment")}
    assert jdbc.load_tables(spark, sources, "jdbc:x", {}) == "counts"
    # the reference's order (users are not loaded), every table counted afterwards
    from strata.schemas import BRONZE
    assert [t for t, _, _ in loaded] == ["posts", "comments", "likes"]
    assert all(schema == BRONZE[t] and clear for t, schema, clear in loaded)
    assert counted == ["users", "likes", "posts", "comments"]


class _QuantileReader:
    """Answers the split-point query the way a database would (NTILE over the
    key, first key of each tile) and records the scan's predicates."""

    def __init__(self, spark, table_df, column, calls):
        self.spark, self.table_df, self.column, self.calls = spark, table_df, column, calls

    def jdbc(self, url, table, predicates=None, properties=None, **kw):
        from pyspark.sql import Window, functions as F
        if "NTILE" in table:
            n = int(table.split("NTILE(")[1].split(")")[0])
            ranked = (self.table_df.where(F.col(self.column).isNotNull())
                      .withColumn("tile", F.ntile(n).over(Window.orderBy(self.column))))
            return ranked.groupBy("tile").agg(F.min(self.column).alias("lo")).select("lo")
        self.calls.append(predicates)
        return self.table_df


def test_quantile_split_balances_dense_ids(spark):
    # ids: a dense block holding most rows, a few far-off ids, and a NULL id
    ids = list(range(1, 901)) + [10_000_000 + i * 1000 for i in range(100)] + [None]
    likes = spark.createDataFrame([(i, D(2024, 1, 5)) for i in ids],
                                  "like_id int, created_at timestamp")
    calls = []
    session = _Session(spark, likes, calls)
    session.read = _QuantileReader(spark, likes, "like_id", calls)
    df = jdbc.read_table(session, "jdbc:x", "likes", "like_id", {}, num_partitions=4,
                         split="quantile")
    preds = calls[0]
    assert len(preds) == 4
    counts = [likes.where(p).count() for p in preds]
    assert sum(counts) == len(ids)                    # every row exactly once (NULL too)
    assert max(counts) <= 251                         # equal row counts, not equal strides
    assert df.count() == len(ids)


def test_range_predicates_without_points():
    assert jdbc.range_predicates("id", []) == ["(1 = 1) OR id IS NULL"]
    assert jdbc.range_predicates("id", [5, 9]) == [
        "(id < 5) OR id IS NULL", "id >= 5 AND id < 9", "id >= 9"]


def test_scan_is_split_within_the_window(spark):
    """Ids grow with time: 27 rows of a window of a table of 1000."""
    rows = [(i, D(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(1, 1001)]
    likes = spark.createDataFrame(rows, "like_id long, created_at timestamp")
    start, end = "2024-02-10", "2024-02-11"
    inside = [i for i, t in rows if D(2024, 2, 10) <= t <= D(2024, 2, 11)]
    calls = []
    df = jdbc.read_table(_Session(spark, likes, calls), "jdbc:x", "likes", "like_id", {}, start=start, end=end)
    assert (calls[1]["lower"], calls[1]["upper"]) == (min(inside), max(inside) + 1)
    assert sorted(r.like_id for r in df.collect()) == inside

    class Windowed(_QuantileReader):
        def jdbc(self, url, table, predicates=None, properties=None, **kw):
            assert properties["fetchsize"] == "10000"
            if "NTILE" in table:
                where = table.split("WHERE ")[1].split(")")[0]
                inner = _QuantileReader(self.spark, self.table_df.where(where), self.column, self.calls)
                return inner.jdbc(url, table)
            if predicates:
                self.calls.append(predicates)
            return self.table_df

    session, calls = _Session(spark, likes, calls), []
    session.read = Windowed(spark, likes, "like_id", calls)
    jdbc.read_table(session, "jdbc:x", "likes", "like_id", {}, start=start, end=end, num_partitions=5, split="quantile")
    window = likes.where(likes.like_id.isin(inside))
    assert [window.where(p).count() for p in calls[0]] == [5, 5, 5, 5, 5]


def test_keys_that_do_not_fit_fail_the_load(spark):
    import pytest
    from pyspark.sql import types as T
    from strata.schemas import LIKES
    rows = spark.createDataFrame([("3000000000", "1"), (None, "2"), ("7", "x")], "like_id string, post_id string")
    got = sorted((r.like_id, r.post_id) for r in jdbc.loadable(rows, LIKES).collect())
    assert got == [(7, None), (3000000000, 1)] or got == [(7, None), (3_000_000_000, 1)]
    bad = spark.createDataFrame([("12", "1"), ("abc", "2")], "like_id string, post_id string")
    with pytest.raises(Exception, match="like_id does not fit bigint: abc"):
        jdbc.loadable(bad, LIKES).collect()
    narrow = T.StructType([T.StructField("like_id", T.IntegerType())])
    with pytest.raises(Exception, match="does not fit int"):
        jdbc.loadable(rows, narrow).collect()


def test_counts_go_on_past_a_bad_table(spark):
    class Reader:
        def jdbc(self, url, table, properties=None):
            if table == "gone":
                raise ValueError("no such table")
            return spark.range(5)

    class Session:
        read = Reader()
        createDataFrame = spark.createDataFrame

    got = {r.table_name: r.row_count for r in jdbc.table_counts(Session(), "jdbc:x", ["posts", "gone", "likes"], {}).collect()}
    assert got == {"posts": 5, "gone": -1, "likes": 5}


def test_create_table_statements():
    from strata.schemas import BRONZE
    assert jdbc.create_table_sql("likes", BRONZE["likes"]) == (
        "CREATE TABLE IF NOT EXISTS likes (like_id BIGINT PRIMARY KEY, post_id BIGINT, user_id BIGINT, "
        "created_at TIMESTAMP)")
