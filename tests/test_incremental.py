"""Windows after windows: late rows, repeated runs, runs that failed before their
commit, keys that came before."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.fixtures import AS_OF, Fixture
from strata.operators import gold, incremental
from strata.operators.incremental import CommitLog, DailyActivity, KeyLedger, UserState

T = dt.datetime
POSTS = "post_id long, user_id long, content string, created_at timestamp, sentiment double"
COMMENTS = "comment_id long, post_id long, user_id long, content string, created_at timestamp, sentiment double"
LIKES = "like_id long, post_id long, user_id long, created_at timestamp"


def window(spark, posts=(), comments=(), likes=()):
    return (spark.createDataFrame([(i, u, "x", t, s) for i, u, t, s in posts], POSTS),
            spark.createDataFrame([(i, p, u, "x", t, s) for i, p, u, t, s in comments], COMMENTS),
            spark.createDataFrame(list(likes), LIKES))


FIRST = dict(posts=[(1, 10, T(2024, 1, 1, 5), 1.0), (2, 11, T(2024, 1, 2), 0.0), (3, None, T(2024, 1, 3), None)],
             comments=[(1, 1, 11, T(2024, 1, 2), 1.0), (2, 7, 12, None, 0.0)], likes=[(1, 1, 12, T(2024, 1, 3))])
SECOND = dict(posts=[(4, 10, T(2024, 1, 1, 23), 0.0)], comments=[(3, 1, 12, T(2024, 1, 4), 0.0), (4, None, 12, T(2024, 1, 4), 1.0)],
              likes=[(2, 1, 10, T(2024, 1, 4)), (3, 4, None, None)])


def both(spark):
    return [a.unionByName(b) for a, b in zip(window(spark, **FIRST), window(spark, **SECOND))]


def rows(df):
    return sorted(map(repr, df.collect()))


def files(uri):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{uri}/**/*.parquet", recursive=True)}


def test_daily_summary_after_late_rows(spark, tmp_path):
    daily = DailyActivity(spark, str(tmp_path))
    assert daily.summary().count() == 0
    assert set(daily.add("a", *window(spark, **FIRST))) == {dt.date(2024, 1, d) for d in (1, 2, 3)} | {None}
    assert rows(daily.summary()) == rows(gold.daily_summary(*window(spark, **FIRST)))
    before = files(daily.summary_uri)
    assert set(daily.add("b", *window(spark, **SECOND))) == {dt.date(2024, 1, 1), dt.date(2024, 1, 4), None}
    assert rows(daily.summary()) == rows(gold.daily_summary(*both(spark)))
    after = files(daily.summary_uri)
    untouched = {p for p in before if "2024-01-02" in p or "2024-01-03" in p}
    assert len(untouched) == 2 and all(after.get(p) == before[p] for p in untouched)
    assert not any(p in after for p in before if "2024-01-01" in p)


def test_daily_summary_of_a_repeated_and_an_empty_window(spark, tmp_path):
    daily = DailyActivity(spark, str(tmp_path))
    for name in ("a", "a"):
        daily.add(name, *window(spark, **FIRST))
    assert daily.add("empty", *window(spark)) == []
    assert rows(daily.summary()) == rows(gold.daily_summary(*window(spark, **FIRST)))


def test_summary_reads_only_touched_days(spark, tmp_path):
    daily = DailyActivity(spark, str(tmp_path))
    daily.add("a", *window(spark, **FIRST))
    events = spark.read.parquet(daily.events_uri).where(F.col("report_date").isin([dt.date(2024, 1, 2)]))
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "report_date" in plan.split("PartitionFilters: [")[1]


def test_user_state_merges_windows(spark, tmp_path):
    users = spark.createDataFrame([(u, f"u{u}", None, "h", "n", dt.date(2023, 12, 20)) for u in (10, 11, 12, 13)],
                                  "user_id long, username string, email string, password_hash string, "
                                  "full_name string, registration_date date")
    state = UserState(spark, str(tmp_path))
    none = state.snapshot(users, as_of=AS_OF)
    assert rows(none) == rows(gold.user_snapshot(users, *window(spark), as_of=AS_OF))
    assert state.add("a", *window(spark, **FIRST)) and not state.add("a", *window(spark, **SECOND))
    assert rows(state.snapshot(users, AS_OF)) == rows(gold.user_snapshot(users, *window(spark, **FIRST), as_of=AS_OF))
    assert state.add("b", *window(spark, **SECOND))
    got, want = state.snapshot(users, AS_OF), gold.user_snapshot(users, *both(spark), as_of=AS_OF)
    assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want)
    assert [c["window"] for c in state.log.rows()] == ["a", "b"]


def test_a_run_that_failed_before_its_commit_did_nothing(spark, tmp_path, monkeypatch):
    users = Fixture(spark, SF_SMALL).users()
    state = UserState(spark, str(tmp_path / "state"))
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), spark.createDataFrame([], LIKES).select("like_id").schema)
    state.add("a", *window(spark, **FIRST))
    want = rows(state.snapshot(users, AS_OF))
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        for run in (lambda: state.add("b", *window(spark, **SECOND)),
                    lambda: ledger.admit("b", window(spark, **SECOND)[2], ["created_at"])):
            with pytest.raises(OSError):
                run()
    assert rows(state.snapshot(users, AS_OF)) == want and ledger.keys().count() == 0
    assert state.add("b", *window(spark, **SECOND))
    assert rows(state.snapshot(users, AS_OF)) == rows(gold.user_snapshot(users, *both(spark), as_of=AS_OF))
    assert ledger.admit("b", window(spark, **SECOND)[2], ["created_at"]).count() == 2


def test_keys_are_admitted_once(spark, tmp_path):
    schema = spark.createDataFrame([], LIKES).select("like_id").schema
    # one slot: every row is in doubt, and the exact comparison decides
    for k, bits in enumerate((5, 12)):
        ledger = KeyLedger(spark, str(tmp_path / f"l{k}"), schema)
        a = spark.createDataFrame([(i, 1, 1, T(2024, 1, 1, i % 24)) for i in [*range(50), *range(30)]] + [(None, 1, 1, None)], LIKES)
        b = spark.createDataFrame([(i, 2, 2, T(2024, 1, 2)) for i in range(40, 90)] + [(None, 2, 2, None)], LIKES)
        got = [ledger.admit(w, df, ["created_at"], bits) for w, df in (("a", a), ("b", b))]
        assert sorted(r.like_id for r in got[0].dropna(subset=["like_id"]).collect()) == list(range(50))
        assert sorted(r.like_id for r in got[1].collect()) == list(range(50, 90))
        assert got[0].count() == 51 and ledger.keys().count() == 91
        # repeated windows are read, not admitted anew
        assert rows(ledger.admit("b", a, ["created_at"], bits)) == rows(got[1])


def test_the_filter_lets_every_known_key_pass(spark):
    keys = spark.range(3000).select((F.col("id") * 7919).alias("k"), F.concat(F.lit("s"), "id").alias("s"))
    words = incremental.bloom_filter(keys, 16)
    assert len(words.first()["words"]) == 1 << 11
    inside = keys.where(incremental.may_contain(words.scalar(), ["k", "s"], 16)).count()
    others = keys.withColumn("k", F.col("k") + 1)
    passed = others.where(incremental.may_contain(words.scalar(), ["k", "s"], 16)).count()
    assert inside == 3000 and passed < 150
    empty = incremental.bloom_filter(keys.limit(0), 16)
    assert keys.where(incremental.may_contain(empty.scalar(), ["k", "s"], 16)).count() == 0


def test_surely_new_rows_are_not_shuffled(spark):
    f = Fixture(spark, SF_SMALL)
    posts, seen = f.posts(), spark.range(5).select(F.col("id").alias("post_id"))
    new = incremental.unseen(posts.select("post_id", "content"), seen, ["post_id"])
    assert sorted(r.post_id for r in new.collect()) == sorted(r.post_id for r in posts.collect() if r.post_id >= 5)
