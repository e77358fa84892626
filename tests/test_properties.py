"""Property tests: the rewritten Spark plans equal the reference join forms
(the oracle SQL bodies, run by DuckDB) on random dirty inputs: repeated ids,
NULL users and sentiment, posts without engagement, events on shared days,
undated events (which the join form keeps apart per table)."""

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle import canon
from strata.fixtures import AS_OF
from strata.functions.text import KEYWORD_GROUPS
from strata.operators import gold, quality
from strata.plans import catalog

DAYS = [dt.datetime(2024, 1, d, h) for d in (1, 2, 20, 31) for h in (0, 13)] + [None]
opt_int = st.one_of(st.none(), st.integers(0, 4))
sentiment = st.sampled_from([None, 0.0, 1.0, 2.0])
groups = st.sampled_from([list(g) for g in KEYWORD_GROUPS] + [[], None])

post_row = st.tuples(st.integers(0, 6), opt_int, st.sampled_from(DAYS), sentiment, groups)
comment_row = st.tuples(st.integers(0, 9), st.integers(0, 7), opt_int, st.sampled_from(DAYS),
                        sentiment, groups)
like_row = st.tuples(st.integers(0, 9), st.integers(0, 7), opt_int, st.sampled_from(DAYS))
user_row = st.tuples(st.integers(0, 5), st.sampled_from([None, AS_OF - dt.timedelta(days=10),
                                                         AS_OF - dt.timedelta(days=100)]))

SCHEMAS = {
    "posts": "post_id int, user_id int, created_at timestamp, sentiment double, "
             "keywords array<string>",
    "comments": "comment_id int, post_id int, user_id int, created_at timestamp, "
                "sentiment double, keywords array<string>",
    "likes": "like_id int, post_id int, user_id int, created_at timestamp",
    "users": "user_id int, username string, email string, full_name string, "
             "registration_date date",
}
COLS = {k: [c.split()[0] for c in v.split(", ")] for k, v in SCHEMAS.items()}

data = st.fixed_dictionaries({
    "posts": st.lists(post_row, min_size=1, max_size=12),
    "comments": st.lists(comment_row, max_size=12),
    "likes": st.lists(like_row, max_size=12),
    "users": st.lists(user_row, min_size=1, max_size=6),
})

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frames(spark, d):
    users = [(u, f"n{u}", "e@x.io", "f", r) for u, r in d["users"]]
    rows = dict(d, users=users)
    sdf = {t: spark.createDataFrame(rows[t], SCHEMAS[t]) for t in SCHEMAS}
    sdf["posts"] = sdf["posts"].withColumn("content", sdf["posts"]["post_id"].cast("string"))
    con = duckdb.connect()
    for t in SCHEMAS:
        pdf = pd.DataFrame(rows[t], columns=COLS[t])
        for c in ("post_id", "user_id", "comment_id", "like_id"):
            if c in pdf:
                pdf[c] = pdf[c].astype("Int32")
        for c in ("sentiment",):
            if c in pdf:
                pdf[c] = pdf[c].astype("Float64")
        if "created_at" in pdf:
            pdf["created_at"] = pd.to_datetime(pdf["created_at"])
        if "registration_date" in pdf:
            pdf["registration_date"] = pd.to_datetime(pdf["registration_date"]).dt.date
        if "keywords" in pdf:
            con.register(f"{t}_raw", pdf)
            kw = "CAST(keywords AS VARCHAR[]) AS keywords"
            con.execute(f"CREATE TABLE {t} AS SELECT * REPLACE ({kw}) FROM {t}_raw")
        else:
            con.register(t, pdf)
    con.execute("CREATE VIEW posts_kw AS SELECT *, CAST(post_id AS VARCHAR) AS content FROM posts")
    con.execute("CREATE VIEW comments_kw AS SELECT * FROM comments")
    return sdf, con


def _check(con, body, df):
    cur = con.execute("WITH " + body)
    want = canon(cur.fetchall(), [x[0] for x in cur.description])
    got = canon([tuple(r) for r in df.collect()], df.columns)
    assert got == want


@SETTINGS
@given(d=data)
def test_daily_summary_equals_join_form(spark, d):
    s, con = _frames(spark, d)
    _check(con, catalog.GOLD_DAILY_SUMMARY_BODY,
           gold.daily_summary(s["posts"], s["comments"], s["likes"]))


@SETTINGS
@given(d=data)
def test_user_snapshot_equals_join_form(spark, d):
    s, con = _frames(spark, d)
    con.execute("CREATE VIEW users_v AS SELECT * FROM users")
    _check(con, catalog.GOLD_USER_SNAPSHOT_BODY,
           gold.user_snapshot(s["users"], s["posts"], s["comments"], s["likes"], as_of=AS_OF))


@SETTINGS
@given(d=data)
def test_post_performance_and_trends_equal_join_form(spark, d):
    s, con = _frames(spark, d)
    posts = s["posts"].withColumn("content", s["posts"]["post_id"].cast("string"))
    con.execute("CREATE VIEW posts_c AS SELECT *, CAST(post_id AS VARCHAR) AS content FROM posts")
    body = catalog.GOLD_POST_PERFORMANCE_BODY.replace("FROM posts p", "FROM posts_c p")
    _check(con, body, gold.post_performance(posts, s["users"], s["likes"], s["comments"]))
    _check(con, catalog.GOLD_CONTENT_TRENDS_BODY, gold.content_trends(posts, s["comments"]))


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), opt_int,
                               st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                     max_size=15))
def test_dedup_equals_row_number_first(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v string")
    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows, columns=["k", "t", "v"]).astype(
        {"k": "Int32", "t": "Int32"}))
    cur = con.execute(catalog._dedup_sql("t", ["k", "t", "v"], ["k"], ["t"]))
    want = canon(cur.fetchall(), ["k", "t", "v"])
    out = quality.dedup(df, ["k"], ["t"])
    assert canon([tuple(r) for r in out.collect()], out.columns) == want
