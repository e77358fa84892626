"""Skewed inputs: one post, one user and one day each hold a third of the rows.

The gold reports run with broadcasts off and AQE skew handling forced on, and
must equal the oracle SQL (the reference join forms) run by DuckDB on the same
rows.
"""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest

from oracle import canon
from strata.fixtures import AS_OF
from strata.functions.text import KEYWORD_GROUPS
from strata.operators import gold
from strata.plans import catalog

HOT_DAY = pd.Timestamp("2024-01-20")
N_USERS, N_POSTS, N_LIKES, N_COMMENTS = 600, 3000, 30000, 15000


def _times(rng, n):
    base = pd.Timestamp("2023-12-01") + pd.to_timedelta(rng.integers(0, 60 * 86400, n), unit="s")
    hot = HOT_DAY + pd.to_timedelta(rng.integers(0, 86400, n), unit="s")
    return np.where(np.arange(n) % 3 == 0, hot, base)


def _ids(rng, n, size, hot):
    ids = rng.integers(0, size, n)
    ids[np.arange(n) % 3 == 1] = hot
    return ids.astype("int32")


@pytest.fixture(scope="module")
def frames():
    rng = np.random.default_rng(7)
    reg = [AS_OF - dt.timedelta(days=int(d)) for d in rng.integers(0, 200, N_USERS)]
    users = pd.DataFrame({
        "user_id": np.arange(N_USERS, dtype="int32"),
        "username": [f"user{i}" for i in range(N_USERS)],
        "email": [f"u{i}@example.com" for i in range(N_USERS)],
        "password_hash": ["h"] * N_USERS,
        "full_name": ["n"] * N_USERS,
        "registration_date": [None if i % 11 == 0 else r for i, r in enumerate(reg)],
    })
    groups = [list(g) for g in KEYWORD_GROUPS]
    posts = pd.DataFrame({
        "post_id": np.arange(N_POSTS, dtype="int32"),
        "user_id": _ids(rng, N_POSTS, N_USERS, 0),
        "content": ["text"] * N_POSTS,
        "created_at": _times(rng, N_POSTS),
        "sentiment": rng.choice([0.0, 1.0, np.nan], N_POSTS),
        "keywords": [groups[i % 4] for i in range(N_POSTS)],
    })
    likes = pd.DataFrame({
        "like_id": np.arange(N_LIKES, dtype="int32"),
        "post_id": _ids(rng, N_LIKES, N_POSTS, 0),
        "user_id": _ids(rng, N_LIKES, N_USERS, 7),
        "created_at": _times(rng, N_LIKES),
    })
    comments = pd.DataFrame({
        "comment_id": np.arange(N_COMMENTS, dtype="int32"),
        "post_id": _ids(rng, N_COMMENTS, N_POSTS, 0),
        "user_id": _ids(rng, N_COMMENTS, N_USERS, 7),
        "content": ["c"] * N_COMMENTS,
        "created_at": _times(rng, N_COMMENTS),
        "sentiment": rng.choice([0.0, 1.0], N_COMMENTS),
        "keywords": [groups[(i * 7) % 4] for i in range(N_COMMENTS)],
    })
    return {"users": users, "posts": posts, "likes": likes, "comments": comments}


SCHEMAS = {
    "users": "user_id int, username string, email string, password_hash string, "
             "full_name string, registration_date date",
    "posts": "post_id int, user_id int, content string, created_at timestamp, sentiment double, "
             "keywords array<string>",
    "likes": "like_id int, post_id int, user_id int, created_at timestamp",
    "comments": "comment_id int, post_id int, user_id int, content string, created_at timestamp, "
                "sentiment double, keywords array<string>",
}

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


@pytest.mark.parametrize("name,body", [
    ("daily_summary", catalog.GOLD_DAILY_SUMMARY_BODY),
    ("post_performance", catalog.GOLD_POST_PERFORMANCE_BODY),
    ("user_snapshot", catalog.GOLD_USER_SNAPSHOT_BODY),
    ("content_trends", catalog.GOLD_CONTENT_TRENDS_BODY),
])
def test_gold_under_skew(spark, frames, name, body):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t, pdf in frames.items():
        con.register(t, pdf)
    con.execute("CREATE VIEW posts_kw AS SELECT * FROM posts")
    con.execute("CREATE VIEW comments_kw AS SELECT * FROM comments")
    cur = con.execute("WITH " + body)
    want = canon(cur.fetchall(), [d[0] for d in cur.description])

    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = {t: spark.createDataFrame(pdf, SCHEMAS[t]) for t, pdf in frames.items()}
        out = {
            "daily_summary": lambda: gold.daily_summary(df["posts"], df["comments"], df["likes"]),
            "post_performance": lambda: gold.post_performance(df["posts"], df["users"],
                                                              df["likes"], df["comments"]),
            "user_snapshot": lambda: gold.user_snapshot(df["users"], df["posts"], df["comments"],
                                                        df["likes"], as_of=AS_OF),
            "content_trends": lambda: gold.content_trends(df["posts"], df["comments"]),
        }[name]()
        got = canon([tuple(r) for r in out.collect()], out.columns)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(want)
    assert got == want
