"""The registered queries (see :mod:`strata.plans.registry`).

Inputs are the fixture tables derived from the driver's parquet files
(:class:`strata.fixtures.Fixture`); the as-of date, date window and chunk
parameters are the fixture's (FIXTURES.md section 3).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import (AS_OF, CHUNK_DAYS, CHUNK_ORIGIN, FULL_END, FULL_START, WINDOW_END,
                        WINDOW_START, Fixture,
                        duck_keywords, duckdb_views)
from ..functions.columns import EMAIL_PATTERN
from ..operators import chunks, gold, incremental, nlp, quality, sentiment, shape
from ..schemas import (GOLD_DAILY_SUMMARY_COLUMNS, KEYWORDS_FIELD, LIKES, POSTS, SENTIMENT_FIELD,
                       SILVER_COMMENTS_COLUMNS, SILVER_POSTS_COLUMNS)
from ..session import scratch_path, write_freed
from ..sources import parquet as pq
from ..sources import jdbc, sinks
from . import entities as E
from .registry import register

AS_OF_SQL = f"DATE '{AS_OF}'"


_FIXTURES: dict[tuple[str, str], Fixture] = {}


def fx(spark: SparkSession, sf_dir: str) -> Fixture:
    """One fixture per session and folder: a file's footer is read once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FIXTURES:
        _FIXTURES[key] = Fixture(spark, sf_dir)
    return _FIXTURES[key]


# ---------------------------------------------------------------------------
# G-4 daily platform summary and its parts
# ---------------------------------------------------------------------------

_DAILY_PARTS_SQL = """
pd AS (SELECT CAST(created_at AS DATE) AS report_date,
              count(DISTINCT post_id) AS total_posts, count(DISTINCT user_id) AS active_posters,
              CAST(sum(CASE WHEN sentiment = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_posts_count,
              CAST(sum(CASE WHEN sentiment = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_posts_count
       FROM posts GROUP BY 1),
cd AS (SELECT CAST(created_at AS DATE) AS report_date,
              count(DISTINCT comment_id) AS total_comments,
              count(DISTINCT user_id) AS active_commenters,
              CAST(sum(CASE WHEN sentiment = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_comments_count,
              CAST(sum(CASE WHEN sentiment = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_comments_count
       FROM comments GROUP BY 1),
ld AS (SELECT CAST(created_at AS DATE) AS report_date,
              count(DISTINCT like_id) AS total_likes, count(DISTINCT user_id) AS active_likers
       FROM likes GROUP BY 1),
au AS (SELECT report_date, count(DISTINCT user_id) AS total_active_users FROM (
         SELECT CAST(created_at AS DATE) AS report_date, user_id FROM posts
         UNION SELECT CAST(created_at AS DATE), user_id FROM comments
         UNION SELECT CAST(created_at AS DATE), user_id FROM likes) GROUP BY 1)"""


@register("daily_posts", oracle=duckdb_views("posts") + "," + _DAILY_PARTS_SQL
          + "\nSELECT * FROM pd")
def q_daily_posts(spark, sf_dir):
    return gold.daily_posts(fx(spark, sf_dir).posts())


@register("daily_comments", oracle=duckdb_views("comments", "posts", "likes") + ","
          + _DAILY_PARTS_SQL + "\nSELECT * FROM cd")
def q_daily_comments(spark, sf_dir):
    return gold.daily_comments(fx(spark, sf_dir).comments())


@register("daily_likes", oracle=duckdb_views("likes", "posts", "comments") + ","
          + _DAILY_PARTS_SQL + "\nSELECT * FROM ld")
def q_daily_likes(spark, sf_dir):
    return gold.daily_likes(fx(spark, sf_dir).likes())


@register("daily_active_users", oracle=duckdb_views("posts", "comments", "likes") + ","
          + _DAILY_PARTS_SQL + "\nSELECT * FROM au")
def q_daily_active_users(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.daily_active_users(f.posts(), f.comments(), f.likes())


GOLD_DAILY_SUMMARY_BODY = _DAILY_PARTS_SQL + """,
j AS (SELECT coalesce(pd.report_date, cd.report_date) AS report_date,
             pd.total_posts, pd.active_posters, pd.positive_posts_count, pd.negative_posts_count,
             cd.total_comments, cd.active_commenters, cd.positive_comments_count,
             cd.negative_comments_count
      FROM pd FULL OUTER JOIN cd ON pd.report_date = cd.report_date),
k AS (SELECT coalesce(j.report_date, ld.report_date) AS report_date,
             coalesce(total_posts, 0) AS total_posts, coalesce(active_posters, 0) AS active_posters,
             coalesce(positive_posts_count, 0) AS positive_posts_count,
             coalesce(negative_posts_count, 0) AS negative_posts_count,
             coalesce(total_comments, 0) AS total_comments,
             coalesce(active_commenters, 0) AS active_commenters,
             coalesce(positive_comments_count, 0) AS positive_comments_count,
             coalesce(negative_comments_count, 0) AS negative_comments_count,
             coalesce(total_likes, 0) AS total_likes, coalesce(active_likers, 0) AS active_likers
      FROM j FULL OUTER JOIN ld ON j.report_date = ld.report_date)
SELECT k.*,
       CASE WHEN total_posts > 0 THEN total_comments / total_posts ELSE 0 END AS avg_comments_per_post,
       CASE WHEN total_posts > 0 THEN total_likes / total_posts ELSE 0 END AS avg_likes_per_post,
       coalesce(au.total_active_users, 0) AS total_active_users
FROM k LEFT JOIN au ON k.report_date = au.report_date"""


GOLD_DAILY_SUMMARY_SQL = duckdb_views("posts", "comments", "likes") + "," + GOLD_DAILY_SUMMARY_BODY


@register("gold_daily_summary", oracle=GOLD_DAILY_SUMMARY_SQL)
def q_gold_daily_summary(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.daily_summary(f.posts(), f.comments(), f.likes())


# ---------------------------------------------------------------------------
# G-2 post performance and its parts
# ---------------------------------------------------------------------------

_ENGAGEMENT_SQL = """
lc AS (SELECT post_id, min(created_at) AS first_like_time, count(*) AS total_likes
       FROM likes GROUP BY post_id),
cc AS (SELECT post_id, min(created_at) AS first_comment_time, count(*) AS total_comments
       FROM comments GROUP BY post_id)"""


@register("first_engagement", oracle=duckdb_views("likes", "posts", "comments") + ","
          + _ENGAGEMENT_SQL + """
SELECT coalesce(lc.post_id, cc.post_id) AS post_id, first_like_time, first_comment_time,
       total_likes, total_comments
FROM lc FULL OUTER JOIN cc ON lc.post_id = cc.post_id""")
def q_first_engagement(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.first_engagement(f.likes(), f.comments())


GOLD_POST_PERFORMANCE_BODY = _ENGAGEMENT_SQL + """
SELECT p.post_id, CAST(p.created_at AS DATE) AS created_date, p.content AS post_content,
       p.sentiment AS post_sentiment, p.user_id, u.username, lc.total_likes, cc.total_comments,
       round((floor(epoch(lc.first_like_time)) - floor(epoch(p.created_at))) / 60)
           AS time_to_first_like_minutes,
       round((floor(epoch(cc.first_comment_time)) - floor(epoch(p.created_at))) / 60)
           AS time_to_first_comment_minutes
FROM posts p
LEFT JOIN (SELECT user_id, username FROM users) u ON p.user_id = u.user_id
LEFT JOIN lc ON p.post_id = lc.post_id
LEFT JOIN cc ON p.post_id = cc.post_id"""


GOLD_POST_PERFORMANCE_SQL = (duckdb_views("users", "posts", "likes", "comments") + ","
                             + GOLD_POST_PERFORMANCE_BODY)


@register("gold_post_performance", oracle=GOLD_POST_PERFORMANCE_SQL)
def q_gold_post_performance(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.post_performance(f.posts(), f.users(), f.likes(), f.comments())


def bucketed_feeds(spark, f: Fixture, buckets: int = 8):
    """Posts, likes and comments in buckets of ``post_id``."""
    from uuid import uuid4
    from ..sources.bucketed import write_bucketed
    return [write_bucketed(df, f"strata_{name}_{uuid4().hex}", scratch_path(spark, f"bucketed_{name}"), "post_id", buckets)
            for name, df in (("posts", f.posts()), ("likes", f.likes()), ("comments", f.comments()))]


@register("gold_post_performance_bucketed", oracle=GOLD_POST_PERFORMANCE_SQL)
def q_gold_post_performance_bucketed(spark, sf_dir):
    f = fx(spark, sf_dir)
    posts, likes, comments = bucketed_feeds(spark, f)
    return gold.post_performance_in_place(posts, f.users(), likes, comments)


# ---------------------------------------------------------------------------
# G-1 content trends and its parts
# ---------------------------------------------------------------------------

@register("explode_keywords", oracle=duckdb_views("posts_kw") + """
SELECT post_id, CAST(created_at AS DATE) AS report_date, unnest(keywords) AS topic_or_keyword
FROM posts_kw""")
def q_explode_keywords(spark, sf_dir):
    return gold.explode_keywords(fx(spark, sf_dir).posts_kw(), "post_id")


GOLD_CONTENT_TRENDS_BODY = """
ep AS (SELECT CAST(created_at AS DATE) AS report_date, unnest(keywords) AS topic_or_keyword
       FROM posts_kw),
ec AS (SELECT CAST(created_at AS DATE) AS report_date, unnest(keywords) AS topic_or_keyword
       FROM comments_kw),
pc AS (SELECT report_date, topic_or_keyword, count(*) AS n FROM ep GROUP BY 1, 2),
cc AS (SELECT report_date, topic_or_keyword, count(*) AS n FROM ec GROUP BY 1, 2),
j AS (SELECT coalesce(pc.report_date, cc.report_date) AS report_date,
             coalesce(pc.topic_or_keyword, cc.topic_or_keyword) AS topic_or_keyword,
             coalesce(pc.n, 0) AS mention_count_in_posts,
             coalesce(cc.n, 0) AS mention_count_in_comments
      FROM pc FULL OUTER JOIN cc
        ON pc.report_date = cc.report_date AND pc.topic_or_keyword = cc.topic_or_keyword)
SELECT report_date, topic_or_keyword, mention_count_in_posts, mention_count_in_comments,
       mention_count_in_posts + mention_count_in_comments AS total_mentions,
       CAST(NULL AS FLOAT) AS avg_sentiment_when_mentioned,
       CAST(row_number() OVER (PARTITION BY report_date
                               ORDER BY mention_count_in_posts + mention_count_in_comments DESC,
                                        topic_or_keyword ASC,
                                        mention_count_in_posts DESC) AS INTEGER) AS trending_rank
FROM j"""


GOLD_CONTENT_TRENDS_SQL = duckdb_views("posts_kw", "comments_kw") + "," + GOLD_CONTENT_TRENDS_BODY


@register("gold_content_trends", oracle=GOLD_CONTENT_TRENDS_SQL)
def q_gold_content_trends(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.content_trends(f.posts_kw(), f.comments_kw())


# ---------------------------------------------------------------------------
# G-3 user snapshot and its parts
# ---------------------------------------------------------------------------

_FEEDBACK_SQL = """
cr AS (SELECT post_id, count(*) AS total_comments_received,
              avg(CASE WHEN sentiment = 1 THEN 1 ELSE 0 END) AS positive_comment_received_ratio
       FROM comments GROUP BY post_id),
lr AS (SELECT post_id, count(*) AS total_likes_received FROM likes GROUP BY post_id),
pf AS (SELECT p.user_id,
              CAST(sum(cr.total_comments_received) AS BIGINT) AS total_comments_received,
              CAST(sum(lr.total_likes_received) AS BIGINT) AS total_likes_received,
              avg(lr.total_likes_received) AS avg_likes_per_post,
              avg(cr.total_comments_received) AS avg_comments_per_post,
              avg(cr.positive_comment_received_ratio) AS positive_comment_received_ratio,
              count(cr.total_comments_received) AS total_feedback_count
       FROM posts p LEFT JOIN cr ON p.post_id = cr.post_id LEFT JOIN lr ON p.post_id = lr.post_id
       GROUP BY p.user_id),
la AS (SELECT user_id, max(created_at) AS last_active_date FROM (
         SELECT user_id, created_at FROM posts
         UNION ALL SELECT user_id, created_at FROM comments
         UNION ALL SELECT user_id, created_at FROM likes) GROUP BY user_id)"""


@register("user_feedback", oracle=duckdb_views("posts", "comments", "likes") + ","
          + _FEEDBACK_SQL + "\nSELECT * FROM pf")
def q_user_feedback(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.user_feedback(f.posts(), f.comments(), f.likes())


@register("last_activity", oracle=duckdb_views("posts", "comments", "likes") + ","
          + _FEEDBACK_SQL + "\nSELECT * FROM la")
def q_last_activity(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.last_activity(f.posts(), f.comments(), f.likes())


_SEGMENT_CASE = f"""CASE WHEN account_age_days <= 30 THEN 'New User'
            WHEN last_active_date < {AS_OF_SQL} - 90 THEN 'Churned'
            WHEN last_active_date < {AS_OF_SQL} - 30 THEN 'At Risk'
            ELSE 'Casual User' END"""


@register("user_segment", oracle=duckdb_views("users", "posts", "comments", "likes") + ","
          + _FEEDBACK_SQL + f""",
s AS (SELECT u.user_id,
             CAST(coalesce(date_diff('day', u.registration_date, {AS_OF_SQL}), 0) AS INTEGER)
                 AS account_age_days,
             la.last_active_date
      FROM users u LEFT JOIN la ON u.user_id = la.user_id)
SELECT s.*, {_SEGMENT_CASE} AS user_segment FROM s""")
def q_user_segment(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.user_segment(f.users(), f.posts(), f.comments(), f.likes(), as_of=AS_OF)


GOLD_USER_SNAPSHOT_BODY = _FEEDBACK_SQL + f""",
pa AS (SELECT user_id, count(*) AS total_posts_per_user,
              avg(CASE WHEN sentiment = 1 THEN 1 ELSE 0 END) AS positive_post_ratio,
              CAST(sum(CASE WHEN created_at >= {AS_OF_SQL} - 30 THEN 1 ELSE 0 END) AS BIGINT)
                  AS posts_in_last_30_days
       FROM posts GROUP BY user_id),
ca AS (SELECT user_id, count(*) AS total_comments_given,
              CAST(sum(CASE WHEN created_at >= {AS_OF_SQL} - 30 THEN 1 ELSE 0 END) AS BIGINT)
                  AS comments_in_last_30_days
       FROM comments GROUP BY user_id),
lg AS (SELECT user_id, count(*) AS total_likes_given FROM likes GROUP BY user_id),
s AS (SELECT u.user_id, u.username, u.email, u.full_name, u.registration_date,
             coalesce(pa.total_posts_per_user, 0) AS total_posts_per_user,
             coalesce(pa.positive_post_ratio, 0) AS positive_post_ratio,
             coalesce(pa.posts_in_last_30_days, 0) AS posts_in_last_30_days,
             coalesce(ca.total_comments_given, 0) AS total_comments_given,
             coalesce(ca.comments_in_last_30_days, 0) AS comments_in_last_30_days,
             coalesce(lg.total_likes_given, 0) AS total_likes_given,
             coalesce(pf.total_comments_received, 0) AS total_comments_received,
             coalesce(pf.total_likes_received, 0) AS total_likes_received,
             coalesce(pf.avg_likes_per_post, 0) AS avg_likes_per_post,
             coalesce(pf.avg_comments_per_post, 0) AS avg_comments_per_post,
             coalesce(pf.positive_comment_received_ratio, 0) AS positive_comment_received_ratio,
             coalesce(pf.total_feedback_count, 0) AS total_feedback_count,
             la.last_active_date,
             CAST(coalesce(date_diff('day', u.registration_date, {AS_OF_SQL}), 0) AS INTEGER)
                 AS account_age_days
      FROM users u
      LEFT JOIN pa ON u.user_id = pa.user_id
      LEFT JOIN ca ON u.user_id = ca.user_id
      LEFT JOIN lg ON u.user_id = lg.user_id
      LEFT JOIN pf ON u.user_id = pf.user_id
      LEFT JOIN la ON u.user_id = la.user_id)
SELECT s.*, {AS_OF_SQL} AS snapshot_date, {_SEGMENT_CASE} AS user_segment FROM s"""


GOLD_USER_SNAPSHOT_SQL = (duckdb_views("users", "posts", "comments", "likes") + ","
                          + GOLD_USER_SNAPSHOT_BODY)


@register("gold_user_snapshot", oracle=GOLD_USER_SNAPSHOT_SQL)
def q_gold_user_snapshot(spark, sf_dir):
    f = fx(spark, sf_dir)
    return gold.user_snapshot(f.users(), f.posts(), f.comments(), f.likes(), as_of=AS_OF)


# ---------------------------------------------------------------------------
# Data quality (Q-1..Q-3, A-14, V-1)
# ---------------------------------------------------------------------------


USER_COLUMNS = ["user_id", "username", "email", "password_hash", "full_name", "registration_date"]
POST_COLUMNS = ["post_id", "user_id", "content", "created_at", "sentiment"]
COMMENT_COLUMNS = ["comment_id", "post_id", "user_id", "content", "created_at", "sentiment"]
LIKE_COLUMNS = ["like_id", "post_id", "user_id", "created_at"]
# DuckDB literal of the e-mail pattern (escaped dot written as a class).
EMAIL_SQL = "'" + EMAIL_PATTERN.replace(r"\.", "[.]") + "'"


def _missing_sql(view: str, cols: list[str]) -> str:
    counts = ", ".join(f"count_if({c} IS NULL) AS m{i}" for i, c in enumerate(cols))
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(m{i} AS BIGINT) AS missing_count, "
        f"CASE WHEN total > 0 THEN m{i} / total ELSE 0.0 END AS missing_ratio FROM t"
        for i, c in enumerate(cols))
    return f",\nt AS (SELECT count(*) AS total, {counts} FROM {view})\n{rows}"


@register("dq_missing", oracle=duckdb_views("users") + _missing_sql("users", USER_COLUMNS))
def q_dq_missing(spark, sf_dir):
    return quality.missing_report(fx(spark, sf_dir).users())


@register("dq_missing_sampled", oracle=duckdb_views("users") + """,
sampled AS (SELECT * FROM users WHERE CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT)
                                      < CAST(round(0.2 * 4294967296) AS BIGINT))"""
          + _missing_sql("sampled", USER_COLUMNS))
def q_dq_missing_sampled(spark, sf_dir):
    return quality.missing_report(fx(spark, sf_dir).users(), fraction=0.2, sample_key="user_id")


@register("dq_duplicates", oracle=duckdb_views("posts_dup") + """,
k AS (SELECT post_id, count(*) AS n FROM posts_dup GROUP BY post_id)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_count,
       CASE WHEN sum(n) > 0 THEN (sum(n) - count(*)) / sum(n) ELSE 0.0 END AS duplicate_ratio
FROM k""")
def q_dq_duplicates(spark, sf_dir):
    return quality.duplicate_report(fx(spark, sf_dir).posts_dup(), ["post_id"])


def _dedup_sql(view: str, cols: list[str], keys: list[str], order: list[str]) -> str:
    """First row per key by ``order`` then the other columns, NULLs first."""
    rest = [c for c in cols if c not in keys]
    seq = [c for c in order if c in rest] + [c for c in rest if c not in order]
    order_by = ", ".join(f"{c} ASC NULLS FIRST" for c in seq)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {order_by}) AS __rn FROM {view}) "
            f"WHERE __rn = 1")


@register("dedup", oracle=duckdb_views("posts_dup") + "\n"
          + _dedup_sql("posts_dup", POST_COLUMNS, ["post_id"], ["created_at", "post_id"]))
def q_dedup(spark, sf_dir):
    return quality.dedup(fx(spark, sf_dir).posts_dup(), ["post_id"], ["created_at", "post_id"])


@register("dq_email", oracle=duckdb_views("users") + f"""
SELECT CAST(count_if(regexp_matches(email, {EMAIL_SQL})) AS BIGINT) AS valid_email_count,
       CAST(count_if(NOT regexp_matches(email, {EMAIL_SQL})) AS BIGINT) AS invalid_email_count,
       CAST(count_if(email IS NULL) AS BIGINT) AS null_email_count,
       count(*) AS total_count,
       CASE WHEN count(*) > 0 THEN count_if(NOT regexp_matches(email, {EMAIL_SQL})) / count(*)
            ELSE 0.0 END AS invalid_email_ratio
FROM users""")
def q_dq_email(spark, sf_dir):
    return quality.email_report(fx(spark, sf_dir).users())


@register("drop_invalid_email", oracle=duckdb_views("users") + f"""
SELECT * FROM users WHERE regexp_matches(email, {EMAIL_SQL})""")
def q_drop_invalid_email(spark, sf_dir):
    return quality.drop_invalid_email(fx(spark, sf_dir).users())


@register("row_count_audit", oracle=duckdb_views("users", "posts", "comments", "likes") + """
SELECT 'users' AS table_name, count(*) AS row_count FROM users
UNION ALL SELECT 'posts', count(*) FROM posts
UNION ALL SELECT 'comments', count(*) FROM comments
UNION ALL SELECT 'likes', count(*) FROM likes""")
def q_row_count_audit(spark, sf_dir):
    f = fx(spark, sf_dir)
    return quality.row_count_audit({"users": f.users(), "posts": f.posts(),
                                    "comments": f.comments(), "likes": f.likes()})


@register("verify_gold", oracle=duckdb_views("users", "posts", "comments", "likes", "posts_kw",
                                             "comments_kw") + """,
days AS (SELECT DISTINCT CAST(created_at AS DATE) AS d FROM (
           SELECT created_at FROM posts UNION ALL SELECT created_at FROM comments
           UNION ALL SELECT created_at FROM likes)),
kw AS (SELECT DISTINCT CAST(created_at AS DATE) AS d, unnest(keywords) AS k FROM posts_kw
       UNION SELECT DISTINCT CAST(created_at AS DATE), unnest(keywords) FROM comments_kw)
SELECT 'gold_daily_platform_summary' AS table_name, count(*) AS row_count,
       CAST(count_if(d IS NULL) AS BIGINT) AS null_key_rows FROM days
UNION ALL SELECT 'gold_post_performance', count(*), CAST(count_if(post_id IS NULL) AS BIGINT)
          FROM posts
UNION ALL SELECT 'gold_user_snapshot', count(*), CAST(count_if(user_id IS NULL) AS BIGINT)
          FROM users
UNION ALL SELECT 'gold_daily_content_trends', count(*),
                 CAST(count_if(d IS NULL OR k IS NULL) AS BIGINT) FROM kw""")
def q_verify_gold(spark, sf_dir):
    f = fx(spark, sf_dir)
    posts, comments, likes, users = f.posts(), f.comments(), f.likes(), f.users()
    return quality.table_checks({
        "gold_daily_platform_summary": (gold.daily_summary(posts, comments, likes),
                                        ["report_date"]),
        "gold_post_performance": (gold.post_performance(posts, users, likes, comments),
                                  ["post_id"]),
        "gold_user_snapshot": (gold.user_snapshot(users, posts, comments, likes, as_of=AS_OF),
                               ["user_id"]),
        "gold_daily_content_trends": (gold.content_trends(f.posts_kw(), f.comments_kw()),
                                      ["report_date", "topic_or_keyword"]),
    })


def _register_preview(table: str, views: tuple[str, ...], body: str, build) -> None:
    """V-1 previews: the chosen columns and first rows of a gold table."""
    from .pipeline import GOLD_PREVIEWS
    columns, order, n = GOLD_PREVIEWS[table]
    chosen = ", ".join(columns or GOLD_DAILY_SUMMARY_COLUMNS)
    sql = (duckdb_views(*views) + f",{body_as(body)}\nSELECT {chosen} FROM g\n"
           f"ORDER BY {', '.join(f'{c} NULLS FIRST' for c in order)} LIMIT {n}")

    @register(f"preview_{table.removeprefix('gold_')}", oracle=sql)
    def query(spark, sf_dir):
        return quality.preview(build(spark, sf_dir), list(columns or GOLD_DAILY_SUMMARY_COLUMNS), list(order), n)


def body_as(body: str) -> str:
    """The CTEs of a gold statement with its last SELECT named ``g``."""
    ctes, _, select = body.rpartition("\nSELECT ")
    return f"{ctes},\ng AS (SELECT {select})"


_register_preview("gold_daily_platform_summary", ("posts", "comments", "likes"),
                  GOLD_DAILY_SUMMARY_BODY, q_gold_daily_summary)
_register_preview("gold_post_performance", ("users", "posts", "likes", "comments"),
                  GOLD_POST_PERFORMANCE_BODY, q_gold_post_performance)
_register_preview("gold_user_snapshot", ("users", "posts", "comments", "likes"),
                  GOLD_USER_SNAPSHOT_BODY, q_gold_user_snapshot)
_register_preview("gold_daily_content_trends", ("posts_kw", "comments_kw"),
                  GOLD_CONTENT_TRENDS_BODY, q_gold_content_trends)


# ---------------------------------------------------------------------------
# Schema shaping (C-1, P-6)
# ---------------------------------------------------------------------------

@register("align_to_schema", oracle=duckdb_views("posts") + """
SELECT post_id, user_id, content, created_at, CAST(NULL AS VARCHAR[]) AS keywords,
       CAST(sentiment AS DOUBLE) AS sentiment FROM posts""")
def q_align_to_schema(spark, sf_dir):
    silver_posts = T.StructType(POSTS.fields + [KEYWORDS_FIELD, SENTIMENT_FIELD])
    return shape.align_to_schema(fx(spark, sf_dir).posts(), silver_posts)


@register("load_align", oracle="""
SELECT event_id + 3000000000 AS like_id, CAST(NULL AS BIGINT) AS post_id, user_id,
       ts AS created_at
FROM events WHERE event_id % 97 <> 0""")
def q_load_align(spark, sf_dir):
    """The rows a relational load inserts: ids past 2^31 that come as text,
    some of them missing."""
    key = F.when(F.col("event_id") % 97 != 0, (F.col("event_id") + 3_000_000_000).cast("string"))
    raw = fx(spark, sf_dir).table("events").select(
        "user_id", "props", key.alias("like_id"), F.col("ts").cast("timestamp").alias("created_at"))
    return jdbc.loadable(raw, LIKES)


# Likes that come as text, some of it bad: what does not load, and why.
_RAW_LIKES_SQL = """
raw AS (SELECT CASE WHEN event_id % 97 = 0 THEN 'x' || event_id WHEN event_id % 89 = 0 THEN NULL
                    ELSE CAST(event_id AS VARCHAR) END AS like_id,
               CAST(event_id * 3 AS VARCHAR) AS post_id,
               CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN event_id % 31 = 0 THEN 'no time' ELSE CAST(ts AS VARCHAR) END AS created_at FROM events)"""


def _raw_likes(f):
    e, text = F.col("event_id"), lambda c: F.col(c).cast("string")
    return f.table("events").select(
        F.when(e % 97 == 0, F.concat(F.lit("x"), text("event_id"))).when(e % 89 != 0, text("event_id")).alias("like_id"),
        (e * 3).cast("string").alias("post_id"),
        F.when(e % 13 == 0, F.lit("n/a")).otherwise(text("user_id")).alias("user_id"),
        F.when(e % 31 == 0, F.lit("no time")).otherwise(text("ts")).alias("created_at"), "props")


@register("load_rejects", oracle="WITH" + _RAW_LIKES_SQL + """
SELECT like_id AS row_key, 'like_id' AS "column", like_id AS value, 'cannot cast to bigint' AS reason
FROM raw WHERE like_id IS NOT NULL AND TRY_CAST(like_id AS BIGINT) IS NULL
UNION ALL SELECT like_id, 'like_id', NULL, 'missing key' FROM raw WHERE like_id IS NULL
UNION ALL SELECT like_id, 'user_id', user_id, 'cannot cast to bigint' FROM raw
          WHERE user_id IS NOT NULL AND TRY_CAST(user_id AS BIGINT) IS NULL
UNION ALL SELECT like_id, 'created_at', created_at, 'cannot cast to timestamp' FROM raw
          WHERE created_at IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) IS NULL""")
def q_load_rejects(spark, sf_dir):
    return shape.align_with_rejects(_raw_likes(fx(spark, sf_dir)), LIKES)[1]


@register("load_accepted", oracle="WITH" + _RAW_LIKES_SQL + """
SELECT CAST(like_id AS BIGINT) AS like_id, CAST(post_id AS BIGINT) AS post_id,
       TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(created_at AS TIMESTAMP) AS created_at
FROM raw WHERE TRY_CAST(like_id AS BIGINT) IS NOT NULL""")
def q_load_accepted(spark, sf_dir):
    return shape.align_with_rejects(_raw_likes(fx(spark, sf_dir)), LIKES)[0]


@register("drop_null_key", oracle=duckdb_views("users") + """
SELECT email, user_id, username FROM users WHERE email IS NOT NULL""")
def q_drop_null_key(spark, sf_dir):
    return shape.drop_null_key(fx(spark, sf_dir).users().select("email", "user_id", "username"))


# ---------------------------------------------------------------------------
# Bronze and silver entity jobs (B-1..B-4, T-1..T-4)
# ---------------------------------------------------------------------------

_WINDOW_SQL = f"created_at BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}'"


@register("bronze_users", oracle=duckdb_views("users") + "\nSELECT * FROM users")
def q_bronze_users(spark, sf_dir):
    return E.bronze(fx(spark, sf_dir).users(), E.ENTITIES["users"], WINDOW_START, WINDOW_END)


@register("bronze_posts", oracle=duckdb_views("posts") + f"\nSELECT * FROM posts WHERE {_WINDOW_SQL}")
def q_bronze_posts(spark, sf_dir):
    return E.bronze(fx(spark, sf_dir).posts(), E.ENTITIES["posts"], WINDOW_START, WINDOW_END)


@register("bronze_comments",
          oracle=duckdb_views("comments") + f"\nSELECT * FROM comments WHERE {_WINDOW_SQL}")
def q_bronze_comments(spark, sf_dir):
    return E.bronze(fx(spark, sf_dir).comments(), E.ENTITIES["comments"], WINDOW_START, WINDOW_END)


@register("bronze_likes", oracle=duckdb_views("likes") + f"\nSELECT * FROM likes WHERE {_WINDOW_SQL}")
def q_bronze_likes(spark, sf_dir):
    return E.bronze(fx(spark, sf_dir).likes(), E.ENTITIES["likes"], WINDOW_START, WINDOW_END)


@register("silver_users", oracle=duckdb_views("users_dup") + ",\nd AS ("
          + _dedup_sql("users_dup", USER_COLUMNS, ["user_id"], []) + f""")
SELECT * FROM d WHERE regexp_matches(email, {EMAIL_SQL})
   OR (SELECT count_if(NOT regexp_matches(email, {EMAIL_SQL})) FROM d) = 0""")
def q_silver_users(spark, sf_dir):
    return E.silver(fx(spark, sf_dir).users_dup(), E.ENTITIES["users"])


@register("silver_posts", oracle=duckdb_views("posts_dup") + "\n"
          + _dedup_sql("posts_dup", POST_COLUMNS, ["post_id"], ["created_at", "post_id"]))
def q_silver_posts(spark, sf_dir):
    return E.silver(fx(spark, sf_dir).posts_dup(), E.ENTITIES["posts"])


@register("silver_comments", oracle=duckdb_views("comments_dup") + "\n"
          + _dedup_sql("comments_dup", COMMENT_COLUMNS, ["comment_id"], ["created_at", "comment_id"]))
def q_silver_comments(spark, sf_dir):
    return E.silver(fx(spark, sf_dir).comments_dup(), E.ENTITIES["comments"])


@register("silver_likes", oracle=duckdb_views("likes") + "\n"
          + _dedup_sql("likes", LIKE_COLUMNS, ["user_id"], ["created_at", "like_id"]))
def q_silver_likes(spark, sf_dir):
    return E.silver(fx(spark, sf_dir).likes(), E.ENTITIES["likes"])


@register("silver_likes_by_id", oracle=duckdb_views("likes_dup") + "\n"
          + _dedup_sql("likes_dup", LIKE_COLUMNS, ["like_id"], ["created_at", "like_id"]))
def q_silver_likes_by_id(spark, sf_dir):
    return E.silver(fx(spark, sf_dir).likes_dup(), E.LIKES_BY_ID)


# ---------------------------------------------------------------------------
# Sources and sinks (S-2, S-3, S-4, S-9)
# ---------------------------------------------------------------------------

@register("src_parquet", oracle="""
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def q_src_parquet(spark, sf_dir):
    events = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
    return pq.read_parquet(spark, f"{sf_dir.rstrip('/')}/events.parquet", events)


@register("src_date_window", oracle=duckdb_views("likes") + f"""
SELECT * FROM likes WHERE created_at >= TIMESTAMP '{WINDOW_START}'
                      AND created_at < TIMESTAMP '{WINDOW_END}' + INTERVAL 1 DAY""")
def q_src_date_window(spark, sf_dir):
    return shape.date_window(fx(spark, sf_dir).likes(), WINDOW_START, WINDOW_END, end_mode="day")


@register("sink_parquet_sized", oracle=duckdb_views("posts") + "\nSELECT * FROM posts")
def q_sink_parquet_sized(spark, sf_dir):
    out = scratch_path(spark, "sink_parquet_sized")
    sinks.write_sized(fx(spark, sf_dir).posts(), out)
    return pq.read_parquet(spark, out)


_CHUNK_O = f"TIMESTAMP '{CHUNK_ORIGIN}'"
_CHUNK_N = f"((epoch_us(created_at) - epoch_us({_CHUNK_O})) // 86400000000 // {CHUNK_DAYS})"
_CHUNK_LABEL = (f"CASE WHEN created_at < {_CHUNK_O} THEN 'initial' "
                f"ELSE 'chunk_' || CAST({_CHUNK_N} AS VARCHAR) END")
_CHUNK_FOLDER = (f"CASE WHEN created_at < {_CHUNK_O} THEN 'initial' ELSE strftime(DATE "
                 f"'{CHUNK_ORIGIN}' + CAST({_CHUNK_N} * {CHUNK_DAYS} AS INTEGER), '%Y-%m-%d') END")


_CHUNK_ROWS_SQL = duckdb_views("posts") + f"\nSELECT *, {_CHUNK_FOLDER} AS chunk_start FROM posts"


@register("sink_chunked", oracle=_CHUNK_ROWS_SQL)
def q_sink_chunked(spark, sf_dir):
    out = scratch_path(spark, "sink_chunked")
    sinks.write_chunked(fx(spark, sf_dir).posts(), out, CHUNK_ORIGIN, CHUNK_DAYS)
    return sinks.read_chunked(spark, out, fx(spark, sf_dir).posts().schema)


# ---------------------------------------------------------------------------
# Time chunks (K-1..K-3)
# ---------------------------------------------------------------------------

@register("chunk_assign", oracle=duckdb_views("posts") + f"""
SELECT post_id, created_at, {_CHUNK_LABEL} AS date_chunk FROM posts""")
def q_chunk_assign(spark, sf_dir):
    posts = fx(spark, sf_dir).posts().select("post_id", "created_at")
    return chunks.assign_chunk(posts, CHUNK_ORIGIN, CHUNK_DAYS)


@register("chunk_summary", oracle=duckdb_views("posts") + f"""
SELECT {_CHUNK_LABEL} AS date_chunk, count(*) AS records,
       min(created_at) AS first_at, max(created_at) AS last_at
FROM posts GROUP BY 1""")
def q_chunk_summary(spark, sf_dir):
    return chunks.chunk_summary(fx(spark, sf_dir).posts(), CHUNK_ORIGIN, CHUNK_DAYS)


@register("chunk_ranges", oracle=duckdb_views("posts") + f""",
c AS (SELECT CASE WHEN created_at < {_CHUNK_O} THEN NULL ELSE {_CHUNK_N} END AS k
      FROM posts WHERE created_at IS NOT NULL)
SELECT CASE WHEN k IS NULL THEN 'initial' ELSE 'chunk_' || CAST(k AS VARCHAR) END AS date_chunk,
       CASE WHEN k IS NOT NULL THEN DATE '{CHUNK_ORIGIN}' + CAST(k * {CHUNK_DAYS} AS INTEGER)
            END AS start_date,
       CASE WHEN k IS NULL THEN DATE '{CHUNK_ORIGIN}' - 1
            ELSE DATE '{CHUNK_ORIGIN}' + CAST(k * {CHUNK_DAYS} + {CHUNK_DAYS} - 1 AS INTEGER)
            END AS end_date,
       count(*) AS records
FROM c GROUP BY k""")
def q_chunk_ranges(spark, sf_dir):
    return chunks.chunk_ranges(fx(spark, sf_dir).posts(), CHUNK_ORIGIN, CHUNK_DAYS)


# ---------------------------------------------------------------------------
# Text (N-1..N-4)
# ---------------------------------------------------------------------------

_CLEAN_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(
    lower(CASE WHEN content IS NULL OR lower(content) = 'nan' THEN '' ELSE content END),
    'https?://\S+', '', 'g'), '[^\p{L}\p{N}\s]+', ' ', 'g'), '\s+', ' ', 'g'))"""


@register("clean_text", oracle=duckdb_views("posts") + f"""
SELECT post_id, {_CLEAN_SQL} AS text_clean FROM posts""")
def q_clean_text(spark, sf_dir):
    posts = fx(spark, sf_dir).posts().select("post_id", "content")
    return nlp.clean_text(posts, "content").select("post_id", "text_clean")


@register("keywords_posts", oracle=duckdb_views("posts") + f"""
SELECT post_id, {duck_keywords('post_id')} AS keywords FROM posts""")
def q_keywords_posts(spark, sf_dir):
    return nlp.tag_keywords(fx(spark, sf_dir).posts().select("post_id"), "post_id")


@register("keywords_comments", oracle=duckdb_views("comments") + f"""
SELECT comment_id, {duck_keywords('comment_id')} AS keywords FROM comments""")
def q_keywords_comments(spark, sf_dir):
    return nlp.tag_keywords(fx(spark, sf_dir).comments().select("comment_id"), "comment_id")


_MODELS: dict[tuple[str, str], object] = {}


def sentiment_weights(spark, sf_dir: str):
    """Fit once per session and scale factor on documents x labels; the table of
    weights is written to the shared folder and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        f = fx(spark, sf_dir)
        path = scratch_path(spark, "sentiment_weights")
        weights = sentiment.fit_weights(nlp.training_set(f.table("documents"), f.table("labels")))
        write_freed(weights, path)
        _MODELS[key] = spark.read.schema(weights.schema).parquet(path)
    return _MODELS[key]


# The model's definition over labelled texts, and the scores of the texts of a
# view ``to_score (key, text_clean)``; ``train (text_clean, class)`` is given.
_WORDS_SQL = "list_filter(string_split(text_clean, ' '), lambda w: w <> '')"
_NB_SQL = f"""
nb_docs AS (SELECT class, {_WORDS_SQL} AS words FROM train),
nb_classes AS (SELECT class, count(*) AS n FROM nb_docs GROUP BY class),
nb_tf AS (SELECT class, feature, count(*) AS tf
          FROM (SELECT class, unnest(words) AS feature FROM nb_docs) GROUP BY class, feature),
nb_df AS (SELECT feature, count(*) AS df
          FROM (SELECT unnest(list_distinct(words)) AS feature FROM nb_docs) GROUP BY feature),
nb_idf AS (SELECT feature, ln(((SELECT count(*) FROM nb_docs) + 1) / (df + 1)) AS idf FROM nb_df),
nb_mass AS (SELECT class, feature, idf, coalesce(tf, 0) * idf AS mass
            FROM nb_idf CROSS JOIN (SELECT class FROM nb_classes) LEFT JOIN nb_tf USING (class, feature)),
nb_weights AS (
    SELECT feature, class, idf * (ln(mass + {sentiment.SMOOTHING}) - ln(sum(mass) OVER (PARTITION BY class)
           + {sentiment.SMOOTHING} * (SELECT count(*) FROM nb_idf))) AS weight FROM nb_mass
    UNION ALL
    SELECT '', class, ln(n + {sentiment.SMOOTHING}) - ln(sum(n) OVER () + {sentiment.SMOOTHING} * count(*) OVER ())
    FROM nb_classes),
nb_scores AS (
    SELECT text_clean, class, sum(weight) AS score
    FROM (SELECT text_clean, unnest(list_append({_WORDS_SQL}, '')) AS feature
          FROM (SELECT DISTINCT text_clean FROM to_score)) JOIN nb_weights USING (feature)
    GROUP BY text_clean, class),
nb_told AS (SELECT text_clean, arg_max(class, score) AS sentiment FROM nb_scores GROUP BY text_clean)"""
_TRAIN_SQL = f"""
train AS (SELECT {_CLEAN_SQL.replace("content", "text")} AS text_clean, CAST(quality AS DOUBLE) AS class
          FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"""


def _scored_sql(view: str, columns: str) -> str:
    """Rows of the fixture view ``view`` with their cleaned text and its score."""
    return duckdb_views(view) + f""",
to_score AS (SELECT * EXCLUDE (sentiment), {_CLEAN_SQL} AS text_clean FROM {view}),{_TRAIN_SQL},{_NB_SQL}
SELECT {columns} FROM to_score JOIN nb_told USING (text_clean)"""


@register("sentiment_weights", oracle=f"WITH{_TRAIN_SQL},{_NB_SQL.split('nb_scores AS')[0].rstrip().rstrip(',')}"
          + "\nSELECT feature, class, round(weight, 6) AS weight FROM nb_weights")
def q_sentiment_weights(spark, sf_dir):
    return sentiment_weights(spark, sf_dir).withColumn("weight", F.round("weight", 6))


@register("sentiment_posts", oracle=_scored_sql("posts_kw", "*"))
def q_sentiment_posts(spark, sf_dir):
    f = fx(spark, sf_dir)
    return nlp.score_sentiment(nlp.clean_text(f.posts_kw(), "content"),
                               sentiment_weights(spark, sf_dir))


@register("sentiment_comments", oracle=_scored_sql("comments_kw", "*"))
def q_sentiment_comments(spark, sf_dir):
    f = fx(spark, sf_dir)
    return nlp.score_sentiment(nlp.clean_text(f.comments_kw(), "content"),
                               sentiment_weights(spark, sf_dir))


@register("silver_scored_posts", oracle=_scored_sql("posts_kw", ", ".join(SILVER_POSTS_COLUMNS)))
def q_silver_scored_posts(spark, sf_dir):
    f = fx(spark, sf_dir)
    posts_kw, comments_kw = nlp.keyword_job(f.posts(), f.comments())
    return nlp.sentiment_job(posts_kw, comments_kw, sentiment_weights(spark, sf_dir))[0]


@register("silver_scored_comments", oracle=_scored_sql("comments_kw", ", ".join(SILVER_COMMENTS_COLUMNS)))
def q_silver_scored_comments(spark, sf_dir):
    f = fx(spark, sf_dir)
    posts_kw, comments_kw = nlp.keyword_job(f.posts(), f.comments())
    return nlp.sentiment_job(posts_kw, comments_kw, sentiment_weights(spark, sf_dir))[1]


_HELD_OUT_SQL = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 250"
_CONFUSION_SQL = "WITH" + _TRAIN_SQL.replace("quality IS NOT NULL", f"quality IS NOT NULL AND NOT ({_HELD_OUT_SQL})") \
    + "," + _TRAIN_SQL.replace("train AS", "to_score AS").replace(
        "quality IS NOT NULL", f"quality IS NOT NULL AND {_HELD_OUT_SQL}") + "," + _NB_SQL + """,
confusion AS (SELECT class AS label, sentiment AS predicted, count(*) AS n
              FROM to_score JOIN nb_told USING (text_clean) GROUP BY class, sentiment)"""


@register("sentiment_confusion", oracle=_CONFUSION_SQL + "\nSELECT * FROM confusion")
def q_sentiment_confusion(spark, sf_dir):
    f = fx(spark, sf_dir)
    return sentiment.evaluate(f.table("documents"), f.table("labels"))


@register("sentiment_eval", oracle=_CONFUSION_SQL + """,
sides AS (SELECT label AS class, n AS support, 0 AS predicted, CASE WHEN label = predicted THEN n ELSE 0 END AS hits
          FROM confusion UNION ALL SELECT predicted, 0, n, 0 FROM confusion),
per AS (SELECT class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted,
               CAST(sum(hits) AS BIGINT) AS hits FROM sides GROUP BY class),
rated AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END AS precision,
                 CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall FROM per)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
       (SELECT sum(CASE WHEN label = predicted THEN n ELSE 0 END) / sum(n) FROM confusion) AS accuracy FROM rated""")
def q_sentiment_eval(spark, sf_dir):
    f = fx(spark, sf_dir)
    return sentiment.class_report(sentiment.evaluate(f.table("documents"), f.table("labels")))


# ---------------------------------------------------------------------------
# Whole pipeline (R-2)
# ---------------------------------------------------------------------------

_FULL_SQL = f"created_at BETWEEN TIMESTAMP '{FULL_START}' AND TIMESTAMP '{FULL_END}'"


# Rows and NULL keys of the four gold tables of a whole run: they follow from
# the window, the silver de-duplication (survivor time = earliest per key),
# the e-mail rule and the hashed keywords, not from the fitted model.
@register("medallion_run", oracle=duckdb_views("users", "posts", "comments", "likes") + ",\nsu AS ("
          + _dedup_sql("users", USER_COLUMNS, ["user_id"], []) + f"""),
u AS (SELECT * FROM su WHERE regexp_matches(email, {EMAIL_SQL})
        OR (SELECT count_if(NOT regexp_matches(email, {EMAIL_SQL})) FROM su) = 0),
p AS (SELECT post_id AS id, min(created_at) AS t FROM posts WHERE {_FULL_SQL} GROUP BY post_id),
c AS (SELECT comment_id AS id, min(created_at) AS t FROM comments WHERE {_FULL_SQL}
      GROUP BY comment_id),
l AS (SELECT like_id AS id, min(created_at) AS t FROM likes WHERE {_FULL_SQL} GROUP BY like_id),
days AS (SELECT DISTINCT CAST(t AS DATE) AS d FROM (
           SELECT t FROM p UNION ALL SELECT t FROM c UNION ALL SELECT t FROM l)),
kw AS (SELECT DISTINCT CAST(t AS DATE) AS d, unnest({duck_keywords('id')}) AS k FROM p
       UNION SELECT DISTINCT CAST(t AS DATE), unnest({duck_keywords('id')}) FROM c)
SELECT 'gold_daily_platform_summary' AS table_name, count(*) AS row_count,
       CAST(count_if(d IS NULL) AS BIGINT) AS null_key_rows FROM days
UNION ALL SELECT 'gold_post_performance', count(*), CAST(count_if(id IS NULL) AS BIGINT) FROM p
UNION ALL SELECT 'gold_user_snapshot', count(*), CAST(count_if(user_id IS NULL) AS BIGINT)
          FROM u
UNION ALL SELECT 'gold_daily_content_trends', count(*),
                 CAST(count_if(d IS NULL OR k IS NULL) AS BIGINT) FROM kw""")
def q_medallion_run(spark, sf_dir):
    return _run_medallion(spark, sf_dir, scratch_path(spark, "medallion_run"))


def _run_medallion(spark, sf_dir, base):
    from .pipeline import run_pipeline
    f = fx(spark, sf_dir)
    sources = {"users": f.users_dup(), "posts": f.posts_dup().drop("sentiment"),
               "comments": f.comments_dup().drop("sentiment"), "likes": f.likes_dup()}
    # the run window spans the whole fixture, so every source row flows through
    return run_pipeline(spark, sources, base, FULL_START, FULL_END, as_of=AS_OF,
                        model=sentiment_weights(spark, sf_dir))


def _medallion_table(spark, sf_dir, table):
    from .pipeline import Layout
    base = scratch_path(spark, "medallion_gold")
    _run_medallion(spark, sf_dir, base)
    return Layout(spark, base, FULL_START, FULL_END).read("gold", table)


# Contents of gold tables as a whole run writes them (the columns that do not
# follow from the fitted model).
@register("medallion_content_trends", oracle=GOLD_CONTENT_TRENDS_SQL)
def q_medallion_content_trends(spark, sf_dir):
    return _medallion_table(spark, sf_dir, "gold_daily_content_trends")


@register("medallion_post_performance", oracle=duckdb_views("users", "posts", "likes", "comments")
          + ",\nsu AS (" + _dedup_sql("users", USER_COLUMNS, ["user_id"], []) + f"""),
valid AS (SELECT * FROM su WHERE regexp_matches(email, {EMAIL_SQL})),"""
          + body_as(GOLD_POST_PERFORMANCE_BODY.replace("FROM users)", "FROM valid)"))
          + "\nSELECT * EXCLUDE (post_sentiment) FROM g")
def q_medallion_post_performance(spark, sf_dir):
    return _medallion_table(spark, sf_dir, "gold_post_performance").drop("post_sentiment")


# ---------------------------------------------------------------------------
# Window after window
# ---------------------------------------------------------------------------

def _two_windows(df, key: str, cut: str = "2024-01-01"):
    """What arrives in the window before ``cut`` and in the one after it: one row in
    ten of the earlier time is late, undated rows come with the second."""
    first = (F.col("created_at") < F.lit(cut).cast("timestamp")) & (F.col(key) % 10 != 0)
    first = F.coalesce(first, F.lit(False))
    return df.where(first), df.where(~first)


def _windows(f, cut: str = "2024-01-12"):
    """Posts, comments and likes of both windows (the posts' first lasts longer)."""
    parts = [_two_windows(f.posts(), "post_id", cut), _two_windows(f.comments(), "comment_id", cut),
             _two_windows(f.likes(), "like_id", cut)]
    return [(f"w{k + 1}", *[p[k] for p in parts]) for k in (0, 1)]


@register("gold_daily_incremental", oracle=GOLD_DAILY_SUMMARY_SQL)
def q_gold_daily_incremental(spark, sf_dir):
    daily = incremental.DailyActivity(spark, scratch_path(spark, "daily_activity"))
    for window, posts, comments, likes in _windows(fx(spark, sf_dir)):
        daily.add(window, posts, comments, likes)
    return daily.summary()


@register("user_snapshot_incremental", oracle=GOLD_USER_SNAPSHOT_SQL)
def q_user_snapshot_incremental(spark, sf_dir):
    f = fx(spark, sf_dir)
    state = incremental.UserState(spark, scratch_path(spark, "user_state"))
    for window, posts, comments, likes in _windows(f):
        state.add(window, posts, comments, likes)
    return state.snapshot(f.users(), as_of=AS_OF)


# Likes arrive in two windows, the repeats an hour later often in the second: the
# survivor is the earliest of those that came with the key's first window.
@register("silver_likes_two_windows", oracle=duckdb_views("likes_dup") + """,
w AS (SELECT *, CASE WHEN created_at < TIMESTAMP '2024-01-12' AND like_id % 10 <> 0 THEN 1 ELSE 2 END AS win FROM likes_dup)
SELECT like_id, post_id, user_id, created_at FROM w
QUALIFY row_number() OVER (PARTITION BY like_id ORDER BY win, created_at NULLS FIRST, post_id, user_id) = 1""")
def q_silver_likes_two_windows(spark, sf_dir):
    likes = fx(spark, sf_dir).likes_dup()
    ledger = incremental.KeyLedger(spark, scratch_path(spark, "like_ledger"), likes.select("like_id").schema)
    parts = [ledger.admit(f"w{k}", rows, ["created_at"])
             for k, rows in enumerate(_two_windows(likes, "like_id", "2024-01-12"), 1)]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# Incremental chunk load (Structured Streaming form of R-1)
# ---------------------------------------------------------------------------

@register("stream_chunk_ingest", oracle=_CHUNK_ROWS_SQL)
def q_stream_chunk_ingest(spark, sf_dir):
    from ..streaming.chunk_ingest import ingest_chunks, parquet_sink, read_loaded
    posts = fx(spark, sf_dir).posts()
    root = scratch_path(spark, "stream_chunk_ingest")
    sinks.write_chunked(posts, f"{root}/chunks", CHUNK_ORIGIN, CHUNK_DAYS)
    ingest_chunks(spark, f"{root}/chunks", posts.schema, parquet_sink(f"{root}/loaded", f"{root}/checkpoint"),
                  f"{root}/checkpoint", drop_chunk_column=False)
    return read_loaded(spark, f"{root}/loaded", T.StructType(
        [*posts.schema.fields, T.StructField(sinks.CHUNK_COLUMN, T.StringType())]))
