"""Declared schemas for the bronze, silver and gold layers.

Reading with a declared schema skips footer inference and pins the types the
operators rely on (ids LONG, event times TIMESTAMP, scores DOUBLE).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The source tables' columns, in order. Ids are LONG: event ids of
# a large deployment pass 2^31.
USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("password_hash", T.StringType()),
    T.StructField("full_name", T.StringType()),
    # not in the source DDL; the user snapshot needs it
    T.StructField("registration_date", T.DateType()),
])

POSTS = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

COMMENTS = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

LIKES = T.StructType([
    T.StructField("like_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
])

BRONZE = {"users": USERS, "posts": POSTS, "comments": COMMENTS, "likes": LIKES}

# Silver tables after the NLP steps carry two more columns.
KEYWORDS_FIELD = T.StructField("keywords", T.ArrayType(T.StringType()))
SENTIMENT_FIELD = T.StructField("sentiment", T.DoubleType())

SILVER_POSTS_COLUMNS = ["post_id", "user_id", "content", "created_at", "keywords", "sentiment"]
SILVER_COMMENTS_COLUMNS = ["post_id", "comment_id", "user_id", "content", "created_at",
                           "keywords", "sentiment"]

# Column names of the reports, in order.
GOLD_DAILY_SUMMARY_COLUMNS = [
    "report_date",
    "total_posts", "active_posters", "positive_posts_count", "negative_posts_count",
    "total_comments", "active_commenters", "positive_comments_count", "negative_comments_count",
    "total_likes", "active_likers",
    "avg_comments_per_post", "avg_likes_per_post",
    "total_active_users",
]

GOLD_POST_PERFORMANCE_COLUMNS = [
    "post_id", "created_date", "post_content", "post_sentiment", "user_id", "username",
    "total_likes", "total_comments", "time_to_first_like_minutes", "time_to_first_comment_minutes",
]

GOLD_CONTENT_TRENDS_COLUMNS = [
    "report_date", "topic_or_keyword", "mention_count_in_posts", "mention_count_in_comments",
    "total_mentions", "avg_sentiment_when_mentioned", "trending_rank",
]
