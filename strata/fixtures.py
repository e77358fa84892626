"""Social tables derived from the driver's test tables.

The test data has no users / posts / comments / likes, so the query registry
derives them from ``customer``, ``documents``, ``labels``, ``events`` and
``conversations`` (the mapping in FIXTURES.md). Every derived table is a lazy
DataFrame over the parquet files, so its size grows with the scale factor.

:func:`duckdb_views` returns the same definitions as DuckDB CTEs for the
oracle SQL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import KEYWORD_GROUPS, keyword_group_col

# Fixed values of the fixture mapping.
AS_OF = _dt.date(2024, 2, 1)
POST_EPOCH_START = 1696377600      # 2023-10-04 00:00:00 UTC
POST_TIME_STRIDE = 104729
POST_TIME_SPAN = 10368000          # 120 days in seconds
WINDOW_START = "2024-01-01"
WINDOW_END = "2024-01-15"
# A run window that holds the whole fixture: posts lie in the 120 days from
# 2023-10-04, events in January 2024.
FULL_START = "2023-10-01"
FULL_END = "2024-03-01"
CHUNK_ORIGIN = "2024-01-08"
CHUNK_DAYS = 7



class Fixture:
    """Lazy social tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}  # a file's footer is read once

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- bronze-shaped tables -------------------------------------------------
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        email = (F.when(key % 17 == 0, F.lit(None).cast("string"))
                 .when(key % 10 == 3, F.concat(F.lit("bad-"), key.cast("string")))
                 .otherwise(F.concat(F.lit("u"), key.cast("string"), F.lit("@example.com"))))
        registered = (F.when(key % 23 == 0, F.lit(None).cast("date"))
                      .otherwise(F.date_sub(F.lit(AS_OF), (key % 200).cast("int"))))
        return self.table("customer").select(
            key.cast("long").alias("user_id"),
            F.col("c_name").alias("username"),
            email.alias("email"),
            F.md5(F.col("c_name")).alias("password_hash"),
            F.col("c_mktsegment").alias("full_name"),
            registered.alias("registration_date"),
        )

    def posts(self) -> DataFrame:
        """Posts with the labelled quality as sentiment (NULL when unlabelled)."""
        n_groups = self.table("customer").select(F.expr("count(1) div 5")).scalar()
        docs = self.table("documents").select("doc_id", "text")
        labels = self.table("labels").select("doc_id", "quality")
        created = F.timestamp_seconds(
            F.lit(POST_EPOCH_START) + (F.col("doc_id") * POST_TIME_STRIDE) % POST_TIME_SPAN)
        return docs.join(labels, "doc_id", "left").select(
            F.col("doc_id").cast("long").alias("post_id"),
            (F.col("doc_id") % n_groups).cast("long").alias("user_id"),
            F.col("text").alias("content"),
            created.alias("created_at"),
            F.col("quality").alias("sentiment"),
        )

    def _post_modulus(self, num: int, den: int):
        return self.table("documents").select(F.expr(f"count(1) * {num} div {den}")).scalar()

    def likes(self) -> DataFrame:
        likeable = self._post_modulus(4, 5)
        return (self.table("events")
                .where(F.col("event_type").isin("click", "view"))
                .select(F.col("event_id").cast("long").alias("like_id"),
                        (F.col("event_id") % likeable).cast("long").alias("post_id"),
                        F.col("user_id").cast("long").alias("user_id"),
                        F.col("ts").cast("timestamp").alias("created_at")))

    def comments(self) -> DataFrame:
        """Every turn of every conversation is the text of some comments: an
        event's conversation and turn follow from its id."""
        commentable = self._post_modulus(3, 5)
        events = self.table("events").where(F.col("event_type").isin("purchase", "signup"))
        # one row per conversation, its texts by turn
        turns = self.table("conversations").groupBy("conv_id").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]).alias("texts"))
        n_conversations = self.table("conversations").select(F.countDistinct("conv_id")).scalar()
        event_id = F.col("event_id")
        events = events.withColumn("conv_id", event_id % n_conversations)
        turn = F.floor(event_id / n_conversations) % F.size("texts")
        # merged, for a conversation's texts unfold to many times what a plan expects of their files: none is broadcast
        return events.join(turns.hint("merge"), "conv_id", "left").select(
            event_id.cast("long").alias("comment_id"),
            (event_id % commentable).cast("long").alias("post_id"),
            F.col("user_id").cast("long").alias("user_id"),
            F.get("texts", turn.cast("int")).alias("content"),
            F.col("ts").cast("timestamp").alias("created_at"),
            (event_id % 2).cast("int").alias("sentiment"),
        )

    def _repeated(self, df: DataFrame, key: str) -> DataFrame:
        """Rows plus one in 25 repeated an hour later (real duplicate keys); the rows
        are made once, not once more for those repeated."""
        created = F.col("created_at")
        times = F.when(F.col(key) % 25 == 0, F.array(created, created + F.expr("INTERVAL 1 HOUR"))).otherwise(
            F.array(created))
        return df.withColumn("created_at", F.explode(times))

    def users_dup(self) -> DataFrame:
        """Users plus one in 25 repeated under another name."""
        users = self.users()
        return users.unionByName(users.where(F.col("user_id") % 25 == 0)
                                 .withColumn("username", F.concat(F.lit("again "), F.col("username"))))

    def posts_dup(self) -> DataFrame:
        return self._repeated(self.posts(), "post_id")

    def comments_dup(self) -> DataFrame:
        return self._repeated(self.comments(), "comment_id")

    def likes_dup(self) -> DataFrame:
        return self._repeated(self.likes(), "like_id")

    def posts_kw(self) -> DataFrame:
        return self.posts().withColumn("keywords", keyword_group_col("post_id"))

    def comments_kw(self) -> DataFrame:
        return self.comments().withColumn("keywords", keyword_group_col("comment_id"))


# ---------------------------------------------------------------------------
# DuckDB text of the same views, for oracle SQL.
# ---------------------------------------------------------------------------

def _duck_keyword_array() -> str:
    groups = ", ".join("[" + ", ".join(f"'{w}'" for w in g) + "]" for g in KEYWORD_GROUPS)
    return f"[{groups}]"


def duck_keywords(key: str) -> str:
    n = len(KEYWORD_GROUPS)
    return (f"({_duck_keyword_array()})[CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)"
            f" AS BIGINT) % {n} AS INT) + 1]")


_DUCK_VIEWS = {
    "users": f"""users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS username,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              WHEN c_custkey % 10 = 3 THEN concat('bad-', c_custkey)
              ELSE concat('u', c_custkey, '@example.com') END AS email,
         md5(c_name) AS password_hash, c_mktsegment AS full_name,
         CASE WHEN c_custkey % 23 = 0 THEN NULL
              ELSE DATE '{AS_OF}' - CAST(c_custkey % 200 AS INT) END AS registration_date
  FROM customer)""",
    "posts": f"""posts AS (
  SELECT CAST(d.doc_id AS BIGINT) AS post_id,
         CAST(d.doc_id % (SELECT count(*) // 5 FROM customer) AS BIGINT) AS user_id,
         d.text AS content,
         TIMESTAMP '1970-01-01' + to_seconds({POST_EPOCH_START} + (d.doc_id * {POST_TIME_STRIDE}) % {POST_TIME_SPAN}) AS created_at,
         l.quality AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "likes": """likes AS (
  SELECT CAST(event_id AS BIGINT) AS like_id,
         CAST(event_id % (SELECT count(*) * 4 // 5 FROM documents) AS BIGINT) AS post_id,
         CAST(user_id AS BIGINT) AS user_id, ts AS created_at
  FROM events WHERE event_type IN ('click', 'view'))""",
    "comments": """conversation_texts AS (
  SELECT conv_id, list(text ORDER BY turn, text) AS texts FROM conversations GROUP BY conv_id),
comments AS (
  SELECT CAST(e.event_id AS BIGINT) AS comment_id,
         CAST(e.event_id % (SELECT count(*) * 3 // 5 FROM documents) AS BIGINT) AS post_id,
         CAST(e.user_id AS BIGINT) AS user_id,
         c.texts[(e.event_id // (SELECT count(*) FROM conversation_texts)) % len(c.texts) + 1] AS content,
         e.ts AS created_at, CAST(e.event_id % 2 AS INT) AS sentiment
  FROM events e LEFT JOIN conversation_texts c
    ON c.conv_id = e.event_id % (SELECT count(*) FROM conversation_texts)
  WHERE e.event_type IN ('purchase', 'signup'))""",
    "users_dup": """users_dup AS (
  SELECT * FROM users
  UNION ALL
  SELECT user_id, 'again ' || username AS username, email, password_hash, full_name,
         registration_date FROM users WHERE user_id % 25 = 0)""",
    "comments_dup": """comments_dup AS (
  SELECT * FROM comments
  UNION ALL
  SELECT comment_id, post_id, user_id, content, created_at + INTERVAL 1 HOUR AS created_at, sentiment
  FROM comments WHERE comment_id % 25 = 0)""",
    "likes_dup": """likes_dup AS (
  SELECT * FROM likes
  UNION ALL
  SELECT like_id, post_id, user_id, created_at + INTERVAL 1 HOUR AS created_at
  FROM likes WHERE like_id % 25 = 0)""",
    "posts_dup": """posts_dup AS (
  SELECT * FROM posts
  UNION ALL
  SELECT post_id, user_id, content, created_at + INTERVAL 1 HOUR AS created_at, sentiment
  FROM posts WHERE post_id % 25 = 0)""",
    "posts_kw": f"""posts_kw AS (
  SELECT p.*, {duck_keywords('post_id')} AS keywords FROM posts p)""",
    "comments_kw": f"""comments_kw AS (
  SELECT c.*, {duck_keywords('comment_id')} AS keywords FROM comments c)""",
}

_DUCK_DEPENDS = {
    "users_dup": ["users"],
    "comments_dup": ["comments"],
    "likes_dup": ["likes"],
    "posts_dup": ["posts"],
    "posts_kw": ["posts"],
    "comments_kw": ["comments"],
}


def duckdb_views(*names: str) -> str:
    """``WITH`` clause defining the named fixture views (and what they need)."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in _DUCK_DEPENDS.get(name, []):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(_DUCK_VIEWS[n] for n in ordered)
