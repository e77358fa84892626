"""Window after window without recomputing what stands (U-3, E-2, G-3, G-4, A-3, A-9).

Each run sees one window of new rows, which may hold late ones of earlier days and
rows that came before. Three states make that cheap:

* :class:`KeyLedger`: the keys that earlier windows delivered. A Bloom filter of
  them lets surely new rows pass without a join; the few it doubts meet the exact
  ledger.
* :class:`DailyActivity`: the narrow events by day. A window adds its events and
  recomputes the summaries of the days it touched; files of other days stay.
* :class:`UserState`: additive counts per post and per user and day. A window's
  partial aggregates are merged into a new version, never by reading old events.

States are Parquet below a shared folder. What a window wrote counts from the
moment its record stands in the state's :class:`CommitLog`, written last: a run
that fails before is as if it had not been, one that is repeated after changes
nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import DateLike, as_of_date
from ..session import join_uri
from ..sources.commits import CommitLog, read_or_empty
from . import gold
from .quality import dedup

# ---------------------------------------------------------------------------
# De-duplication across windows
# ---------------------------------------------------------------------------

BLOOM_BITS = 20
BLOOM_HASHES = 4


def bloom_slots(keys: Sequence[str], bits: int, hashes: int = BLOOM_HASHES) -> Column:
    """The filter's slots of a key (NULL is a key): ``h1 + i * h2``."""
    cols = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    h1, h2 = F.xxhash64(*cols), F.xxhash64(F.lit("step"), *cols)
    return F.array(*[F.pmod(F.pmod(h1, F.lit(1 << 40)) + i * F.pmod(h2, F.lit(1 << 20)) + i, F.lit(1 << bits))
                     for i in range(hashes)])


def bloom_filter(keys: DataFrame, bits: int = BLOOM_BITS, hashes: int = BLOOM_HASHES) -> DataFrame:
    """One row, ``words``: the filter of the rows of ``keys`` as 2**bits / 32 words,
    built by a partial aggregate per map task; its size does not grow with the keys."""
    slots = keys.select(F.explode(bloom_slots(keys.columns, bits, hashes)).alias("s"))
    words = slots.groupBy(F.shiftright("s", 5).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("m"))
    every = keys.sparkSession.range(1 << max(bits - 5, 0)).join(words, F.col("id") == F.col("w"), "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("m", F.lit(0)).alias("m")))),
                                 lambda x: x["m"]).alias("words"))


def may_contain(words: Column, keys: Sequence[str], bits: int = BLOOM_BITS, hashes: int = BLOOM_HASHES) -> Column:
    """Whether a row's key may be in the filter: always so for a key that is."""
    slots = bloom_slots(keys, bits, hashes)
    tests = [F.get(words, F.shiftright(F.get(slots, F.lit(i)), 5).cast("int")).bitwiseAND(
        F.expr("1L") * F.pow(F.lit(2), F.pmod(F.get(slots, F.lit(i)), F.lit(32))).cast("long")) != 0 for i in range(hashes)]
    return reduce(lambda a, b: a & b, tests)


def unseen(rows: DataFrame, seen: DataFrame, keys: Sequence[str], bits: int = BLOOM_BITS) -> DataFrame:
    """The ``rows`` whose key is not among the rows of ``seen`` (its columns ``keys``).

    Most new rows are surely new by the filter and go on as they are, with no
    shuffle of their texts; only those in doubt are compared with the keys.
    """
    doubt = F.coalesce(may_contain(bloom_filter(seen.select(*keys), bits).scalar(), keys, bits), F.lit(True))
    known = seen.select(*[F.col(k).alias(f"__seen_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__seen_{k}")) for k in keys])
    return rows.where(~doubt).unionByName(rows.where(doubt).join(known, same, "left_anti"))


class KeyLedger:
    """First come, first kept, over windows: what :func:`dedup` is within one."""

    def __init__(self, spark: SparkSession, uri: str, schema: T.StructType):
        self.spark, self.uri = spark, uri
        self.schema = schema
        self.log = CommitLog(spark, join_uri(uri, "commits"))

    def keys(self) -> DataFrame:
        """The keys of all committed windows."""
        return self.log.read(self.schema)

    def admit(self, window: str, rows: DataFrame, order_by: Sequence[str], bits: int = BLOOM_BITS) -> DataFrame:
        """The rows of ``window`` that are the first of their key, one for each; they
        are written, then the window is committed. A committed window's rows are read."""
        done = {c["window"]: c for c in self.log.rows()}
        data = join_uri(self.uri, "rows", f"window={window}")
        if window not in done:
            names = self.schema.fieldNames()
            first = dedup(unseen(rows, self.keys(), names, bits), names, order_by)
            first.write.mode("overwrite").parquet(data)
            kept = self.spark.read.schema(rows.schema).parquet(data)
            folder = join_uri(self.uri, "keys", f"window={window}")
            kept.select(*names).write.mode("overwrite").parquet(folder)
            self.log.add(window, len(done) + 1, folder)
        return self.spark.read.schema(rows.schema).parquet(data)


# ---------------------------------------------------------------------------
# Daily summary
# ---------------------------------------------------------------------------

class DailyActivity:
    """Events by day and the summary of each day."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark = spark
        self.events_uri, self.summary_uri = join_uri(uri, "events"), join_uri(uri, "summary")

    def _write(self, df: DataFrame, uri: str, by: list[str]) -> None:
        # only the partitions that ``df`` has rows of are replaced
        (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(uri))

    def add(self, window: str, posts: DataFrame, comments: DataFrame, likes: DataFrame) -> list:
        """Adds a window's events and recomputes the days they fall on; these are
        returned. Repeated, it replaces what it wrote."""
        feed = gold.activity_feed(posts, comments, likes).withColumn("window", F.lit(window))
        self._write(feed, self.events_uri, ["report_date", "window"])
        schema = feed.schema
        mine = self.spark.read.schema(schema).parquet(self.events_uri).where(F.col("window") == window)
        # as many as the calendar has days; they prune the partitions that are read
        days = [r[0] for r in mine.select("report_date").distinct().collect()]
        events = self.spark.read.schema(schema).parquet(self.events_uri)
        dated = [d for d in days if d is not None]
        touched = F.col("report_date").isin(dated) if dated else F.lit(False)
        if None in days:
            touched = touched | F.col("report_date").isNull()
        if days:
            self._write(gold.summary_of_feed(events.where(touched).drop("window")), self.summary_uri, ["report_date"])
        return days

    def summary(self) -> DataFrame:
        """The summaries of all days, as :func:`strata.operators.gold.daily_summary`
        would give them over all windows."""
        schema = gold.daily_summary_schema(self.spark)
        return read_or_empty(self.spark, self.summary_uri, schema).select(*schema.fieldNames())


# ---------------------------------------------------------------------------
# User snapshot
# ---------------------------------------------------------------------------

POST_STATE = T.StructType([
    T.StructField("post_id", T.LongType()), T.StructField("comments", T.LongType()),
    T.StructField("positive_comments", T.LongType()), T.StructField("likes", T.LongType())])
AUTHOR_STATE = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("post_id", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("posts", T.LongType()), T.StructField("positive_posts", T.LongType()),
    T.StructField("last", T.TimestampType())])
GIVEN_STATE = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("comments", T.LongType()), T.StructField("likes", T.LongType()),
    T.StructField("last", T.TimestampType())])
STATES = {"received": POST_STATE, "authored": AUTHOR_STATE, "given": GIVEN_STATE}


class UserState:
    """Counts from which the snapshot of every user follows, merged window by window.

    ``received`` holds a post's comments and likes, ``authored`` a user's rows of a
    post by day, ``given`` a user's comments and likes by day, each with the latest
    time where it matters. All are sums and maxima, so a window's part is merged by
    one aggregate over the old state and the part, both hash partitioned on their key.
    """

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri
        self.log = CommitLog(spark, join_uri(uri, "commits"))

    def tables(self) -> dict[str, DataFrame]:
        """The state as of the last committed window."""
        done = self.log.rows()
        if not done:
            return {name: self.spark.createDataFrame([], schema) for name, schema in STATES.items()}
        return {name: self.spark.read.schema(schema).parquet(join_uri(done[-1]["folder"], name))
                for name, schema in STATES.items()}

    @staticmethod
    def part(posts: DataFrame, comments: DataFrame, likes: DataFrame) -> dict[str, DataFrame]:
        """A window's partial aggregates."""
        zero = F.lit(0).cast("long")
        day = F.to_date("created_at").alias("day")
        on_posts = comments.select("post_id", F.lit(1).cast("long").alias("comments"),
                                   F.coalesce((F.col("sentiment") == gold.POSITIVE).cast("long"), zero)
                                   .alias("positive_comments"), zero.alias("likes")).unionByName(
            likes.select("post_id", zero.alias("comments"), zero.alias("positive_comments"),
                         F.lit(1).cast("long").alias("likes")))
        given = comments.select("user_id", day, F.lit(1).cast("long").alias("comments"), zero.alias("likes"),
                                F.col("created_at").alias("last")).unionByName(
            likes.select("user_id", day, zero.alias("comments"), F.lit(1).cast("long").alias("likes"),
                         F.col("created_at").alias("last")))
        authored = posts.select("user_id", "post_id", day, F.lit(1).cast("long").alias("posts"),
                                F.coalesce((F.col("sentiment") == gold.POSITIVE).cast("long"), zero)
                                .alias("positive_posts"), F.col("created_at").alias("last"))
        return {"received": UserState._sum("received", on_posts), "authored": UserState._sum("authored", authored),
                "given": UserState._sum("given", given)}

    @staticmethod
    def _sum(name: str, rows: DataFrame) -> DataFrame:
        keys = {"received": ["post_id"], "authored": ["user_id", "post_id", "day"], "given": ["user_id", "day"]}[name]
        values = [f.name for f in STATES[name].fields if f.name not in keys]
        return rows.groupBy(*keys).agg(*[(F.max(v) if v == "last" else F.sum(v)).alias(v) for v in values]).select(
            *[F.col(f.name).cast(f.dataType) for f in STATES[name].fields])

    def add(self, window: str, posts: DataFrame, comments: DataFrame, likes: DataFrame) -> bool:
        """Merges a window into a new version; False if it is in already."""
        done = self.log.rows()
        if window in {c["window"] for c in done}:
            return False
        version, old = len(done) + 1, self.tables()
        folder = join_uri(self.uri, f"version={version}")
        for name, part in self.part(posts, comments, likes).items():
            merged = self._sum(name, old[name].unionByName(part))
            merged.write.mode("overwrite").parquet(join_uri(folder, name))
        self.log.add(window, version, folder)
        return True

    def snapshot(self, users: DataFrame, as_of: DateLike = None, drop_columns: tuple[str, ...] = ("password_hash",)
                 ) -> DataFrame:
        """What :func:`strata.operators.gold.user_snapshot` gives over all windows."""
        state, recent = self.tables(), F.col("day") >= F.date_sub(as_of_date(as_of), 30)
        received = state["received"].select(
            "post_id", F.when(F.col("comments") > 0, F.col("comments")).alias("c"),
            F.when(F.col("likes") > 0, F.col("likes")).alias("l"),
            F.when(F.col("comments") > 0, F.col("positive_comments") / F.col("comments")).alias("ratio"))
        rows = state["authored"].join(received, "post_id", "left")
        n = F.col("posts")
        over = lambda total, col: F.sum(total) / F.sum(F.when(F.col(col).isNotNull(), n))
        by_posts = rows.groupBy("user_id").agg(
            F.sum("posts").alias("total_posts_per_user"),
            (F.sum("positive_posts") / F.sum("posts")).alias("positive_post_ratio"),
            F.sum(F.when(recent, n).otherwise(0)).alias("posts_in_last_30_days"),
            F.sum(n * F.col("c")).alias("total_comments_received"), F.sum(n * F.col("l")).alias("total_likes_received"),
            over(n * F.col("l"), "l").alias("avg_likes_per_post"),
            over(n * F.col("c"), "c").alias("avg_comments_per_post"),
            over(n * F.col("ratio"), "ratio").alias("positive_comment_received_ratio"),
            F.coalesce(F.sum(F.when(F.col("c").isNotNull(), n)), F.lit(0)).alias("total_feedback_count"),
            F.max("last").alias("_last_post"))
        by_given = state["given"].groupBy("user_id").agg(
            F.sum("comments").alias("total_comments_given"),
            F.sum(F.when(recent, F.col("comments")).otherwise(0)).alias("comments_in_last_30_days"),
            F.sum("likes").alias("total_likes_given"), F.max("last").alias("_last_given"))
        return gold.snapshot_of(users, [by_posts, by_given], ["_last_post", "_last_given"], as_of, drop_columns)
