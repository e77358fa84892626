"""Scale and skew experiment on tables derived from the given test data.

Usage: python tools/scale_experiment.py OUT_DIR [SF_DIR] [FACTOR]

Builds users / posts / comments / likes from SF_DIR (default sf0.1) with the
fixture mapping, amplifies them FACTOR times (rows copied with
``explode(sequence(...))`` and given new ids; default 300) and skews them:
a third of all likes and comments go to one post, a third of the posts to
one user, a third of all events to one day. Then it times the four gold
reports (``noop`` sink, best of 2) and checks each against its DuckDB oracle
statement over the same Parquet files. Prints one JSON line.

Post text is kept whole, so posts are amplified by FACTOR // 10 only.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import Column, DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.fixtures import AS_OF, Fixture  # noqa: E402
from strata.operators import gold  # noqa: E402
from strata.plans import catalog  # noqa: E402
from strata.session import build_session  # noqa: E402

HOT_DAY = "2024-01-20"


def _amplify(df: DataFrame, factor: int, id_cols: list[str], stride: int) -> DataFrame:
    """``factor`` copies of every row; copy ``k`` shifts each id by ``k * stride``."""
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    for c in id_cols:
        out = out.withColumn(c, (F.col(c) + F.col("_copy") * F.lit(stride)).cast("long"))
    return out


def _hot(col: str, every: Column, value) -> Column:
    return F.when(every, F.lit(value)).otherwise(F.col(col))


def _hot_time(every: Column) -> Column:
    shifted = F.lit(f"{HOT_DAY} 00:00:00").cast("timestamp") + F.make_interval(
        secs=F.unix_timestamp("created_at") % 86400)
    return F.when(every, shifted).otherwise(F.col("created_at"))


def build(spark, sf_dir: str, out: str, factor: int) -> dict[str, int]:
    fx = Fixture(spark, sf_dir)
    n_users = fx.table("customer").count()
    n_posts = fx.table("documents").count()
    n_events = fx.table("events").agg(F.max("event_id")).first()[0] + 1
    post_factor = max(1, factor // 10)
    copies = F.col("_copy")
    users = _amplify(fx.users(), factor // 10 or 1, ["user_id"], n_users)
    posts = _amplify(fx.posts(), post_factor, ["post_id"], n_posts)
    posts = (posts.withColumn("user_id", _hot("user_id", F.col("post_id") % 3 == 0, 0))
             .withColumn("created_at", _hot_time(F.col("post_id") % 3 == 1))
             .withColumn("keywords", F.element_at(
                 F.array(F.array(F.lit("ai"), F.lit("data")), F.array(F.lit("sports"))),
                 (F.col("post_id") % 2 + 1).cast("int"))))
    total_posts = n_posts * post_factor

    def events(df: DataFrame, id_col: str) -> DataFrame:
        amp = _amplify(df, factor, [id_col], n_events)
        return (amp.withColumn("post_id", _hot("post_id", F.col(id_col) % 3 == 0, 0))
                .withColumn("post_id", (F.col("post_id") + (copies % post_factor) * n_posts)
                            .cast("int"))
                .withColumn("user_id", (F.col("user_id") + (copies % (factor // 10 or 1))
                                        * n_users).cast("int"))
                .withColumn("created_at", _hot_time(F.col(id_col) % 3 == 1)))

    likes = events(fx.likes(), "like_id")
    comments = events(fx.comments(), "comment_id").withColumn(
        "keywords", F.array(F.lit("ai"), F.lit("travel")))
    sizes = {}
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df in {"users": users, "posts": posts, "likes": likes, "comments": comments}.items():
        # the source tables are single row groups; write several files so
        # that scans of the derived tables run in parallel
        key = {"users": "user_id", "posts": "post_id", "likes": "like_id",
               "comments": "comment_id"}[name]
        (df.drop("_copy").repartition(files, key)
         .write.mode("overwrite").parquet(f"{out}/{name}"))
        sizes[name] = spark.read.parquet(f"{out}/{name}").count()
    sizes["posts_max_id"] = total_posts
    return sizes


REPORTS = {
    "gold_daily_summary": (lambda t: gold.daily_summary(t["posts"], t["comments"], t["likes"]),
                           catalog.GOLD_DAILY_SUMMARY_BODY),
    "gold_post_performance": (lambda t: gold.post_performance(t["posts"], t["users"], t["likes"],
                                                              t["comments"]),
                              catalog.GOLD_POST_PERFORMANCE_BODY),
    "gold_user_snapshot": (lambda t: gold.user_snapshot(t["users"], t["posts"], t["comments"],
                                                        t["likes"], as_of=AS_OF),
                           catalog.GOLD_USER_SNAPSHOT_BODY),
    "gold_content_trends": (lambda t: gold.content_trends(t["posts"], t["comments"]),
                            catalog.GOLD_CONTENT_TRENDS_BODY),
}


def check(spark, out: str, name: str, df: DataFrame, body: str) -> bool:
    """Spark result equals DuckDB's (doubles to 9 significant digits)."""
    path = f"{out}/_result_{name}"
    df.write.mode("overwrite").parquet(path)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("users", "posts", "likes", "comments"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}/*.parquet')")
    con.execute("CREATE VIEW posts_kw AS SELECT * FROM posts")
    con.execute("CREATE VIEW comments_kw AS SELECT * FROM comments")
    con.execute(f"CREATE TABLE want AS WITH {body}")
    con.execute(f"CREATE TABLE got AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cols = [r[0] for r in con.execute("DESCRIBE want").fetchall()]
    kinds = dict(con.execute("DESCRIBE want").fetchall()[i][:2] for i in range(len(cols)))

    def norm(c: str) -> str:
        return f"round({c}, 9)" if kinds[c] in ("DOUBLE", "FLOAT") else c

    sel = ", ".join(norm(c) for c in cols)
    diff = con.execute(f"SELECT count(*) FROM ((SELECT {sel} FROM want EXCEPT ALL "
                       f"SELECT {sel} FROM got) UNION ALL (SELECT {sel} FROM got EXCEPT ALL "
                       f"SELECT {sel} FROM want))").fetchone()[0]
    return diff == 0


def main() -> None:
    out = sys.argv[1].rstrip("/")
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    factor = int(sys.argv[3]) if len(sys.argv) > 3 else 300
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "64",
                                            "spark.driver.memory": "16g"})
    t0 = time.perf_counter()
    sizes = build(spark, sf_dir, out, factor)
    gen = time.perf_counter() - t0
    tables = {t: spark.read.parquet(f"{out}/{t}") for t in ("users", "posts", "likes", "comments")}
    timings, equal = {}, {}
    for name, (make, body) in REPORTS.items():
        runs = []
        for _ in range(2):
            t1 = time.perf_counter()
            make(tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t1)
        timings[name] = round(min(runs), 2)
        equal[name] = check(spark, out, name, make(tables), body)
    print(json.dumps({"rows": sizes, "generate_sec": round(gen, 1), "sec": timings,
                      "equal_to_oracle": equal}))


if __name__ == "__main__":
    main()
