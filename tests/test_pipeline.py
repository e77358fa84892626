"""End-to-end pipeline on the smallest fixture."""

import datetime as dt
import glob
import time

import pyarrow.parquet as papq

from strata.fixtures import AS_OF, Fixture
from strata.operators import nlp
from strata.plans.pipeline import (GOLD_TABLES, Layout, bronze_job, gold_previews, run_pipeline,
                                   silver_job, verify_bronze, verify_silver)
from strata.sources.parquet import layer_path

from conftest import SF_SMALL


def test_pipeline_end_to_end(spark, tmp_path):
    f = Fixture(spark, SF_SMALL)
    base = str(tmp_path / "lake")
    sources = {"users": f.users(), "posts": f.posts().drop("sentiment"),
               "comments": f.comments().drop("sentiment"), "likes": f.likes()}
    checks = run_pipeline(spark, sources, base, "2024-01-01", "2024-01-31", as_of=AS_OF,
                          training=(f.table("documents"), f.table("labels")))
    rows = {r.table_name: (r.row_count, r.null_key_rows) for r in checks.collect()}
    assert set(rows) == set(GOLD_TABLES)
    assert all(n > 0 and nulls == 0 for n, nulls in rows.values())
    # each layer is its own dataset; scored posts carry the silver columns
    scored = spark.read.parquet(layer_path(base, "silver", "2024-01-01", "2024-01-31",
                                           "posts_scored"))
    assert scored.columns == ["post_id", "user_id", "content", "created_at", "keywords",
                              "sentiment"]
    users = spark.read.parquet(layer_path(base, "silver", "2024-01-01", "2024-01-31", "users"))
    bronze_users = spark.read.parquet(layer_path(base, "bronze", "2024-01-01", "2024-01-31",
                                                 "users"))
    assert users.count() < bronze_users.count()  # invalid e-mails dropped
    report = spark.read.parquet(layer_path(base, "reports", "2024-01-01", "2024-01-31",
                                           "users_email"))
    assert report.first().invalid_email_count > 0
    assert nlp.TEXT_CLEAN in spark.read.parquet(
        layer_path(base, "silver", "2024-01-01", "2024-01-31", "posts_keywords")).columns
    lay = Layout(spark, base, "2024-01-01", "2024-01-31")
    previews = gold_previews(lay)
    assert [r.trending_rank for r in previews["gold_daily_content_trends"].collect()][:3] == [1, 2, 3]
    assert previews["gold_user_snapshot"].count() == 5
    bronze = {r.table_name: r.row_count for r in verify_bronze(lay).collect()}
    silver = {r.table_name: (r.row_count, r.null_key_rows) for r in verify_silver(lay).collect()}
    assert silver["users"][0] < bronze["users"]
    assert silver["likes"][0] == likes_window_rows(f) and all(v[1] == 0 for v in silver.values())


def likes_window_rows(f):
    from pyspark.sql import functions as F
    likes = f.likes()
    return likes.where((F.col("created_at") >= "2024-01-01")
                       & (F.col("created_at") <= "2024-01-31")).count()


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_a_step_leaves_no_shuffle_files_and_compressed_layers(spark, tmp_path):
    rows = [(i % 400, i % 7, f"text {i} " * 20, dt.datetime(2024, 1, 1 + i % 20)) for i in range(500)]
    posts = spark.createDataFrame(rows, "post_id long, user_id long, content string, created_at timestamp")
    lay = Layout(spark, str(tmp_path / "lake"), "2024-01-01", "2024-01-31")
    before = shuffle_files(spark)
    bronze_job(lay, "posts", posts)
    silver_job(lay, "posts")
    until = time.time() + 20  # they are removed beside the next job
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert lay.read("silver", "posts").count() == 400
    for layer in ("bronze", "silver"):
        files = glob.glob(f"{lay.path(layer, 'posts')}/*.parquet")
        assert files and {papq.ParquetFile(f).metadata.row_group(0).column(2).compression for f in files} == {"ZSTD"}


def test_cli_steps(spark, tmp_path, capsys):
    from strata.__main__ import main
    f = Fixture(spark, SF_SMALL)
    src = tmp_path / "src"
    f.users().write.parquet(str(src / "users"))
    f.likes().write.parquet(str(src / "likes"))
    common = ["--base", str(tmp_path / "lake"), "--start", "2024-01-01", "--end", "2024-01-15"]
    main(["bronze", "--source-dir", str(src), "--table", "users", "--table", "likes"] + common)
    main(["silver", "--table", "users", "--table", "likes"] + common)
    lay = Layout(spark, str(tmp_path / "lake"), "2024-01-01", "2024-01-15")
    bronze_likes = lay.read("bronze", "likes")
    assert bronze_likes.count() < f.likes().count()
    # reference key: one like per user survives
    assert lay.read("silver", "likes").count() == bronze_likes.select("user_id").distinct().count()
    assert lay.read("reports", "users_email").first().invalid_email_count > 0


def test_full_span_run_keeps_every_source_row(spark, tmp_path):
    """The registered end-to-end run uses a window over the whole fixture."""
    from strata.fixtures import FULL_END, FULL_START
    from strata.plans.catalog import sentiment_weights
    f = Fixture(spark, SF_SMALL)
    base = str(tmp_path / "lake")
    sources = {"users": f.users(), "posts": f.posts().drop("sentiment"),
               "comments": f.comments().drop("sentiment"), "likes": f.likes()}
    run_pipeline(spark, sources, base, FULL_START, FULL_END, as_of=AS_OF,
                 model=sentiment_weights(spark, SF_SMALL))
    lay = Layout(spark, base, FULL_START, FULL_END)
    bronze = {r.table_name: r.row_count for r in verify_bronze(lay).collect()}
    assert bronze == {name: df.count() for name, df in sources.items()}
    silver_posts = lay.read("silver", "posts_scored").count()
    assert lay.read("gold", "gold_post_performance").count() == silver_posts
