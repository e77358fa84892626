"""Plan properties of every registered query: no Python in the hot path, no
cross or nested-loop joins, no row caps; scans pruned."""

import pytest

from conftest import SF_SMALL
from strata.plans.registry import all_queries

QUERIES = {name: q.build for name, q in all_queries().items()}
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit",
             "GlobalLimit", "Sample"]
WRITES = {"sink_parquet_sized", "sink_chunked", "medallion_run", "medallion_content_trends",
          "medallion_post_performance"}
PREVIEWS = {name for name in QUERIES if name.startswith("preview_")}  # their limit is the feature


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES - PREVIEWS))
def test_plan_has_no_slow_or_unbounded_nodes(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_gold_has_no_forced_broadcast(spark):
    from strata.operators import gold
    posts = spark.createDataFrame([], "post_id int, user_id int, content string, "
                                      "created_at timestamp, sentiment double")
    comments = spark.createDataFrame([], "comment_id int, post_id int, user_id int, "
                                         "created_at timestamp, sentiment double")
    likes = spark.createDataFrame([], "like_id int, post_id int, user_id int, created_at timestamp")
    users = spark.createDataFrame([], "user_id int, username string, registration_date date")
    def hinted(df):
        return "BROADCAST" in df._jdf.queryExecution().logical().toString().upper()

    assert not hinted(gold.user_snapshot(users, posts, comments, likes))
    assert not hinted(gold.daily_summary(posts, comments, likes))
    assert not hinted(gold.post_performance(posts, users, likes, comments))


def test_scan_prunes_text_column(spark):
    # the daily summary never reads document text
    plan = _plan(QUERIES["gold_daily_summary"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert "text" not in plan.split("documents.parquet")[1].split("ReadSchema:")[1].split(">")[0]


def test_user_aggregates_join_without_reshuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["gold_user_snapshot"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # users is shuffled once on user_id; each per-user aggregate is shuffled
    # once (by its own aggregation) and joined as is
    assert plan.count("hashpartitioning(user_id") == 4


def test_post_performance_has_one_plan_and_runs_nothing_to_build_it(spark):
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["gold_post_performance"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert "BroadcastHashJoin" not in plan
    # reading a file's footer is the only job
    assert all(sc.statusTracker().getStageInfo(s).numTasks == 1
               for j in sc.statusTracker().getJobIdsForGroup("build")
               for s in sc.statusTracker().getJobInfo(j).stageIds)


def test_email_rule_reuses_the_dedup_shuffle(spark):
    """The reference e-mail rule needs the global invalid count (a scalar
    subquery over the de-duplicated users); at run time the subquery reads the
    main query's de-duplication shuffle instead of scanning and shuffling the
    users a second time."""
    df = QUERIES["silver_users"](spark, SF_SMALL)
    df.collect()
    final = _plan(df)
    assert "ReusedExchange" in final and "hashpartitioning(user_id" in final


def test_bucketed_posts_stay_where_they_are(spark):
    """No exchange, and no sort into another place, above the scan with the posts' text."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["gold_post_performance_bucketed"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "content" in line)
    depth = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        if (own := len(line) - len(line.lstrip(" :+-*(0123456789)"))) < depth:
            above.append(line)
            depth = own
    assert "Bucketed: true" in lines[at] and any("Join" in line for line in above)
    assert not any("Exchange" in line for line in above)
