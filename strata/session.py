"""Session factory and shared-storage helpers.

Library operators never build or stop a session: they take the one their
input DataFrames carry. This module is for entry points (bench, tests,
pipeline runs) that need a session, and for the few operators that must
write to storage every executor can see.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings read when the application starts: no UI server, no _SUCCESS marker
# files and no write checksums (writer hygiene, S-10).
LAUNCH_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "spark.hadoop.dfs.client.write.checksum": "false",
}
# SQL settings, applied only where the application's configuration
# (spark-submit --conf, spark-defaults.conf, the ``conf`` argument) does not
# set them: on a cluster the deployment decides shuffle width, split size and
# skew thresholds (README "Cluster settings"); these keep a local run honest
# (AQE on, UTC dates).
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "strata",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` is only set when given, so ``spark-submit`` keeps control on a
    cluster; ``conf`` entries win over the defaults.
    """
    conf = dict(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAUNCH_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    app_conf = spark.sparkContext.getConf()
    for key, value in SQL_DEFAULTS.items():
        if key not in conf and not app_conf.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read and write.

    It is the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir set on
    the context). Only when neither is set (a local test session) do we make a
    scratch folder and register it with ``setCheckpointDir``, so that later
    calls and ``DataFrame.checkpoint()`` agree. ``spark.checkpoint.dir`` itself
    is a core setting and cannot be changed on a running session.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not str(sc.master).startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share; "
                           "a driver-local scratch folder is not visible to them")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


#: Whether shuffle files go when the write that made them ends, not when the driver's
#: collector next finds time.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def set_for(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` holds inside; then what was set before."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_freed(df: DataFrame, path: str) -> None:
    """Writes ``df``; its shuffle files go with the write."""
    with set_for(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        df.write.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below :func:`shared_dir` for one write."""
    return f"{shared_dir(spark)}/strata/{name}/{uuid.uuid4().hex}"


def join_uri(base: str, *parts: str) -> str:
    """Join a base URI (``s3a://b``, ``file:/x``, ``/x``) with path parts."""
    base = base.rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts if p]])
