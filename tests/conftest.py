import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    spark = build_session("local[*]", app_name="strata-tests", conf={
        "spark.sql.shuffle.partitions": "8",
    })
    # tests own their shared folder only when the session has none
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_uri(tmp_path):
    return str(tmp_path / "out")
