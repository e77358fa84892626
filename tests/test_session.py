"""Session defaults never override what the deployment configured."""

import json
import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import json, sys
    sys.path.insert(0, {REPO!r})
    from strata.session import build_session
    spark = build_session("local[1]", conf={{"spark.sql.adaptive.skewJoin.enabled": "false"}})
    keys = ["spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.skewJoin.enabled", "spark.ui.enabled"]
    print(json.dumps({{k: spark.conf.get(k) for k in keys}}))
    spark.stop()
""")


def test_deployment_settings_win_over_defaults():
    # spark-submit passes --conf values to the launched JVM the same way
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--conf spark.sql.session.timeZone=Asia/Tokyo "
                                               "--conf spark.sql.adaptive.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True,
                         timeout=300, check=True).stdout
    got = json.loads(out.strip().splitlines()[-1])
    assert got == {"spark.sql.session.timeZone": "Asia/Tokyo",       # deployment
                   "spark.sql.adaptive.enabled": "false",             # deployment
                   "spark.sql.adaptive.skewJoin.enabled": "false",    # conf argument
                   "spark.ui.enabled": "false"}                       # launch default
