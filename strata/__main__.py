"""Run one pipeline step (or the whole run) for a window.

    spark-submit -m strata <step> --base s3a://bucket --start 2025-01-01 --end 2025-01-31 ...
    python -m strata <step> ...

Steps: bronze, silver, keywords, train-sentiment, sentiment, daily-summary,
post-performance, user-snapshot, content-trends, verify-bronze, verify-silver,
verify-gold, preview-gold. ``bronze`` reads either a JDBC source (``--jdbc-url``; the
password comes from the environment variable named by ``--jdbc-password-env``)
or Parquet tables below ``--source-dir/<table>``.
"""

from __future__ import annotations

import argparse
import os

from .operators import nlp
from .plans import pipeline as P
from .plans.entities import ENTITIES
from .session import build_session

STEPS = ["bronze", "silver", "keywords", "train-sentiment", "sentiment", "daily-summary",
         "post-performance", "user-snapshot", "content-trends", "verify-bronze", "verify-silver",
         "verify-gold", "preview-gold"]


def _args(argv=None):
    p = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n\n")[0])
    p.add_argument("step", choices=STEPS)
    p.add_argument("--base", required=True, help="dataset root URI")
    p.add_argument("--start", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--table", action="append", choices=sorted(ENTITIES),
                   help="entity table(s) for bronze / silver (default: all four)")
    p.add_argument("--end-mode", default="instant", choices=["instant", "day"])
    p.add_argument("--as-of", default=None, help="snapshot date (default: today)")
    p.add_argument("--source-dir", help="Parquet source root for bronze")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the variable holding the password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-partitions", type=int, default=8)
    p.add_argument("--jdbc-split", default="range", choices=["range", "quantile"],
                   help="equal id strides, or equal row counts (ids dense in places)")
    p.add_argument("--model", help="saved sentiment model path")
    p.add_argument("--documents", help="Parquet documents for train-sentiment")
    p.add_argument("--labels", help="Parquet labels for train-sentiment")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv=None) -> None:
    a = _args(argv)
    spark = build_session(a.master, app_name=f"strata-{a.step}")
    lay = P.Layout(spark, a.base, a.start, a.end)
    tables = a.table or list(P.ENTITY_NAMES)
    if a.step == "bronze":
        for t in tables:
            if a.jdbc_url:
                props = {k: v for k, v in {
                    "user": a.jdbc_user, "driver": a.jdbc_driver,
                    "password": os.environ.get(a.jdbc_password_env or "", None)}.items() if v}
                P.bronze_from_jdbc(lay, t, a.jdbc_url, props, a.jdbc_partitions,
                                   split=a.jdbc_split, end_mode=a.end_mode)
            elif a.source_dir:
                P.bronze_job(lay, t, spark.read.parquet(f"{a.source_dir.rstrip('/')}/{t}"),
                             end_mode=a.end_mode)
            else:
                raise SystemExit("bronze needs --jdbc-url or --source-dir")
    elif a.step == "silver":
        for t in tables:
            P.silver_job(lay, t)
    elif a.step == "keywords":
        P.keyword_step(lay)
    elif a.step == "train-sentiment":
        if not (a.documents and a.labels and a.model):
            raise SystemExit("train-sentiment needs --documents, --labels and --model")
        model = nlp.train_sentiment(spark.read.parquet(a.documents), spark.read.parquet(a.labels))
        model.write().overwrite().save(a.model)
    elif a.step == "sentiment":
        if not a.model:
            raise SystemExit("sentiment needs --model")
        P.sentiment_step(lay, a.model)
    elif a.step == "daily-summary":
        P.daily_summary_job(lay)
    elif a.step == "post-performance":
        P.post_performance_job(lay)
    elif a.step == "user-snapshot":
        P.user_snapshot_job(lay, a.as_of)
    elif a.step == "content-trends":
        P.content_trends_job(lay)
    elif a.step == "verify-gold":
        P.verify_gold(lay).show(truncate=False)
    elif a.step == "verify-bronze":
        P.verify_bronze(lay).show(truncate=False)
    elif a.step == "verify-silver":
        P.verify_silver(lay).show(truncate=False)
    elif a.step == "preview-gold":
        for table, df in P.gold_previews(lay).items():
            print(f"=== {table} ===")
            df.show(truncate=False)


if __name__ == "__main__":
    main()
