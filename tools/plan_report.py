"""Summarise the physical plans of registered queries (markdown to stdout).

Usage: python tools/plan_report.py [sf_dir] [name ...]

Plans are taken with the static broadcast threshold off, i.e. the shape a
query has when its inputs are too large to broadcast (AQE may still turn a
join into a broadcast at run time from measured sizes). Per query: shuffles
and their keys, join strategies, aggregate kinds, windows, and every scan's
read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402

HEADLINE = ["gold_daily_summary", "gold_post_performance", "gold_user_snapshot",
            "gold_content_trends", "silver_posts", "dq_missing", "dq_duplicates",
            "clean_text", "chunk_summary", "bronze_likes"]


def summarise(plan: str) -> dict:
    plan = re.sub(r"#\d+L?", "", plan)
    lines = plan.split("\n")
    exchanges = [m.group(1) for m in (re.search(r"Exchange (\w+(?:\([^)]*\))?)", ln)
                                      for ln in lines) if m]
    joins = [re.search(r"(\w+Join)", ln).group(1) for ln in lines
             if re.search(r"\w+Join \[", ln) or re.search(r"BroadcastHashJoin", ln)]
    aggs = [re.search(r"(\w*Aggregate)\(", ln).group(1) for ln in lines
            if re.search(r"\w*Aggregate\(", ln)]
    windows = sum(1 for ln in lines if re.search(r"\bWindow \[", ln))
    expands = sum(1 for ln in lines if re.search(r"\bExpand \[", ln))
    python = [ln.strip() for ln in lines if "Python" in ln or "InPandas" in ln]
    scans = []
    for ln in lines:
        if "FileScan parquet" in ln:
            loc = re.search(r"\[file:[^\]]*/([^/\]]+\.parquet)\]", ln)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", ln)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", ln)
            scans.append((loc.group(1) if loc else "?", schema.group(1) if schema else "?",
                          pushed.group(1) if pushed else "[]"))
    return dict(exchanges=exchanges, joins=joins, aggs=aggs, windows=windows, expands=expands,
                python=python, scans=sorted(set(scans)))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or HEADLINE
    from strata.plans.registry import all_queries
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16",
                                            "spark.sql.maxMetadataStringLength": "400"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    registry = all_queries()
    print(f"# Plan report ({sf_dir}, static broadcast threshold off)\n")
    print("Generated by `python tools/plan_report.py`. Inputs are the fixture tables, so\n"
          "scans and joins of the fixture mapping (documents with labels, events with the\n"
          "conversations lookup, the scalar row counts as `SinglePartition`) appear next to\n"
          "the operator's own shuffles.\n")
    for name in names:
        df = registry[name].build(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {name}\n")
        print(f"- shuffles ({len(s['exchanges'])}): " + ", ".join(f"`{e}`" for e in s["exchanges"]))
        print(f"- joins: {', '.join(s['joins']) or 'none'}")
        print(f"- aggregates: {', '.join(s['aggs']) or 'none'}; windows: {s['windows']}; "
              f"expands: {s['expands']}; python nodes: {len(s['python'])}")
        for f, schema, pushed in s["scans"]:
            print(f"- scan `{f}` reads `{schema}`, pushed `{pushed}`")
        print()


if __name__ == "__main__":
    main()
