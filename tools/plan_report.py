"""Summarise the final (post-AQE) physical plans of registered queries:
shuffles, reused exchanges, join strategies, aggregates, windows and what
reaches the parquet scans. usage: python tools/plan_report.py [sf_dir] [query ...]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTED = ["Exchange hashpartitioning", "Exchange rangepartitioning", "REBALANCE", "ReusedExchange",
           "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "HashAggregate", "SortAggregate",
           "Window ", "Generate", "Union", "Scan ExistingRDD", "FileScan", "EvalPython", "ArrowEvalPython"]

DEFAULT = ["event_traffic", "session_traffic_30d", "session_traffic_30d_window", "events_sessionized",
           "purchase_items", "shard_point_scan", "channel_grouping", "document_language_name"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or DEFAULT
    from touchline.plans import catalog
    from touchline.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    out = [f"# Final physical plans at {sf_dir} (local[8], AQE on)\n"]
    for name in names:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # keep the final (adaptive) tree only
        counts = {k.strip(): plan.count(k) for k in COUNTED if plan.count(k)}
        out.append(f"## {name}\n")
        out.append("| operator | count |\n| --- | --- |")
        out += [f"| {k} | {v} |" for k, v in counts.items()]
        for line in plan.splitlines():
            if "FileScan" in line:
                parts = re.findall(r"(PartitionFilters: \[[^\]]*\]|PushedFilters: \[[^\]]*\]|ReadSchema: \S+)", line)
                out.append("\n- scan: " + "; ".join(p[:300] for p in parts))
        out.append("")
    text = "\n".join(out)
    print(text)
    return text


if __name__ == "__main__":
    main(sys.argv)
