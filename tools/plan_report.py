"""Summarise the executed physical plan of every named query into PLANS.md.

For each query: scans with their ReadSchema and PushedFilters, shuffles, join strategies, aggregate kinds,
windows, reused exchanges / subqueries. Runs each query once (at sf0.01 by default) so AQE's final plan is shown.
Usage: python tools/plan_report.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NODES = (
    "Exchange",
    "ReusedExchange",
    "BroadcastExchange",
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "HashAggregate",
    "SortAggregate",
    "ObjectHashAggregate",
    "Window",
    "TakeOrderedAndProject",
    "Generate",
    "ReusedSubquery",
)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    # drop AQE's initial plans (the tree part after "== Initial Plan ==" up to the node details)
    return text


def summarise(text: str) -> dict:
    trees = re.split(r"\n\n\(\d+\) ", text)[0]
    final_parts = re.split(r"\+- == Initial Plan ==", trees)
    final = final_parts[0]
    counts = {n: len(re.findall(rf"(?:[-+] |^ *)\*? ?{n}(?: [A-Za-z]+)* \(", final, re.M)) for n in NODES}
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\nOutput[^\n]*\nBatched[^\n]*\nLocation: [^\[]*\[([^\]]*)\][^\n]*\n(?:PartitionFilters[^\n]*\n)?(?:PushedFilters: ([^\n]*)\n)?ReadSchema: ([^\n]*)", text)
    uniq = []
    for loc, pushed, schema in scans:
        item = (os.path.basename(loc.split(",")[0]), pushed or "[]", schema)
        if item not in uniq:
            uniq.append(item)
    scans_final = len(re.findall(r"Scan parquet", final))
    return {"counts": {k: v for k, v in counts.items() if v}, "scans": uniq, "scan_nodes": scans_final}


def main(argv):
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine: scratch data of the stored-table queries
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ebbflow-plans-"))
    from ebbflow.plans import QUERIES

    lines = [
        "# PLANS — executed physical plans of the named queries",
        "",
        f"Generated by `tools/plan_report.py` at `{sf_dir}` on local[8] with AQE (final plans after one run).",
        "Counts are operators in the main query's final plan (subquery plans are summarised by their scans).",
        "",
    ]
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # executes this DataFrame's own plan, so explain shows AQE's final plan (small at sf0.01)
        s = summarise(final_plan(df))
        ops = ", ".join(f"{k}×{v}" for k, v in s["counts"].items()) or "-"
        lines.append(f"## {name}")
        lines.append("")
        lines.append(f"- operators: {ops}")
        lines.append(f"- scan nodes in the final main plan: {s['scan_nodes']}")
        for table, pushed, schema in s["scans"]:
            lines.append(f"- scan `{table}` ReadSchema `{schema}` PushedFilters `{pushed}`")
        lines.append("")
        print(name, "scans", s["scan_nodes"], ops, flush=True)
    with open(out, "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv)
