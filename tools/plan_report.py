"""Summarise the physical plans of the registered queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per query: shuffles (exchanges by kind), join strategies, what each Parquet
scan reads (columns, pushed filters) and whether any Python runs in the plan.
Of the streaming queries, the source queries are run into the ``noop`` sink.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict[str, str]:
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan)
    shuffles = {k: exchanges.count(k) for k in dict.fromkeys(exchanges)}
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                       r"[^\n]*?\b(LeftOuter|RightOuter|Inner|LeftSemi|LeftAnti|FullOuter|Cross)\b", plan)
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        table = re.search(r"/([\w.=-]+)\], (?:Partition|Pushed|ReadSchema)", line) \
            or re.search(r"/([\w.=-]+\.parquet)", line)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        ncols = len(schema.group(1).split(",")) if schema and schema.group(1) else 0
        scans.append(f"{table.group(1) if table else 'written table'}: {ncols} cols"
                     + (f", pushed {pushed.group(1)}" if pushed and pushed.group(1) else ""))
    lines = plan.splitlines()
    join = next((i for i, ln in enumerate(lines) if "Join" in ln and "car_id" in ln), None)
    rules = ("> 120", "> 6000", "NOT (gear")
    alert = next((i for i, ln in enumerate(lines) if "Filter" in ln and any(rule in ln for rule in rules)), None)
    if alert is None:
        placement = "—"
    elif join is None:
        placement = "no join"
    else:  # children are printed below their parent
        placement = "before the join" if alert > join else "after the join"
    return {
        "alert filter": placement,
        "shuffles": ", ".join(f"{v}× {k}" for k, v in shuffles.items()) or "none",
        "joins": ", ".join(f"{a} {b}".strip() for a, b in joins) or "none",
        "scans": "; ".join(dict.fromkeys(scans)) or "local only",
        "python": "yes" if re.search(r"EvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan) else "no",
    }


def stream_plan(query) -> str:
    """The physical plan of a query's last micro-batch."""
    wrapped = query._jsq
    inner = wrapped.streamingQuery() if "streamingQuery" in dir(wrapped) else wrapped
    return inner.lastExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from gearwatch.plans.catalog import QUERIES
    from gearwatch.session import build_session
    spark = build_session("plan-report", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                                      "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` (AQE initial plans, `local[8]`).")
    print("`enrich_hot_car` forces the shuffle path: both sides are shuffled on (car_id, salt), the hot")
    print("car's events and those without a car spread over the salt buckets (the hot-key list was counted")
    print("before, in a separate bounded job). \"Alert filter\": the fused plans evaluate the alert predicate")
    print("before the enrichment join; plans that keep the JSON hand-offs (`window_metrics`,")
    print("`staged_topic_hops`) cannot, since the predicate reads decoded records. For streams, the plan")
    print("is the last micro-batch's.\n")
    print("| Query | Shuffles | Joins | Alert filter | Parquet scans (columns read, pushed filters) | Python |")
    print("|---|---|---|---|---|---|")

    def row(name: str, plan: str) -> None:
        s = summarise(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['joins']} | {s['alert filter']} | {s['scans']} | {s['python']} |")

    from gearwatch.plans import catalog
    for name, fn in QUERIES.items():
        if not name.startswith("stream_") and name not in ("topic_chain_stream", "inject_alert"):
            row(name, fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
    streams = {
        "stream_enrich": (catalog.enrich(catalog._stream_events(spark, sf_dir), *catalog._dims(spark, sf_dir)), "append"),
        "stream_alerts": (catalog.alerts_of(catalog._stream_events(spark, sf_dir), *catalog._dims(spark, sf_dir)), "append"),
        "stream_window_complete": (catalog._stream_windows(spark, sf_dir), "complete"),
        "stream_window_update": (catalog._stream_windows(spark, sf_dir), "update"),
    }
    for name, (df, mode) in streams.items():
        query = df.writeStream.outputMode(mode).format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        row(name, stream_plan(query))
    spark.stop()


if __name__ == "__main__":
    main()
