"""Summarise the physical plan of every catalogue query into PLANS.md.

    python tools/plan_report.py [--sf DIR] [--out PLANS.md]

Per query: shuffles (Exchange), broadcasts, aggregate operators (partial
aggregation shows as a partial_* function below the Exchange), window
operators with their partition keys, generators, joins, and every scan with
its read schema and pushed / partition filters.  Plans are taken after the
query function returns (queries that exercise writers have already written).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def summarise(plan: str) -> dict[str, str]:
    lines = plan.splitlines()
    shuffles = sum(1 for l in lines if re.search(r"\bExchange (hash|range|round|Single)", l) or "Exchange SinglePartition" in l)
    broadcasts = sum(1 for l in lines if "BroadcastExchange" in l)
    aggs = sorted({m.group(1) for l in lines for m in [re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", l)] if m})
    partial = any("partial_" in l for l in lines)
    windows = []
    for l in lines:
        m = re.search(r"Window \[.*?windowspecdefinition\(([^)]*?)(?:,\s*\w+#\d+ (?:ASC|DESC)|, specifiedwindowframe)", l)
        if m:
            keys = ", ".join(re.sub(r"#\d+L?", "", k).strip() for k in m.group(1).split(",")[:3])
            windows.append(keys)
    joins = sorted({m.group(1) for l in lines for m in [re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", l)] if m})
    gens = sum(1 for l in lines if "Generate " in l)
    scans = []
    for l in lines:
        if "FileScan" in l or "Scan ExistingRDD" in l or "LocalTableScan" in l:
            fmt = re.search(r"FileScan (\w+)", l)
            loc = re.search(r"\[file:[^\]]*?/([^/\]]+)\]", l)
            rs = re.search(r"ReadSchema: struct<([^>]*)>", l)
            pf = re.search(r"PartitionFilters: \[([^\]]*)\]", l)
            pu = re.search(r"PushedFilters: \[([^\]]*)\]", l)
            cols = ",".join(c.split(":")[0] for c in rs.group(1).split(",")) if rs else ""
            desc = f"{fmt.group(1) if fmt else 'memory'} {loc.group(1) if loc else ''}".strip()
            if cols:
                desc += f" cols=[{cols}]"
            if pf and pf.group(1):
                desc += " partition-filtered"
            if pu and pu.group(1):
                desc += f" pushed=[{re.sub(r'#\\d+L?', '', pu.group(1))[:80]}]"
            scans.append(desc)
    return {
        "shuffles": str(shuffles),
        "broadcasts": str(broadcasts),
        "aggregates": ", ".join(aggs) + (" (partial)" if partial else "") if aggs else "-",
        "windows": "; ".join(f"({w})" for w in windows) or "-",
        "joins": ", ".join(joins) or "-",
        "generators": str(gens),
        "python": "yes" if ("BatchEvalPython" in plan or "ArrowEvalPython" in plan) else "no",
        "scans": "<br>".join(scans) or "-",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from feedlake.plans.catalogue import QUERIES

    cols = ["shuffles", "broadcasts", "aggregates", "windows", "joins", "generators", "python", "scans"]
    rows = []
    for name, fn in QUERIES.items():
        plan = fn(spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        rows.append("| " + " | ".join([f"`{name}`"] + [s[c] for c in cols]) + " |")
    with open(args.out, "w") as fh:
        fh.write("# Physical plans of the query catalogue\n\n")
        fh.write(
            "Generated by `python tools/plan_report.py` (local[8], driver tables at "
            f"`{os.path.basename(args.sf)}`, before adaptive re-planning). Shuffles count `Exchange` operators; "
            "`(partial)` means aggregation is combined map-side before the shuffle; windows list their partition "
            "keys. The emulated landing documents (`plans/emulate.py`) account for one shuffle in most document "
            "queries.\n\n"
        )
        fh.write("| query | " + " | ".join(cols) + " |\n|" + "---|" * (len(cols) + 1) + "\n")
        fh.write("\n".join(rows) + "\n")
    print(f"wrote {args.out} ({len(rows)} queries)")


if __name__ == "__main__":
    main()
