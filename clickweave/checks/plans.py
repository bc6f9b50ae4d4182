"""Summarise the executed (adaptive, final) physical plan of each library
query on the stored table, and of the ETL, as a markdown table.

    python -m clickweave.checks.plans /root/testdata/sf0.1 > docs/PLANS.md
"""

from __future__ import annotations

import re
import sys


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _final_only(plan: str) -> str:
    """The plan without the "Initial Plan" part of any adaptive node (a subquery
    has one of its own)."""
    out, cut = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if cut is not None and depth <= cut:
            cut = None
        if "== Initial Plan ==" in line:
            cut = depth
        if cut is None:
            out.append(line)
    return "\n".join(out)


def summarize(plan: str) -> dict:
    final = _final_only(plan)
    scans = re.findall(r"FileScan \w+ \[([^\]]*)\]", final)
    cols = len({c.split("#")[0] for r in scans for c in r.split(",") if c.strip()})
    return {
        "shuffles": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final)),
        "reused": final.count("ReusedExchange") + final.count("ReusedSubquery"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "expand": final.count("Expand"),
        "window": len(re.findall(r"\bWindow \[", final)),
        "topk": "TakeOrderedAndProject" in final,
        "partition_filter": bool(re.search(r"PartitionFilters: \[[^\]]+\]", final)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", final))),
        "scan_cols": cols,
        "codegen": len(re.findall(r"\*\(\d+\)", final)),
        "json_parses": final.count("from_json("),
    }


def main(argv) -> int:
    sys.path.insert(0, "/root/repo")
    from clickweave.plans import library
    from clickweave.plans.registry import AS_OF, curated
    from clickweave.session import get_session, scratch_path
    from clickweave.sources.sinks import read_curated, write_curated

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    target = scratch_path(spark, "plans")
    etl = curated(spark, sf)
    write_curated(etl, target)
    rows = [("ETL (tables → curated, before the write)", summarize(_final_plan(curated(spark, sf))))]
    from clickweave.plans.jobs import land, prepare_batch
    from clickweave.plans.registry import FIXED_STAMP
    from clickweave.sources.testdata import json_lines_from_tables
    raw = scratch_path(spark, "plans-raw")
    (json_lines_from_tables(spark, sf).repartition("year", "month", "day")
     .write.partitionBy("year", "month", "day").option("compression", "gzip").text(raw))
    landing, _ = land(spark, raw)
    batch_df = prepare_batch(landing, FIXED_STAMP)
    rows.append(("batch job (landed rows → curated, before the write)",
                 summarize(_final_plan(batch_df))))
    for name, fn in library.LIBRARY.items():
        rows.append((name, summarize(_final_plan(fn(read_curated(spark, target), as_of=AS_OF)))))
    print("| query | shuffles | BHJ | SMJ | Expand | Window | top-k | partition filter | "
          "pushed filters | columns read (all scans) | codegen stages |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    for name, s in rows:
        pushed = "; ".join(s["pushed"])[:70] or "—"
        print(f"| {name} | {s['shuffles']} | {s['bhj']} | {s['smj']} | {s['expand']} | "
              f"{s['window']} | {'yes' if s['topk'] else ''} | "
              f"{'yes' if s['partition_filter'] else ''} | {pushed} | {s['scan_cols']} | "
              f"{s['codegen']} |")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
