"""Summarise the physical plan of every registered query.

``python -m starlens.plans.audit [data_dir] > PLANS.md`` prints, per query,
the exchanges by kind, sorts, windows and join algorithms of the plan Spark
would run when no dimension may be broadcast on an estimate (the situation
of a very large cluster-scale dimension), and flags a ``SinglePartition``
exchange in the main plan (one task receiving all rows).
"""

from __future__ import annotations

import re
import sys

from starlens.plans.explain import plan_text, split_plan, tree

SCALE_LIKE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def summarise(df) -> dict:
    text = plan_text(df)
    main, subs = split_plan(text)
    t = tree(main)
    details = main
    exchanges = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", details)
    out = {
        "hash": exchanges.count("hashpartitioning"),
        "range": exchanges.count("rangepartitioning"),
        "single": exchanges.count("SinglePartition"),
        "broadcast": len(re.findall(r"BroadcastExchange \(", t)),
        "sorts": len(re.findall(r"\bSort \(", t)),
        "windows": len(re.findall(r"\bWindow \(", t)),
        "expand": len(re.findall(r"\bExpand \(", t)),
        "top_n": len(re.findall(r"TakeOrderedAndProject \(", t)),
        "joins": ", ".join(
            f"{j} {m}" for j in JOINS for m in re.findall(rf"{j} (\w+)", t)
        ),
        "subquery_single": len(re.findall(r"SinglePartition", subs)),
        "pruned": ", ".join(sorted(set(re.findall(r"PartitionFilters: \[(is(?:not)?null)\(starlens_order_year", main)))),
        "reads_fact": "fact_sales" in main,
    }
    return out


def single_readers(main: str) -> list[str]:
    """For each SinglePartition exchange of the plan, what it gets and the operators above it up to the next exchange."""
    lines = tree(main).splitlines()
    single = set(re.findall(r"\((\d+)\) Exchange\n(?:[^\n]+\n)*?Arguments: SinglePartition", main))
    out = []
    for i, line in enumerate(lines):
        m = re.search(r"Exchange \((\d+)\)", line)
        if not m or m[1] not in single:
            continue
        below = re.search(r"(\w+) \(\d+\)", lines[i + 1]) if i + 1 < len(lines) else None
        above = []
        for x in reversed(lines[:i]):
            name = re.search(r"(\w+) \(\d+\)", x)
            if not name or name[1] == "Exchange":
                break
            if name[1] not in ("Project", "Sort", "InputAdapter", "AdaptiveSparkPlan"):
                above.append(name[1])
        out.append(f"{below[1] if below else '?'} -> {', '.join(above[:2]) or 'result'}")
    return out


def main(argv: list[str]) -> int:
    from starlens.plans.catalog import QUERIES
    from starlens.session import build_session

    data_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra=SCALE_LIKE)
    print("# Physical plans of the registered queries\n")
    print(
        "Generated by `python -m starlens.plans.audit`: every dimension join is "
        "planned without an estimate-based broadcast, as for cluster-scale "
        "dimensions. Counts are operators in the main plan; `single` is a "
        "`SinglePartition` exchange (all rows to one task), `subq single` one inside "
        "a scalar subquery (partial sums only). `year folders` tells which folders "
        "of the year-partitioned fact are read: `isnotnull` skips the undated "
        "folder, `isnull` reads only it.\n"
    )
    print("| query | hash | range | single | subq single | bcast | sorts | windows | expand | top-n | joins | year folders |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    flagged, readers = [], {}
    for key in QUERIES:
        df = QUERIES[key](spark, data_dir)
        s = summarise(df)
        if s["single"]:
            flagged.append(key)
            readers[key] = single_readers(split_plan(plan_text(df))[0])
        print(
            f"| `{key}` | {s['hash']} | {s['range']} | {s['single']} | {s['subquery_single']} | "
            f"{s['broadcast']} | {s['sorts']} | {s['windows']} | {s['expand']} | {s['top_n']} | {s['joins'] or '-'} | "
            f"{s['pruned'] or ('all' if s['reads_fact'] else '-')} |"
        )
    print()
    print("Queries with a main-plan `SinglePartition` exchange, and the operator that reads it:")
    for key in flagged or ["none"]:
        print(f"- {key}" + (f": {', '.join(readers[key])}" if key in readers else ""))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
