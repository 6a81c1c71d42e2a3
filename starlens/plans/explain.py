"""Read physical plans through the public ``DataFrame.explain`` output.

Used by the plan tests to pin the shapes we rely on at scale: where the
exchanges are, what is broadcast, what reaches the Parquet scan.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

SUBQUERIES = "===== Subqueries ====="

# Operators that would mean per-row Python, an all-pairs join, or a window
# over the whole input in one task.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def split_plan(text: str) -> tuple[str, str]:
    """(main plan, subquery plans) of a formatted plan."""
    main, _, subs = text.partition(SUBQUERIES)
    return main, subs


def tree(text: str) -> str:
    """The operator tree of a formatted plan (before the per-node details)."""
    return text.split("\n\n\n", 1)[0]


def count(text: str, pattern: str) -> int:
    return len(re.findall(pattern, text))


def node_details(text: str, name: str) -> list[str]:
    """Detail blocks ``(n) name ...`` of a formatted plan."""
    blocks = re.split(r"\n(?=\(\d+\) )", text)
    return [b for b in blocks if re.match(rf"\(\d+\) {re.escape(name)}\b", b)]
