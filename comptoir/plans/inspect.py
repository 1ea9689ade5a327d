"""Physical-plan checks, from the public ``explain`` text.

Used by tests to hold the plans to the shape the engine is designed for:
filters and column pruning at the scan, top-N cut before the shuffle, no
Cartesian product, no Python evaluation in the hot path.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def forbidden_operators(df: DataFrame) -> list[str]:
    text = plan_text(df)
    return [op for op in FORBIDDEN if op in text]


def scans(df: DataFrame) -> list[dict[str, str]]:
    """One dict per parquet scan node: Location, ReadSchema, PushedFilters, PartitionFilters."""
    out = []
    for block in re.split(r"\n\(\d+\) ", plan_text(df)):
        if not block.startswith("Scan parquet"):
            continue
        d = {}
        for key in ("Location", "ReadSchema", "PushedFilters", "PartitionFilters"):
            m = re.search(rf"^{key}: (.*)$", block, re.M)
            if m:
                d[key] = m.group(1)
        out.append(d)
    return out


def count(df: DataFrame, operator: str) -> int:
    """Occurrences of a physical operator in the plan tree."""
    tree = plan_text(df).split("\n\n")[0]
    return len(re.findall(rf"\b{re.escape(operator)}\b", tree))


def _indent(line: str) -> int:
    m = re.search(r"[A-Za-z*]", line)
    return m.start() if m else len(line)


def path_to_root(df: DataFrame, scan_of: str) -> list[str]:
    """Operators from the scan of ``scan_of`` (a path fragment) up to the root, in the simple plan tree."""
    lines = [l for l in plan_text(df, "simple").split("== Physical Plan ==")[-1].splitlines() if l.strip()]
    idx = next(i for i, l in enumerate(lines) if "FileScan" in l and scan_of in l)
    path, level = [lines[idx]], _indent(lines[idx])
    for l in reversed(lines[:idx]):
        if _indent(l) < level:
            path.append(l)
            level = _indent(l)
    return [re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", l) for l in path]


def shuffled_before_join(df: DataFrame, scan_of: str) -> bool:
    """Whether the rows of that scan go through an Exchange before they meet their first join."""
    for op in path_to_root(df, scan_of)[1:]:
        if op.startswith("Exchange"):
            return True
        if "Join" in op.split(" ")[0]:
            return False
    return False
