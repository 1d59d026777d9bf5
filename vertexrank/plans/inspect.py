"""Reading physical plans: what ``explain()`` prints, as text and counts.

Used by tests to pin the plan shape (one shuffle per rank step, no Python in
the hot path, filters and column pruning reaching the parquet scan).
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "MapInArrow",
    "PythonMapInArrow",
    "FlatMapGroupsInPandas",
    "FlatMapGroupsInArrow",
    "FlatMapCoGroupsInPandas",
    "FlatMapCoGroupsInArrow",
    "AggregateInPandas",
    "WindowInPandas",
    "PythonUDF",
)
_MARKER = re.compile(r"[:+]- ")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _indent(line: str) -> int:
    m = _MARKER.search(line)
    return m.start() if m else 0


def live_plan_lines(df: DataFrame) -> list[str]:
    """Physical plan lines, without the plans of already-cached tables
    (everything nested under an ``InMemoryRelation`` runs only once)."""
    lines = plan_text(df).splitlines()
    out: list[str] = []
    skip_below = None
    for line in lines:
        if not line.strip() or line.startswith("=="):
            continue
        ind = _indent(line)
        if skip_below is not None:
            if ind > skip_below:
                continue
            skip_below = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_below = ind
    return out


def shuffle_count(df: DataFrame) -> int:
    """Shuffle exchanges the plan runs (broadcasts and cached subplans excluded)."""
    return sum(
        1
        for line in live_plan_lines(df)
        if re.search(r"\bExchange\b", line) and "BroadcastExchange" not in line and "ReusedExchange" not in line
    )


def python_nodes(df: DataFrame) -> list[str]:
    """Plan lines that would run Python code per row or batch."""
    return [line for line in live_plan_lines(df) if any(p in line for p in PYTHON_NODES)]
