"""Driver-side rules over small summaries: guards, verdict precedence, report text; and the seams for outside models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_LINES = 5000


class SealedError(ValueError):
    """Sealed data was about to be read; the message names ids only, never text."""


def refuse_sealed(df: DataFrame, side: str, key: str = "id", sealed: Sequence[str] = ("test", "held_out")) -> DataFrame:
    """The table itself, unless it holds rows of a sealed side."""
    found = [r[key] for r in df.filter(F.lower(F.trim(side)).isin(*sealed)).select(key).limit(3).collect()]
    if found:
        raise SealedError(f"rows of a sealed side, first {found}")
    return df


def verdict(summary: Mapping) -> tuple[str, str]:
    """(verdict, why): hard stop, grader, quantisation, stale gate, no candidate, recalibrate, ship, in this order."""
    checks = (
        ("stop", summary.get("hard_stops"), "hard stop"),
        ("fix_grader", summary.get("grader_problems"), "grader"),
        ("heal", summary.get("quant_loss", 0.0) > 3.0 or summary.get("new_wrong"), "quantisation"),
        ("refit_gate", summary.get("gate_stale"), "gate fitted on another fold"),
        ("diagnose", not summary.get("chosen"), "no candidate passes the rule"),
        ("recalibrate", summary.get("ece") is not None and summary["ece"] > summary.get("ece_bar", 0.05), "calibration"),
    )
    for name, hit, why in checks:
        if hit:
            return name, why
    return "ship", "all bars met"


def markdown(df: DataFrame, title: str, order: Sequence[str]) -> str:
    """A report table; its rows are groups of a report. More than MOST_LINES are refused, not cut."""
    rows = df.orderBy(*order).limit(MOST_LINES + 1).collect()
    if len(rows) > MOST_LINES:
        raise ValueError(f"a report has at most {MOST_LINES} lines")
    show = lambda v: "" if v is None else f"{v:.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(show(v) for v in r) + " |" for r in rows)])


def scored(df: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Rows through an outside model, loaded once a task: ``make`` returns batch -> rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            yield model(b)

    return df.mapInPandas(run, schema)


def resumed(planned: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Planned rows without a finished one."""
    return planned.join(done.select(key).distinct(), key, "left_anti")
