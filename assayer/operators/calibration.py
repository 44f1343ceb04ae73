"""Temperature and vector calibration fitted by aggregates: rows stay distributed, a round is one job.

The temperature is bracketed on a log scale: each round evaluates PROBES points in one aggregate and keeps the neighbours of the best.
The vector takes damped Newton steps on all label scales at once, from sums per label.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions import labels as L

PROBES, ROUNDS, LIMIT = 17, 5, math.log(20.0)


def fit_rows(df: DataFrame, candidates: str, gold: str) -> DataFrame:
    """Rows whose gold label has a candidate of its family."""
    return df.filter(F.col(candidates).isNotNull() & F.exists(F.map_keys(candidates), lambda k: L.canonical(k) == L.canonical(F.col(gold)))).select(F.col(candidates).alias("c"), F.col(gold).alias("g"))


def fit_temperature(rows: DataFrame) -> float:
    """Temperature of least total NLL; 1 without rows."""
    low, high = -LIMIT, LIMIT
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / (PROBES - 1) for i in range(PROBES)]
        probes = rows.select("c", "g", F.explode(F.array(*[F.lit(math.exp(x)) for x in points])).alias("t"))  # added up before the shuffle
        got = [r["nll"] for r in probes.groupBy("t").agg(F.sum(L.row_nll(F.col("c"), F.col("g"), F.col("t"))).alias("nll")).orderBy("t").collect()]
        if not got:
            return 1.0
        best = min(range(PROBES), key=lambda i: got[i])
        low, high = points[max(0, best - 1)], points[min(PROBES - 1, best + 1)]
    return math.exp((low + high) / 2)


def _total_nll(rows: DataFrame, scale: dict[str, float]) -> float:
    scaled = rows.select("g", L.vector_scale(F.col("c"), scale).alias("c"))
    own = L.total(F.map_values(F.map_filter("c", lambda k, _: L.canonical(k) == L.canonical(F.col("g")))))
    return scaled.agg(F.sum(-F.log(F.greatest(own, F.lit(1e-12)))).alias("nll")).first()["nll"] or 0.0


def fit_vector(rows: DataFrame, rounds: int = 60, ridge: float = 1e-3, gain: float = 1e-6) -> dict[str, float]:
    """Scale per label, the labels being those of the domain: damped Newton on all log scales at once.

    A step that doesn't lower the penalised NLL is halved; the fit ends when a round gains less than ``gain`` of it, and raises if ``rounds`` don't reach that.
    """
    scale: dict[str, float] = {}
    penalty = lambda s: ridge / 2 * sum(math.log(v) ** 2 for v in s.values())
    value = _total_nll(rows, scale)
    for _ in range(rounds):
        scaled = rows.select("g", L.vector_scale(F.col("c"), scale).alias("c"))
        family = L.total(F.map_values(F.map_filter("c", lambda k, _: L.canonical(k) == L.canonical(F.col("g")))))
        e = scaled.withColumn("family", family).select("g", "family", F.explode("c").alias("label", "p"))
        target = F.when(L.canonical(F.col("label")) == L.canonical(F.col("g")), F.col("p") / F.greatest(F.col("family"), F.lit(1e-12))).otherwise(0.0)
        sums = e.groupBy("label").agg(F.sum(F.col("p") - target).alias("slope"), F.sum(F.col("p") * (1 - F.col("p"))).alias("bend")).collect()  # one row a label
        if not sums:
            return scale
        step = {r["label"]: max(-1.0, min(1.0, (r["slope"] + ridge * math.log(scale.get(r["label"], 1.0))) / (r["bend"] + ridge))) for r in sums}
        size = 1.0
        while True:
            new = scale | {k: scale.get(k, 1.0) * math.exp(-size * x) for k, x in step.items()}
            now = _total_nll(rows, new) + penalty(new)
            if now <= value or size < 1e-3:
                break
            size /= 2
        done = value - now <= gain * max(1.0, abs(value))
        if now <= value:
            scale, value = new, now
        if done:
            return scale
    raise ArithmeticError(f"the NLL still falls after {rounds} rounds")


def calibration_error(df: DataFrame, candidates, gold: str) -> float | None:
    """ECE of the top candidate of a rolled-up distribution."""
    top = L.top_candidate(L.rollup(candidates))
    t = df.select(top["value"].alias("p"), (top["key"] == F.col(gold)).cast("double").alias("ok"))
    h = t.groupBy(L.bin_index(F.col("p")).alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("c"), F.avg("ok").alias("a"))
    return h.agg((F.sum(F.col("n") * F.abs(F.col("a") - F.col("c"))) / F.sum("n")).alias("e")).first()["e"]


def select_calibration(fit: DataFrame, selection: DataFrame, candidates: str = "candidates", gold: str = "gold") -> dict:
    """Fitted on one fold; the vector is kept only if its error on the other is strictly lower."""
    rows = fit_rows(fit, candidates, gold).cache()
    temperature = fit_temperature(rows)
    vector = fit_vector(rows)
    rows.unpersist()
    s = selection.filter(F.col(candidates).isNotNull())
    c = F.col(candidates)
    errors = {"none": calibration_error(s, c, gold), "temperature": calibration_error(s, L.temperature_scale(c, temperature), gold), "vector": calibration_error(s, L.vector_scale(c, vector), gold)}
    best = min(("temperature", "vector"), key=lambda k: (errors[k] if errors[k] is not None else math.inf, k))
    return {"temperature": temperature, "vector": vector, "errors": errors, "kept": best}
