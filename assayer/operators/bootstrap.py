"""Bootstrap intervals from histograms.

Resampling n items with replacement draws the counts of their distinct values from a multinomial, so the interval of a mean
needs only (group, value, count). Rows become that histogram with a partial aggregate; what a task receives is bounded by the
distinct values, two for rates, however many rows there are. Groups of no items have null ends, of one item their value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DRAWS = 1000


def _ends(stat: np.ndarray) -> tuple[float | None, float | None]:
    s = np.sort(stat[~np.isnan(stat)])
    if not len(s):
        return None, None
    at = lambda q: float(s[int(round(q * (len(s) - 1)))])
    return at(0.025), at(0.975)


def mean_interval(df: DataFrame, keys: Sequence[str], value: str, seed: int = 0, draws: int = DRAWS) -> DataFrame:
    """(keys, n, mean, low, high) of a value per group."""
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", n bigint, mean double, low double, high double"

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_v")
        v, c = g["_v"].to_numpy(), g["_c"].to_numpy()
        n = int(c.sum())
        sample = np.random.default_rng(seed).multinomial(n, c / n, draws) @ v / n
        low, high = _ends(sample)
        return pd.DataFrame([[*key, n, float(v @ c / n), low, high]], columns=[*keys, "n", "mean", "low", "high"])

    return hist.groupBy(*keys).applyInPandas(run, schema)


def ratio_interval(df: DataFrame, keys: Sequence[str], stratum: str, top: str, bottom: str, seed: int = 0, draws: int = DRAWS) -> DataFrame:
    """(keys, ratio, low, high) of sum(top) / sum(bottom), each stratum resampled on its own; draws without a bottom are skipped."""
    hist = df.groupBy(*keys, stratum, F.col(top).cast("int").alias("_t"), F.col(bottom).cast("int").alias("_b")).agg(F.count("*").alias("_c"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", ratio double, low double, high double"

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(seed)
        t = b = np.zeros(draws)
        for _, s in g.sort_values([stratum, "_t", "_b"]).groupby(stratum):
            n = int(s["_c"].sum())
            w = rng.multinomial(n, s["_c"].to_numpy() / n, draws)
            t, b = t + w @ s["_t"].to_numpy(), b + w @ s["_b"].to_numpy()
        den = float(g["_b"] @ g["_c"])
        with np.errstate(divide="ignore", invalid="ignore"):
            low, high = _ends(np.where(b > 0, t / b, np.nan))
        return pd.DataFrame([[*key, float(g["_t"] @ g["_c"]) / den if den else None, low, high]], columns=[*keys, "ratio", "low", "high"])

    return hist.groupBy(*keys).applyInPandas(run, schema)


def paired_interval(df: DataFrame, item: str, model: str, value: str, base: str, seed: int = 0, draws: int = DRAWS) -> DataFrame:
    """(model, n, difference, low, high) to ``base`` on the items both answered, items drawn once for both."""
    b = df.filter(F.col(model) == base).groupBy(item).agg(F.max(F.col(value).cast("double")).alias("_b"))
    d = df.groupBy(item, model).agg(F.max(F.col(value).cast("double")).alias("_a")).join(b, item).withColumn("_d", F.col("_a") - F.col("_b"))
    return mean_interval(d, [model], "_d", seed, draws).withColumnRenamed("mean", "difference")
