"""Seams for what a user brings along: statistics, choices, token counters, drafters, backbones and services."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


class Backbone(Protocol):
    """A model family: what it is shown, and what it says of a batch. ``predict`` runs in tasks, so it must pickle or load there."""

    name: str

    def render(self, record: Mapping) -> str: ...

    def predict(self, prompts: Sequence[str]) -> Sequence[Mapping[str, float]]: ...


@dataclass
class Services:
    """Side effects of a run, all of which tests replace."""

    ask: Callable[[Mapping], Mapping] | None = None
    clock: Callable[[], float] | None = None
    world: Callable[[str], Sequence[str]] | None = None  # values of a ground kind, looked up once on the driver
    seen: list[str] = field(default_factory=list)

    def call(self, name: str, *args):
        made = getattr(self, name)
        if made is None:
            raise LookupError(f"no service named {name} was given")
        self.seen.append(name)
        return made(*args)


def lower_median(value: np.ndarray, weight: np.ndarray) -> float:
    order = np.argsort(value)
    reached = np.cumsum(weight[order])
    return float(value[order][np.searchsorted(reached, (reached[-1] + 1) // 2)])


def statistic_of(df: DataFrame, keys: Sequence[str], value: str, statistic: Callable[[np.ndarray, np.ndarray], float]) -> DataFrame:
    """keys, n and ``statistic`` of each group's histogram. Equal values are added up first, so the callback's input grows with distinct values, not with rows."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    histogram = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_w"))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, int(g["_w"].sum()), statistic(g["_v"].to_numpy(), g["_w"].to_numpy()))])

    return histogram.groupBy(*keys).applyInPandas(run, f"{kinds}, n bigint, statistic double")


def bootstrap_statistic(histogram: Mapping[float, int], statistic: Callable[[np.ndarray, np.ndarray], float], resamples: int = 200, seed: int = 0) -> tuple[float, float]:
    """95% interval of any statistic: a resample of a histogram is a multinomial over its distinct values."""
    value, weight = np.array(list(histogram), float), np.array(list(histogram.values()))
    rng = np.random.default_rng(seed)
    got = [statistic(value[w > 0], w[w > 0]) for w in rng.multinomial(weight.sum(), weight / weight.sum(), resamples)]
    return float(np.quantile(got, 0.025)), float(np.quantile(got, 0.975))


def choose_gate(sweep: DataFrame, choose: Callable[[list[Row]], int]) -> Row:
    """The point that a callback picks from a sweep, which has one row a point of the caller's grid."""
    reports = sweep.collect()
    at = choose(reports)
    if not 0 <= at < len(reports):
        raise IndexError(f"point {at} of {len(reports)} was chosen")
    return reports[at]


def token_counter(many: Callable[[list[str]], Iterable[int]]):
    """A column function that counts tokens by batches; null has none."""

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(list(many(["" if t is None else t for t in texts])), dtype="int64")

    return count


def drafted(df: DataFrame, key: str, draft: Callable[[Mapping], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that a drafter makes of each record, behind its key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(r[key], *made) for r in b.to_dict("records") for made in draft(r)]
            yield pd.DataFrame(rows, columns=range(1 + len(schema.split(","))))

    return df.mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {schema}")


def setting(name: str, *layers: Mapping, default=None):
    """The first layer that names a setting wins: command line, file, environment, default."""
    return next((layer[name] for layer in layers if layer.get(name) is not None), default)
