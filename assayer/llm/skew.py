"""Equi-joins whose left side may hold a large share of its rows under a few keys.

The heaviest keys, at most HOT of them, are found by one aggregate and kept with a count each; their left rows are salted and
only their right rows are repeated, so no other row is copied. A key outside the list holds less than 1 / HOT of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 256
OVER = 100_000  # rows of a key from which it is split
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], over: int = OVER) -> list[tuple]:
    """At most HOT rows: the values of the heaviest keys and the number of their salts."""
    if getattr(df, "_assayer_path", None) and df.count() <= over:  # of a written table the count is in its footers, and no key can have more
        return []
    heavy = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > over).orderBy(F.desc("_n"), *keys).limit(HOT)
    return [(*[r[k] for k in keys], int(min(SALTS, r["_n"] // over + 1))) for r in heavy.collect()]


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hot: list[tuple] | None = None, over: int | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` for how in inner, left, left_semi, left_anti."""
    hot = (hot_keys(left, keys) if over is None else hot_keys(left, keys, over)) if hot is None else hot
    if not hot:
        return left.join(right, list(keys), how)
    kinds = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)
    split = F.broadcast(left.sparkSession.createDataFrame(hot, f"{kinds}, _salts int"))  # at most HOT rows
    other = [c for c in left.columns if c not in keys]
    salted = left.join(split, list(keys), "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*(other or keys)), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    copies = right.join(split, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
