"""Exact quantiles of groups of any size.

A percentile aggregate keeps all distinct values of a group in one buffer. Here a wanted rank is narrowed down instead: values fall into buckets that
keep their order, the bucket that holds the rank is found from counts, and only its values go on to the next, finer buckets. A group is at most
COARSE buckets in the first pass and FINE in the second; what is left lies in one FINE-th of a 64th of an octave.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.runtime import cut_lineage

STEPS, FINE = 64, 4096


def interpolated(p: float) -> tuple[Column, Column, Column]:
    """(low rank, high rank, share of the high one) of the quantile between ranks, ranks from 1; ``n`` is the group's size."""
    at = p * (F.col("n") - 1)
    return F.floor(at) + 1, F.ceil(at) + 1, at - F.floor(at)


def discrete(p: float) -> Column:
    return F.greatest(F.ceil(F.round(p * F.col("n"), 9)), F.lit(1))


def values_at(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column]) -> DataFrame:
    """keys, n and one column per rank: the value of that rank (from 1) in its group, of values >= 0. Null keys are a group; null values don't count."""
    octave = F.log2(F.greatest(F.col("_v"), F.lit(5e-324))) * STEPS
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    base = base.withColumn("_1", F.when(F.col("_v") <= 0, F.lit(-(1 << 30))).otherwise(F.floor(octave)).cast("int"))
    base = base.withColumn("_2", F.when(F.col("_v") <= 0, 0).otherwise(F.floor((octave - F.floor(octave)) * FINE)).cast("int"))
    named = F.to_json(F.struct(*keys)) if keys else F.lit("")
    base = cut_lineage(base.groupBy(*keys, "_1", "_2", "_v").agg(F.count("*").alias("_c")).withColumn("_k", named))
    groups = base.groupBy("_k", *keys).agg(F.sum("_c").alias("n"))
    want = groups.select("_k", F.explode(F.array(*[F.struct(F.lit(name).alias("_name"), r.cast("bigint").alias("_r")) for name, r in ranks.items()])).alias("w")).select("_k", "w.*")
    part = ["_k"]
    for level in ("_1", "_2", "_v"):
        left = base if level == "_1" else base.join(want.select(*part).distinct(), part, "left_semi")
        counts = left.groupBy(*part, level).agg(F.sum("_c").alias("_c"))
        upto = F.sum("_c").over(Window.partitionBy(*part).orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hit = want.join(counts.withColumn("_to", upto), part).filter((F.col("_r") <= F.col("_to")) & (F.col("_r") > F.col("_to") - F.col("_c")))
        want = hit.select("_name", *part, level, (F.col("_r") - F.col("_to") + F.col("_c")).alias("_r"))
        part = [*part, level]
    found = want.groupBy("_k").agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])
    return groups.join(found, "_k").drop("_k")
