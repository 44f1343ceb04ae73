"""Ranks and running sums in groups of any size.

A window over a group sorts the whole group in one task. Here rows carry a bucket that is monotone in the order; a window runs inside
a bucket only, and the sums of earlier buckets, one row a bucket, are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.runtime import cut_lineage

HEX = 3  # 4,096 buckets a group


def running(df: DataFrame, part: Sequence[str], bucket: Column, order: Sequence, value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and with each row, in ``order``; ``bucket`` must not fall along it."""
    key = F.concat_ws("\x00", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in part]) if part else F.lit("")
    d = df.withColumn("_k", key).withColumn("_b", bucket).withColumn("_v", value)
    sums = d.groupBy("_k", "_b").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_k", "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy("_k", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("_in", F.sum("_v").over(inside)).join(sums, ["_k", "_b"]).withColumn(out, F.col("_from") + F.col("_in")).drop("_k", "_b", "_v", "_in", "_from")


def rank_by_hash(df: DataFrame, part: Sequence[str], digest: str, tie: str, out: str = "k") -> DataFrame:
    """Place in a group by a hexadecimal digest, whose first digits are the bucket."""
    return running(df, part, F.substring(digest, 1, HEX), [digest, tie], F.lit(1).cast("bigint"), out)


def rank_by_range(df: DataFrame, part: Sequence[str], order: Sequence[str], out: str = "k") -> DataFrame:
    """Place in a group by columns of any kind: one range partitioning is the bucketing, written once so that both of its uses agree."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    return running(ranged, part, F.col("_range"), order, F.lit(1).cast("bigint"), out).drop("_range")


def quota(n: Column, fractions: Sequence[Column]) -> Column:
    """Struct (a, b, c) of items per side: largest remainder, ties to the earlier side; from three items on no side is empty, the largest side gives."""
    raw = [n * f for f in fractions]
    low = [F.floor(x) for x in raw]
    over = [x - y for x, y in zip(raw, low, strict=True)]
    left = n - low[0] - low[1] - low[2]
    place = lambda i: F.lit(1) + sum(((over[j] >= over[i]) if j < i else (over[j] > over[i])).cast("int") for j in range(3) if j != i)
    first = F.struct(*[(low[i] + (place(i) <= left).cast("int")).alias(k) for i, k in enumerate("abc")])

    def filled(s: Column, to: str) -> Column:
        x, y = (k for k in "abc" if k != to)
        empty = s[to] == 0
        give = {x: empty & (s[x] >= s[y]), y: empty & (s[x] < s[y])}
        return F.struct(*[(F.greatest(s[k], F.lit(1)) if k == to else s[k] - give[k].cast("int")).alias(k) for k in "abc"])

    def bound(s: Column, to: str) -> Column:
        return F.transform(F.array(s), lambda v: filled(v, to))[0]  # a variable, not copied into every use

    def all_filled(s: Column) -> Column:
        return bound(bound(bound(s, "a"), "b"), "c")

    return F.when(n >= 3, all_filled(first)).otherwise(first)
