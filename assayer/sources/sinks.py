"""JSONL and partitioned sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_json_lines(df: DataFrame, path: str, required: Sequence[str]) -> None:
    """Required fields are always written, others only where they are not null."""
    optional = [c for c in df.columns if c not in required]
    must = F.to_json(F.struct(*required), {"ignoreNullFields": "false"})
    may = F.to_json(F.struct(*optional), {"ignoreNullFields": "true"}) if optional else F.lit("{}")
    joined = F.when(F.col("o") == "{}", F.col("m")).otherwise(F.concat(F.expr("substring(m, 1, length(m) - 1)"), F.lit(","), F.expr("substring(o, 2)")))
    df.select(must.alias("m"), may.alias("o")).select(joined.alias("value")).write.mode("overwrite").text(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """Fails on a malformed line or a repeated key; blank lines are skipped."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    twice = df.groupBy(key).count().filter("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"repeated {key}: {[r[key] for r in twice]}")
    return df


def write_sides(df: DataFrame, path: str, side: str = "side") -> None:
    df.write.mode("overwrite").partitionBy(side).parquet(path)
