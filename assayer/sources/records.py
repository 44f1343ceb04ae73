"""Typed-decision records: JSON columns to questions, gold and teacher distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BODY = "struct<type:string,instructions:string,criteria:string>"
GOLD = "struct<type:string,label:string,confidence:double,score:double,noul:double,probabilities:map<string,double>>"


def parsed(text: Column, schema: str) -> Column:
    """Null for null and torn JSON, never a partial row."""
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema))


def first_arrival(df: DataFrame, key: str, arrived: str) -> DataFrame:
    """Redelivered rows repeat their content, so they collapse to the earliest arrival of their key.

    One aggregate a column, so that Catalyst drops those no one asks for and the scan reads the rest only. A null arrival comes last.
    """
    at = F.coalesce(F.col(arrived), F.lit("9999-12-31").cast("timestamp"))
    return df.groupBy(key).agg(*[F.min_by(c, at).alias(c) for c in df.columns if c not in (key, arrived)])


def options(kind: Column, criteria: Column) -> Column:
    """Option names: keys of an object, places of a list."""
    c = F.ltrim(criteria)
    n = F.size(F.from_json(c, "array<string>"))
    placed = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i.cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.when(c.startswith("{"), F.map_keys(F.from_json(c, "map<string,string>"))).when(c.startswith("["), placed)


def typed_questions(rows: DataFrame) -> DataFrame:
    """(id, qid, kind, instructions, options) of every decoded question."""
    q = rows.select("id", F.explode(parsed(F.col("questions"), "map<string,string>")).alias("qid", "body"))
    b = F.from_json("body", BODY)
    return q.select("id", "qid", b["type"].alias("kind"), b["instructions"].alias("instructions"), options(b["type"], b["criteria"]).alias("options"))


def typed_gold(rows: DataFrame) -> DataFrame:
    """(id, qid, kind, label, confidence, probabilities) of every decoded gold answer."""
    g = rows.select("id", F.explode(parsed(F.col("gold"), f"map<string,{GOLD}>")).alias("qid", "g"))
    return g.select("id", "qid", F.col("g.type").alias("kind"), F.col("g.label").alias("label"), F.col("g.confidence").alias("confidence"), F.col("g.probabilities").alias("probabilities"))


def bench_questions(rows: DataFrame) -> DataFrame:
    """(id, kind, options, gold, soft) of bench rows; labels lose case and outer blanks."""
    b = parsed(F.col("question"), BODY)
    return rows.select("id", "source", b["type"].alias("kind"), options(b["type"], b["criteria"]).alias("options"), F.lower(F.trim("label")).alias("gold"), parsed(F.col("soft_label"), "map<string,double>").alias("soft"))
