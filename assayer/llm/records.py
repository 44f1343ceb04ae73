"""Records of the two corpora: one row per id, with words, split and names as TESTDATA.md defines them.

Defined results: null, blank or wordless text and null or torn JSON have an empty word array; a row whose id is
null is dropped, because a record is known by its id; redelivered rows collapse to the earliest arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.runtime import table

MIN_DISTINCT = 6
TRAIN = "train"
EVALUATION = ("validation", "test")


def words(text: Column) -> Column:
    """Maximal runs of a-z0-9 in the lower-cased text, in order."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), F.array().cast("array<string>"))


def split_name(raw: Column) -> Column:
    """Canonical split, or null for null and unknown names."""
    s = F.lower(F.regexp_replace(raw, r"^\s+|\s+$", ""))
    return (
        F.when(s.isin("train", "training"), F.lit(TRAIN))
        .when(s.isin("validation", "val", "dev"), F.lit("validation"))
        .when(s == "test", F.lit("test"))
    )


def name_key(raw: Column) -> Column:
    """Key under which two spellings of a name are the same; null is no name."""
    k = F.regexp_replace(F.lower(raw), "[^a-z0-9]", "")
    return F.when(~k.isin("", "unknown", "na"), k)


def question_text(questions: Column) -> Column:
    """Ids, instructions, option names and descriptions of decoded ``questions``, one blank between them.

    Null when the JSON is null or torn. The keys ``type``, ``criteria`` and ``instructions`` and the type's value
    are left out.
    """
    whole = F.when(F.try_parse_json(questions).isNotNull(), F.from_json(questions, "map<string,string>"))
    as_map = lambda c: F.map_entries(F.from_json(c, "map<string,string>"))

    # Read into an array first: a lambda evaluates an expression in it each time that it is used.
    asked = F.transform(F.map_entries(whole), lambda e: F.struct(e["key"].alias("key"), F.from_json(e["value"], "struct<instructions:string,criteria:string>").alias("q")))

    def one(entry: Column) -> Column:
        criteria = F.ltrim(entry["q"]["criteria"])
        options = F.when(
            criteria.startswith("{"),
            F.transform(as_map(criteria), lambda o: F.concat_ws(" ", o["key"], o["value"])),
        ).otherwise(F.from_json(criteria, "array<string>"))
        return F.concat_ws(" ", entry["key"], entry["q"]["instructions"], F.array_join(F.coalesce(options, F.array().cast("array<string>")), " "))

    return F.array_join(F.transform(asked, one), " ")


def once_per_id(df: DataFrame, arrived: str) -> DataFrame:
    """The earliest arrival of each id; equal arrivals give the smallest row, so the choice is repeatable."""
    rest = [c for c in df.columns if c != "id"]
    ordered = F.struct(F.coalesce(F.col(arrived), F.lit("9999-12-31").cast("timestamp")).alias("_at"), *[F.col(c) for c in rest if c != arrived])
    return (
        df.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min(ordered).alias("_r"))
        .select("id", *[F.col("_r")[c].alias(c) for c in rest if c != arrived])
    )


def seed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """relation, id, text, split, origin, owner, origin_key, owner_key of seed_entries."""
    t = table(spark, sf_dir, "seed_entries").select(
        F.col("id").cast("string").alias("id"), "text", F.col("side").alias("raw_split"), F.col("source").alias("origin"), F.col("author").alias("owner"), "arrived_at"
    )
    return _shape(once_per_id(t, "arrived_at"), "seed_entries", F.col("text"))


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns of typed_rows, the text being that of the decoded questions."""
    t = table(spark, sf_dir, "typed_rows").select(
        F.col("id").cast("string").alias("id"), F.col("questions").alias("text"), F.col("split").alias("raw_split"), F.col("workflow").alias("origin"), F.col("contributor").alias("owner"), "received_at"
    )
    return _shape(once_per_id(t, "received_at"), "typed_rows", question_text(F.col("text")))


def _shape(df: DataFrame, relation: str, text: Column) -> DataFrame:
    return df.select(
        F.lit(relation).alias("relation"),
        "id",
        text.alias("text"),
        split_name(F.col("raw_split")).alias("split"),
        "origin",
        name_key(F.col("origin")).alias("origin_key"),
        name_key(F.col("owner")).alias("owner_key"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_records(spark, sf_dir).unionByName(typed_records(spark, sf_dir))


def with_words(df: DataFrame) -> DataFrame:
    """Add seq (words in order), seq_key, tokens (distinct words as 64-bit hashes, ascending) and set_key.

    set_key is null below MIN_DISTINCT distinct words, where only equal sequences are near.
    """
    return (
        df.withColumn("seq", words(F.col("text")))
        .withColumn("seq_key", F.md5(F.concat_ws(" ", "seq")))
        .withColumn("tokens", F.sort_array(F.array_distinct(F.transform("seq", lambda w: F.xxhash64(w)))))
        .withColumn("set_key", F.when(F.size("tokens") >= MIN_DISTINCT, F.md5(F.concat_ws(" ", F.sort_array(F.array_distinct("seq"))))))
    )
