"""Connected components by random-mate contraction, and splits that keep components whole (problem 3).

Each round every vertex tosses a coin that is a hash of its name and the round. A vertex with tails joins the
smallest neighbour with heads; both ends of every edge are renamed by two joins, loops and repeated edges go, and
the round is over. An expected quarter of the vertices that still have edges leaves per round, so the number of
rounds is logarithmic, and a hub is never gathered into one task: only the per-vertex minimum is aggregated, with
a partial aggregate before its shuffle. The mates of all rounds are unwound from the last to the first.

Defined results: null ends and loops give no edge; repeated edges count once; an empty edge table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm.records import records
from assayer.llm.skew import hot_keys, skew_join
from assayer.runtime import cut_lineage, release

UNWIND_CUT = 4


def _heads(vertex: str, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(vertex), F.lit(salt)), F.lit(2)) == 1


def components(edges: DataFrame, left: str = "a", right: str = "b", seed: int = 7) -> DataFrame:
    """(node, component) for every vertex that has an edge to another vertex.

    Every round is the same distributed plan at any size; its tables are deleted once nothing reads them.
    """
    e = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a != b")
    e = cut_lineage(e.union(e.select("b", "a")).distinct())
    mates: list[DataFrame] = []
    while not e.isEmpty():
        salt = seed + 1000003 * len(mates)
        mate = cut_lineage(e.filter(~_heads("a", salt) & _heads("b", salt)).groupBy("a").agg(F.min("b").alias("mate")))
        mates.append(mate)
        end = lambda v: mate.select(F.col("a").alias(v), F.col("mate").alias(f"_{v}"))  # noqa: E731, B023
        hot = hot_keys(e, ["a"])  # the graph is symmetric, so these are the hubs of both ends
        half = skew_join(e, end("a"), ["a"], "left", hot).select(F.coalesce("_a", "a").alias("a"), "b")
        both = skew_join(half, end("b"), ["b"], "left", hot).select("a", F.coalesce("_b", "b").alias("b"))
        before, e = e, cut_lineage(both.filter("a != b").distinct())
        release(before)
    if not mates:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label, own = mates[-1].withColumnRenamed("a", "node").withColumnRenamed("mate", "component"), None
    for k, mate in enumerate(reversed(mates[:-1]), 1):
        to = label.select(F.col("node").alias("mate"), F.col("component").alias("_c"))
        label = mate.withColumnRenamed("a", "node").join(to, "mate", "left").select("node", F.coalesce("_c", "mate").alias("component")).unionByName(label)
        if k % UNWIND_CUT == 0:
            label, old = cut_lineage(label), own
            own = label
            if old is not None:
                release(old)
    # A root never mates, so it has no row yet.
    roots = label.select(F.col("component").alias("node"), "component").distinct()
    done = cut_lineage(label.unionByName(roots))
    for old in [e, *mates, *([own] if own is not None else [])]:
        release(old)
    return done


# --------------------------------------------------------------------------------------------------- units


def _name(relation: str, kind: str, key: str) -> Column:
    return F.concat(F.col(relation), F.lit(f"|{kind}|"), F.col(key))


def pair_units(pairs: DataFrame, seed: int = 7) -> DataFrame:
    """The unit of each distinct (relation, origin_key, owner_key), of which at least one key is a name.

    The graph has names for vertices and distinct pairs of names for edges, so its size is that of the vocabulary
    of names however many records share one.
    """
    keyed = pairs.select("relation", "origin_key", "owner_key").distinct()
    edges = keyed.filter("origin_key IS NOT NULL AND owner_key IS NOT NULL").select(_name("relation", "s", "origin_key").alias("a"), _name("relation", "o", "owner_key").alias("b"))
    found = components(edges, seed=seed)
    anchor = F.coalesce(_name("relation", "s", "origin_key"), _name("relation", "o", "owner_key"))
    return (
        keyed.withColumn("node", anchor)
        .filter("node IS NOT NULL")
        .join(found, "node", "left")
        .select("relation", "origin_key", "owner_key", F.coalesce("component", "node").alias("unit"))
    )


def _same_keys(df: DataFrame) -> DataFrame:
    """Null keys as text, so that an equi-join meets them."""
    return df.withColumn("_s", F.coalesce("origin_key", F.lit(""))).withColumn("_o", F.coalesce("owner_key", F.lit("")))


def with_units(recs: DataFrame, units: DataFrame) -> DataFrame:
    """Records with their unit; a record without any name is a unit of its own and meets no join. Hot names are salted."""
    named = recs.filter("origin_key IS NOT NULL OR owner_key IS NOT NULL")
    found = skew_join(_same_keys(named), _same_keys(units).select("relation", "_s", "_o", "unit"), ["relation", "_s", "_o"], "left").drop("_s", "_o")
    alone = recs.filter("origin_key IS NULL AND owner_key IS NULL").withColumn("unit", F.concat("relation", F.lit("|r|"), "id"))
    return found.unionByName(alone.select(*found.columns))


def broken_units(recs: DataFrame, seed: int = 7) -> DataFrame:
    """(relation, id) of the records whose unit holds records of more than one split."""
    named = recs.filter("origin_key IS NOT NULL OR owner_key IS NOT NULL").select("relation", "id", "origin_key", "owner_key", "split")
    pairs = cut_lineage(named.select("relation", "origin_key", "owner_key", "split").distinct())
    units = cut_lineage(_same_keys(pair_units(pairs, seed)).select("relation", "_s", "_o", "unit"))
    mixed = (
        _same_keys(pairs)
        .join(units, ["relation", "_s", "_o"])
        .groupBy("unit")
        .agg(F.min("split").alias("first"), F.max("split").alias("last"))
        .filter("first != last")
        .select("unit")
    )
    bad = units.join(mixed, "unit", "left_semi").drop("unit")
    return skew_join(_same_keys(named).drop("split"), bad, ["relation", "_s", "_o"], "left_semi").select("relation", "id")


# ------------------------------------------------------------------------------------------------- splitting

SHARES = (("train", 0.70), ("validation", 0.15), ("test", 0.15))
LARGE = 0.01
BUCKETS = 1024


def split_by_weight(units: DataFrame, shares: Sequence[tuple[str, float]] = SHARES, large: float = LARGE) -> DataFrame:
    """(relation, unit, assigned) for weighted units (relation, unit, weight).

    Units above ``large`` of their relation's weight, of which there are at most 1 / large, are dealt one by one to
    the split that lacks most. All others follow in the order of a hash and are cut where their cumulative weight
    crosses what the splits still lack. The running sum is one window per hash bucket over the sums of earlier buckets,
    so no task sees more than a bucket.
    """
    spark = units.sparkSession
    h = F.xxhash64("relation", "unit")
    units = cut_lineage(units.select("relation", "unit", F.col("weight").cast("double").alias("weight"), h.alias("_h"), F.pmod(h, F.lit(BUCKETS)).alias("_b")))
    sums = units.groupBy("relation", "_b").agg(F.sum("weight").alias("w"))  # at most BUCKETS rows a relation
    totals = {r["relation"]: r["w"] for r in sums.groupBy("relation").agg(F.sum("w").alias("w")).collect()}
    if not totals:
        return units.select("relation", "unit", F.lit(None).cast("string").alias("assigned"))
    limit = F.element_at(F.create_map(*[x for r, w in totals.items() for x in (F.lit(r), F.lit(w * large))]), F.col("relation"))
    big = units.filter(F.col("weight") > limit).select("relation", "unit", "weight").collect()
    lacks = {r: {s: share * w for s, share in shares} for r, w in totals.items()}
    dealt = []
    for row in sorted(big, key=lambda x: (x["relation"], -x["weight"], x["unit"])):
        lack = lacks[row["relation"]]
        to = max(lack, key=lambda s: (lack[s], -[k for k, _ in shares].index(s)))
        lack[to] -= row["weight"]
        dealt.append((row["relation"], row["unit"], to))
    small = units.filter(F.col("weight") <= limit)
    before = (
        small.groupBy("relation", "_b").agg(F.sum("weight").alias("w"))
        .withColumn("_before", F.coalesce(F.sum("w").over(Window.partitionBy("relation").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .drop("w")
    )
    within = F.sum("weight").over(Window.partitionBy("relation", "_b").orderBy("_h", "unit").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = []
    for relation, lack in lacks.items():
        rest = {s: max(0.0, x) for s, x in lack.items()}
        scale = (totals[relation] - sum(b["weight"] for b in big if b["relation"] == relation)) / (sum(rest.values()) or 1.0)
        at = 0.0
        for s, _ in shares:
            at += rest[s] * scale
            cuts.append((relation, s, at))
    names = [s for s, _ in shares]
    choice = F.lit(names[-1])
    for s in reversed(names[:-1]):
        edge = F.element_at(F.create_map(*[x for r, k, at in cuts if k == s for x in (F.lit(r), F.lit(at))]), F.col("relation"))
        choice = F.when(F.col("_mid") <= edge, F.lit(s)).otherwise(choice)
    rest_rows = (
        small.join(before, ["relation", "_b"])
        .withColumn("_mid", F.col("_before") + within - F.col("weight") / 2)
        .select("relation", "unit", choice.alias("assigned"))
    )
    return rest_rows.unionByName(spark.createDataFrame(dealt, "relation string, unit string, assigned string"))


def assign_splits(recs: DataFrame, shares: Sequence[tuple[str, float]] = SHARES) -> DataFrame:
    """(relation, id, unit, assigned): every record with the split of its unit."""
    pairs = cut_lineage(recs.select("relation", "origin_key", "owner_key").distinct())
    placed = cut_lineage(with_units(recs, pair_units(pairs)).select("relation", "id", "unit"))
    chosen = split_by_weight(placed.groupBy("relation", "unit").agg(F.count("*").alias("weight")), shares)
    return skew_join(placed, chosen, ["relation", "unit"]).select("relation", "id", "unit", "assigned")


# --------------------------------------------------------------------------------------------------- queries


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_units(records(spark, sf_dir))


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_splits(records(spark, sf_dir))


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and share of each new split per relation."""
    a = assign_splits(records(spark, sf_dir)).groupBy("relation", "assigned").agg(F.count("*").alias("n"), F.countDistinct("unit").alias("units"))
    total = F.sum("n").over(Window.partitionBy("relation"))
    return a.withColumn("share", F.round(F.col("n") / total, 6))
