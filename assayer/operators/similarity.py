"""Exact set-similarity join by prefix filtering, as DataFrame operations only.

Two sets of Jaccard similarity >= t share a token among their n - ceil(t n) + 1 rarest. Equal sets collapse to classes first, so
copies cost nothing; rare-first prefixes keep frequent tokens out of the join; every candidate is counted out on the sets.

Rare-first needs the frequencies of frequent tokens only: the HEAVY most frequent are broadcast, a list of bounded size, and all others stand before them
in the order of their text. A token with more than BLOCK cells is split: its left cells over salts, its right cells to each salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.runtime import cut_lineage

HEAVY = 1 << 16
BLOCK = 8192


def prefix_pairs(left: DataFrame, right: DataFrame, key: str, tokens: str, p: int = 4, q: int = 5, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(left key, right key) of rows whose token sets have similarity p / q or more, as l_key and r_key; empty sets match nothing.

    Cells carry the set's size and the token's place. Sets of n and m tokens must share o = ceil(p (n + m) / (p + q)); the first shared
    token stands at a place of at most n - o and m - o, which drops most cell pairs in the join itself.
    """

    def classes(df: DataFrame) -> DataFrame:
        named = df.filter(F.size(tokens) > 0).select(F.col(key).alias("key"), F.array_sort(tokens).alias("set"))
        return named.withColumn("sid", F.md5(F.concat_ws("\x1f", "set")))

    own = {"l": classes(left), "r": classes(right)}
    sided = own["l"].select("sid", "set", F.lit(1).alias("side")).unionByName(own["r"].select("sid", "set", F.lit(2).alias("side")))
    sets = cut_lineage(sided.groupBy("sid").agg(F.first("set").alias("set"), F.bit_or("side").alias("side")))  # the set is a function of sid
    cell = sets.select("sid", F.size("set").alias("n"), "side", F.explode("set").alias("token"))
    common = F.broadcast(cell.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").orderBy(F.desc("df"), "token").limit(heavy))
    known = cell.join(common, "token", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    ranked = known.groupBy("sid", "n", "side").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order"))  # a set's own tokens
    keep = (F.col("n") - F.ceil(F.col("n") * p / q - F.lit(1e-9)) + 1).cast("int")
    cells = cut_lineage(ranked.select("sid", "n", "side", F.posexplode(F.slice("order", F.lit(1), keep)).alias("at", "x")).select("sid", "n", "side", "at", "x.token", "x.df"))
    salts = F.greatest(F.ceil(F.col("df") / block), F.lit(1)).cast("int")
    side = lambda k, bit, salt: cells.filter(F.col("side").bitwiseAND(bit) > 0).select("token", salt.alias("salt"), *[F.col(c).alias(f"{k}_{c}") for c in ("sid", "n", "at")])
    fits = (p + q) * F.least(F.col("l_n") - F.col("l_at"), F.col("r_n") - F.col("r_at")) >= p * (F.col("l_n") + F.col("r_n"))
    pairs = side("l", 1, F.pmod(F.xxhash64("sid"), salts).cast("int")).join(side("r", 2, F.explode(F.sequence(F.lit(0), salts - 1))), ["token", "salt"])
    maybe = pairs.filter(fits).select("l_sid", "r_sid").distinct()
    for k in "lr":
        maybe = maybe.join(sets.select(F.col("sid").alias(f"{k}_sid"), F.col("set").alias(f"{k}_set")), f"{k}_sid")
    both = F.size(F.array_intersect("l_set", "r_set"))
    near = maybe.filter((p + q) * both >= p * (F.size("l_set") + F.size("r_set"))).select("l_sid", "r_sid")
    for k in "lr":
        near = near.join(own[k].select(F.col("sid").alias(f"{k}_sid"), F.col("key").alias(f"{k}_key")), f"{k}_sid")
    return near.select("l_key", "r_key")


def leakage_pairs(left: DataFrame, right: DataFrame, key: str, normal: str, words: str, shingles: str) -> DataFrame:
    """(l_key, r_key, how): exact, else shingle sets, else word sets of at least four words, at 4 / 5."""
    exact = left.select(F.col(key).alias("l_key"), F.col(normal).alias("n")).join(right.select(F.col(key).alias("r_key"), F.col(normal).alias("n")), "n").filter("n != ''").select("l_key", "r_key", F.lit(1).alias("how"))
    by_shingle = prefix_pairs(left, right, key, shingles).withColumn("how", F.lit(2))
    enough = lambda df: df.filter(F.size(words) >= 4)
    by_word = prefix_pairs(enough(left), enough(right), key, words).withColumn("how", F.lit(3))
    best = exact.unionByName(by_shingle).unionByName(by_word).groupBy("l_key", "r_key").agg(F.min("how").alias("how"))
    return best.withColumn("how", F.element_at(F.array(F.lit("exact"), F.lit("shingle"), F.lit("words")), F.col("how")))
