"""Groups of near-duplicate records (problem 1) by a blocked sparse product of document by token incidence.

1. Records with the same set of words collapse into one class, so copies never meet each other.
2. The columns (tokens) get one global order, rare first: the HEAVY most frequent tokens by exact frequency, before them all
   others, by hash. The list is bounded; a token outside it holds less than 1 / HEAVY of the cells.
3. For sets of n <= m words to share p/q of their union they must share o(n, m) = ceil(p (n + m) / (p + q)) words, and at least
   SHARED of them (fewer only if the sets are that small) among the first n - o + SHARED words of either. Only such cells of the
   incidence matrix enter the product.
4. A column with more cells than BLOCK is cut into square blocks, so a column that a third of the documents share
   is spread over tasks; frequencies of columns outside the list that need blocks are joined. Within a block the product is an outer sum in numpy
   over the partners of a row's sizes only: a cell pair goes on when sizes and places allow o, and when the bit sketches of both sets allow it
   (a common word sets a common bit; a set of n words with k bits loses at most n - k of them to collisions).
5. The counts of a pair are added up over all blocks. Behind its prefixes either set has o - SHARED words, so a pair whose sum
   stays below SHARED is discarded. All bounds are exact: no pair is lost.
6. The pairs that are left are counted out on the sets themselves; components come from random-mate contraction.

Defined results: records without words belong to no group; below MIN_DISTINCT distinct words only equal word sequences are
near; repeated rows count once per id; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.contraction import components
from assayer.llm.records import records, with_words
from assayer.llm.skew import hot_keys, skew_join
from assayer.runtime import cut_lineage, release

P, Q = 7, 10
HEAVY = 1 << 16
BLOCK = 8192
SHARED = 2
SKETCH_WORDS = (4, 8, 16)  # 64-bit words of a sketch: the least that has three bits a word of the mean set
LEFT, RIGHT = 1, 2  # sides of a class; in one collection every class is on both
CELLS = "token bigint, role int, side int, cls bigint, n int, at int, lost int, df bigint, sketch binary"
PAIRS = "a bigint, b bigint, n int, m int, shared bigint"


def set_classes(recs: DataFrame) -> DataFrame:
    """(relation, set_key, cls, tokens): one row per distinct set of at least MIN_DISTINCT words."""
    own = recs.filter("set_key IS NOT NULL").select("relation", "set_key", F.transform("tokens", lambda t: F.xxhash64("relation", t)).alias("tokens"))
    return cut_lineage(own.groupBy("relation", "set_key").agg(F.first("tokens").alias("tokens")).withColumn("cls", F.monotonically_increasing_id()))


@dataclass
class Order:
    """The heaviest tokens, ascending, with their exact frequencies; every other token has at most ``below``."""

    tokens: np.ndarray
    df: np.ndarray
    below: int
    words: int = SKETCH_WORDS[0]

    def frequency(self, tokens: np.ndarray) -> np.ndarray:
        """Exact for a token of the list, 0 for any other."""
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.df[at], 0)


def token_frequencies(classes: DataFrame) -> DataFrame:
    return classes.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def token_order(classes: DataFrame, heavy: int = HEAVY) -> Order:
    """The ``heavy`` most frequent tokens that more than one class has; a bounded list whatever the size of the corpus."""
    rows = token_frequencies(classes).filter("df > 1").orderBy(F.desc("df"), "token").limit(heavy).toPandas()
    token, df = rows["token"].to_numpy(np.int64), rows["df"].to_numpy(np.int64)
    by = np.argsort(token)
    mean = classes.agg(F.avg(F.size("tokens")).alias("n")).first()["n"] or 0
    words = next((w for w in SKETCH_WORDS if 64 * w >= 3 * mean), SKETCH_WORDS[-1])
    return Order(token[by], df[by], int(df.min()) if len(df) == heavy else 1, words)


def ordered_tokens(tokens: pa.Array, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat tokens, rare first within each row, with their row, place, frequency and the rows' lengths."""
    off = np.asarray(tokens.offsets)
    flat = np.asarray(tokens.flatten())
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    freq = order.frequency(flat)
    by = np.lexsort((flat, freq, row))
    at = np.arange(len(flat)) - np.repeat(off[:-1] - off[0], n)
    return flat[by], row, at, freq[by], n


def sketches(flat: np.ndarray, n: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """A bit set of each row's tokens, and how many tokens fell on a bit that was taken."""
    bit = (flat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (words * 64).bit_length() + 1)
    start = np.concatenate(([0], np.cumsum(n)[:-1]))
    one = np.left_shift(np.uint64(1), bit & np.uint64(63))
    out = np.zeros((len(n), words), np.uint64)
    if len(flat):
        for w in range(words):
            out[:, w] = np.bitwise_or.reduceat(np.where(bit >> np.uint64(6) == w, one, np.uint64(0)), start)
    return out, n - np.bitwise_count(out).sum(1).astype(np.int64)


def probe_length(n: np.ndarray) -> np.ndarray:
    """Words of the larger of two sets of which SHARED must be common: n - ceil(p n / q) + SHARED."""
    return np.minimum(n, n + (-P * n // Q) + SHARED)


def index_length(n: np.ndarray) -> np.ndarray:
    """The same for the smaller set, whose partner is at least as large."""
    return np.minimum(n, n + (-2 * P * n // (P + Q)) + SHARED)


def cells(order: Order):
    """mapInArrow: classes (cls, side, tokens) to the cells of the incidence matrix that can belong to a pair; role 3 is in both prefixes, 2 in the longer one only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, side = np.asarray(batch["cls"]), np.asarray(batch["side"])
            flat, row, at, freq, n = ordered_tokens(batch["tokens"], order)
            sketch, lost = sketches(flat, n, order.words)
            keep = np.flatnonzero(at < probe_length(n)[row])
            role = np.where(at[keep] < index_length(n)[row[keep]], 3, 2)
            for lo in range(0, len(keep), 200_000):
                k = keep[lo : lo + 200_000]
                r = row[k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat[k]), pa.array(role[lo : lo + 200_000].astype(np.int32)), pa.array(side[r].astype(np.int32)), pa.array(cls[r]), pa.array(n[r].astype(np.int32)), pa.array(at[k].astype(np.int32)), pa.array(lost[r].astype(np.int32)), pa.array(freq[k]),
                        pa.FixedSizeBinaryArray.from_buffers(pa.binary(order.words * 8), len(r), [None, pa.py_buffer(np.ascontiguousarray(sketch[r]))]).cast(pa.binary()),
                    ],
                    names=["token", "role", "side", "cls", "n", "at", "lost", "df", "sketch"],
                )

    return run


def blocked(cell: DataFrame, classes: DataFrame, order: Order, block: int = BLOCK) -> DataFrame:
    """Cells with their block (bi, bj): (0, 0), or a row of blocks as smaller set (role 1) and a column of blocks as larger one (role 2)."""
    if order.below > block:  # else every column outside the list fits one block
        known = classes.sparkSession.createDataFrame([(int(t),) for t in order.tokens], "token bigint")
        middle = token_frequencies(classes).filter(F.col("df") > block).join(F.broadcast(known), "token", "left_anti")  # at most HEAVY rows are broadcast
        cell = cell.join(middle.withColumnRenamed("df", "_df"), "token", "left").withColumn("df", F.coalesce("_df", "df")).drop("_df")
    wide = F.greatest(F.ceil(F.col("df") / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("cls", F.lit(3)), F.col("wide")).cast("int")
    each = F.sequence(F.lit(0), F.col("wide") - 1)
    struct = lambda bi, bj, role: F.struct(bi.alias("bi"), bj.alias("bj"), role.alias("r"))
    zero = F.lit(0)
    spread = F.concat(
        F.when(F.col("role") == 3, F.transform(each, lambda k: struct(F.col("own"), k, F.lit(1)))).otherwise(F.array().cast("array<struct<bi:int,bj:int,r:int>>")),
        F.transform(each, lambda k: struct(k, F.col("own"), F.lit(2))),
    )
    at = F.when(F.col("wide") == 1, F.array(struct(zero, zero, F.col("role")))).otherwise(spread)
    return cell.withColumn("wide", wide).withColumn("own", own).withColumn("_at", F.explode(at)).select("token", "_at.bi", "_at.bj", F.col("_at.r").alias("role"), "side", "cls", "n", "at", "lost", "sketch")


def groups_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' starts, from batches sorted by key; holds one open group at most."""
    open_: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([open_, t]) if open_ is not None else t
        cols = [np.asarray(t[k]) for k in key]
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield t.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        open_ = t.slice(starts[-1])
    if open_ is not None:
        yield open_.combine_chunks(), np.zeros(1, np.int64)


DENSE = 1 << 12
CHUNK = 500_000


def placed_pairs(x: np.ndarray, y: np.ndarray, n: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells (i of x, j of y) of one column with n[i] <= n[j] whose sizes and places allow the overlap, and no others.

    Rows of one size meet their partners in the order of size, along which the need grows, so each row's partners are a prefix: the work is
    that of the pairs that come out.
    """
    if len(x) * len(y) <= DENSE:
        nx, ny = n[x][:, None], n[y][None]
        ok = (P * (nx + ny) <= (P + Q) * (np.minimum(nx - at[x][:, None], ny - at[y][None]) + (SHARED - 1))) & (nx <= ny) & (Q * nx >= P * ny)
        i, j = np.nonzero(ok)
        yield x[i], y[j]
        return
    x, y = x[np.argsort(n[x], kind="stable")], y[np.argsort(n[y], kind="stable")]
    nx, ny, ry = n[x], n[y], n[y] - at[y]
    starts = np.flatnonzero(np.append(True, nx[1:] != nx[:-1]))
    for lo, hi in zip(starts, np.append(starts[1:], len(x)), strict=True):
        size = int(nx[lo])
        frm, to = np.searchsorted(ny, size, "left"), np.searchsorted(ny, Q * size // P, "right")
        need = -(-P * (size + ny[frm:to]) // (P + Q)) - (SHARED - 1)
        can = np.flatnonzero(ry[frm:to] >= need)
        times = np.searchsorted(need[can], size - at[x[lo:hi]], "right")
        total = np.cumsum(times)
        while lo < hi:  # bounded pieces
            k = max(1, int(np.searchsorted(total, CHUNK, "right")))
            t = times[:k]
            i = np.repeat(x[lo : lo + k], t)
            yield i, y[frm + can[np.arange(len(i)) - np.repeat(np.cumsum(t) - t, t)]]
            lo, times = lo + k, times[k:]
            total = total[k:] - (total[k - 1] if k else 0)


def sided(x: np.ndarray, y: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of x and y whose cells are of different sides; together all such pairs, each once, and no pair of one side is met."""
    sx, sy = side[x], side[y]
    for a, b in ((sx & LEFT > 0, sy & RIGHT > 0), (sx == RIGHT, sy & LEFT > 0), (sx == LEFT | RIGHT, sy == LEFT)):
        if a.any() and b.any():
            yield x[a], y[b]


CACHED = 1 << 14  # pairs whose sketches fit a core's cache


def common_bits(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits that the sketches of i and j share; the counts of a pair are added as lanes of one number."""
    both = sketch[i]
    both &= sketch[j]
    wide = np.uint32 if sketch.shape[1] == 4 else np.uint64
    bits = 8 * np.dtype(wide).itemsize
    v = np.bitwise_count(both).view(wide)
    even, lanes = wide(0x00FF00FF00FF00FF & ((1 << bits) - 1)), wide(0x0001000100010001 & ((1 << bits) - 1))
    v = ((v & even) + ((v >> wide(8)) & even)) * lanes >> wide(bits - 16)
    return (v[:, 0] if v.shape[1] == 1 else v.sum(1)).astype(np.int32)


def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over cells sorted by column block: pairs of classes of different sides that every bound allows, with the number of shared cells met here."""
    for t, starts in groups_of(batches, ["token", "bi", "bj"]):
        ends = np.append(starts[1:], t.num_rows)
        role, side, n, at, lost = (np.asarray(t[c]).astype(np.int32) for c in ("role", "side", "n", "at", "lost"))
        cls = np.asarray(t["cls"])
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(t.num_rows, -1)
        left, right = [], []
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
            g = np.arange(a, b)
            x, y = g[role[g] & 1 > 0], g[role[g] & 2 > 0]
            if not len(x) or not len(y):
                continue
            for i, j in (ij for xs, ys in sided(x, y, side) for ij in placed_pairs(xs, ys, n, at)):
                for lo in range(0, len(i), CACHED):
                    ic, jc = i[lo : lo + CACHED], j[lo : lo + CACHED]
                    good = (P + Q) * (common_bits(sketch, ic, jc) + np.minimum(lost[ic], lost[jc])) >= P * (n[ic] + n[jc])
                    ic, jc = ic[good], jc[good]
                    once = (n[ic] < n[jc]) | (cls[ic] < cls[jc])
                    left.append(ic[once])
                    right.append(jc[once])
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            pair, first, times = np.unique(np.stack([cls[x], cls[y]]), axis=1, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(n[x[first]]), pa.array(n[y[first]]), pa.array(times)], names=["a", "b", "n", "m", "shared"])


def least_shared() -> F.Column:
    """What two sets of n <= m words must share in the first n - o + SHARED and m - o + SHARED words: o - SHARED can stand behind either."""
    return F.least(F.lit(SHARED), F.ceil(P * (F.col("n") + F.col("m")) / F.lit(P + Q) - F.lit(1e-9)))


def near_classes(classes: DataFrame, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of classes, one of them LEFT and the other RIGHT, whose sets share P / Q of their union.

    ``classes`` has cls and tokens; without a column ``side`` every class is on both sides.
    """
    spark = classes.sparkSession
    if "side" not in classes.columns:
        classes = classes.withColumn("side", F.lit(LEFT | RIGHT))
    order = token_order(classes, heavy)
    cell = blocked(classes.select("cls", "side", "tokens").mapInArrow(cells(order), CELLS), classes, order, block)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    met = cell.repartition(parts, "token", "bi", "bj").sortWithinPartitions("token", "bi", "bj").mapInArrow(product, PAIRS)
    maybe = cut_lineage(met.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sum("shared").alias("shared")).filter(F.col("shared") >= least_shared()).select("a", "b"))
    sets = lambda k: classes.select(F.col("cls").alias(k), F.col("tokens").alias(f"t{k}"))
    both = F.size(F.array_intersect("ta", "tb"))
    whole = skew_join(skew_join(maybe, sets("a"), ["a"]), sets("b"), ["b"], hot=hot_keys(maybe, ["b"]))
    return whole.filter((P + Q) * both >= P * (F.size("ta") + F.size("tb"))).select("a", "b")


def members(recs: DataFrame, classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(relation, id, cls, group_id) of every record with words."""
    comp = components(edges).select(F.col("node").alias("cls"), "component")
    grouped = classes.select("relation", "set_key", "cls").join(comp, "cls", "left").select("relation", "set_key", "cls", F.coalesce("component", "cls").alias("component"))
    return (
        skew_join(recs.filter(F.size("seq") > 0).select("relation", "id", "seq_key", "set_key"), grouped, ["relation", "set_key"], "left")
        .select("relation", "id", "cls", F.coalesce(F.concat(F.lit("g"), F.col("component").cast("string")), F.concat(F.lit("s"), "seq_key")).alias("group_id"))
    )


def near_groups(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members as above, and the near pairs of classes."""
    recs = cut_lineage(with_words(recs).select("relation", "id", "seq", "seq_key", "set_key", "tokens"))
    classes = set_classes(recs)
    edges = cut_lineage(near_classes(classes))
    out = cut_lineage(members(recs, classes, edges))
    for done in (recs, classes):
        release(done)
    return out, edges


GROUP_BLOCK = 4096


def pairs_within(m: DataFrame, block: int = GROUP_BLOCK) -> DataFrame:
    """(relation, left_id, right_id) of all pairs of a group. A group above ``block`` members is cut into square blocks of them, so that no task gets more than block^2 pairs of a group."""
    sizes = m.groupBy("relation", "group_id").agg(F.count("*").alias("_size")).filter("_size > 1").withColumn("_blocks", F.ceil(F.col("_size") / block).cast("int"))
    g = skew_join(m.select("relation", "group_id", "id"), sizes, ["relation", "group_id"]).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    each = F.sequence(F.lit(0), F.col("_blocks") - 1)
    left = g.select("relation", "group_id", F.col("id").alias("left_id"), F.col("_own").alias("_i"), F.explode(each).alias("_j"))
    right = g.select("relation", "group_id", F.col("id").alias("right_id"), F.explode(each).alias("_i"), F.col("_own").alias("_j"))
    return left.join(right, ["relation", "group_id", "_i", "_j"]).filter("left_id < right_id").select("relation", "left_id", "right_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, edges = near_groups(records(spark, sf_dir))
    release(edges)
    return pairs_within(m)


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with words: its group, and to how many records it is near directly."""
    m, edges = near_groups(records(spark, sf_dir))
    m = m.withColumn("own", F.coalesce(F.col("cls").cast("string"), "group_id"))
    size = m.groupBy("relation", "own").agg(F.count("*").alias("copies"))
    of = size.select(F.col("own").alias("b"), F.col("copies").alias("nb"))
    both = edges.union(edges.select("b", "a")).select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    links = both.join(of, "b").groupBy(F.col("a").alias("own")).agg(F.sum("nb").alias("others"))
    per = size.join(links, "own", "left").select("relation", "own", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    names = m.groupBy("relation", "group_id").agg(F.min("id").alias("group_name"), F.count("*").alias("group_size"))
    return m.join(per, ["relation", "own"]).join(names, ["relation", "group_id"]).select("relation", "id", F.col("group_name").alias("group_id"), "group_size", "n_links")
