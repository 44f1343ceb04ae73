"""Filling containers of fixed capacity (problem 7) by pattern packing with non-negative least squares.

Only the histogram of sizes, at most ``capacity`` rows, is gathered; all decisions are made on it:

1. A document above the capacity is cut into full containers and a rest; all others stay whole.
2. Sizes are rounded to CLASSES classes. Patterns of one to MOST classes that fill a container are enumerated and their repeat
   counts fitted to the class histogram by non-negative least squares (active set, numpy). A class that the fit would use beyond its supply
   gets more weight, and the fit is made again; counts are rounded down.
3. Each pattern takes exact sizes from its classes, the last one to fit the room, as runs: every run uses up one size, so there are few. What is left is fitted again,
   until a fit places nothing.
4. Residuals, and the room that runs left over, are packed by best fit, largest first, again in runs.

The fit is tried with all and with part of its repeat counts, since the more patterns there are the fewer documents are left for the gaps; of the plans
within SLACK of the fewest containers the one with most patterns is kept.

The plan is a table of runs: (size, first rank, count, first container, copies per container, by pattern). Documents are numbered within their size
over all partitions, so a size that a third of the documents share is spread like any other, and meet their run by
a join on the size and block of ranks.

Defined results: empty and null texts have size 0 and go to container 0 with what else is there (container 0 alone if all are
empty); ties of size go by partition and place; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm.bpe import TOKENIZERS, encoded
from assayer.runtime import cut_lineage, table

CAPACITY = 2048
CLASSES, MOST = 32, 8
SLACK = 1.001
GAP = 0  # room that a pattern may leave
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25)  # of the fitted repeat counts


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|: active set with a least-squares step on the passive columns. Raises if the conditions of the optimum are not met."""
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(30 * max(1, *a.shape)):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if not w[j] > tol:
            return x
        passive[j] = True
        while True:
            k = np.flatnonzero(passive)
            s = np.linalg.lstsq(a[:, k], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[k] = s
                break
            bad = s <= 0
            if j in k[bad] and x[j] == 0 and w[j] < 1e3 * tol:  # a column that rounding alone called for
                return x * ~(np.arange(len(x)) == j)
            step = float(np.min(x[k][bad] / np.maximum(x[k][bad] - s[bad], 1e-300)))
            x[k] += step * (s - x[k])
            passive[k[x[k] <= 1e-12]] = False
            x[~passive] = 0
    raise ArithmeticError("non-negative least squares did not reach its optimum")


def patterns(classes: int, allowed: list[int], most: int = MOST) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``most`` of the allowed classes whose sum is ``classes``."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], rest: int, at: int) -> None:
        if rest == 0:
            out.append(head)
            return
        if len(head) == most:
            return
        for k in range(at, len(down)):
            c = down[k]
            if c * (most - len(head)) < rest:
                return
            if c <= rest:
                grow((*head, c), rest - c, k)

    down = sorted(allowed, reverse=True)
    grow((), classes, 0)
    return out


def bounded_fit(a: np.ndarray, supply: np.ndarray) -> np.ndarray:
    """Repeat counts by least squares whose use of a class stays near its supply: classes used beyond it weigh more in the next fit."""
    weight = 1 / np.sqrt(np.maximum(supply, 1))
    for _ in range(12):
        x = nnls(a * weight[:, None], supply * weight)
        over = a @ x > supply * 1.01 + 0.5
        if not over.any():
            break
        weight[over] *= 2
    use = a @ x
    return x * min(1.0, float(np.min(np.where(use > 0, (supply + 0.5) / np.maximum(use, 1e-9), 1.0)))) if (use > 1.25 * supply + 1).any() else x


def _take(shape: tuple[int, ...], pools: dict[int, list[int]], left: dict[int, int], capacity: int, grain: int) -> dict[int, int] | None:
    """Exact sizes for a pattern, largest class first: of each class the size nearest to its middle; the last two, which may be one class off, fill the room best."""
    take: dict[int, int] = {}
    room = capacity
    free = lambda s: left.get(s, 0) > take.get(s, 0)
    near = lambda c: [s for k in (c, c + 1, c - 1) for s in pools.get(k, ()) if s <= room and free(s)]
    for c in shape[:-2] if len(shape) > 2 else ():
        can = [s for s in pools[c] if s <= room and free(s)]
        if not can:
            return None
        s = min(can, key=lambda x: (abs(x - c * grain), x))
        take[s] = take.get(s, 0) + 1
        room -= s
    if len(shape) == 1:
        can = near(shape[0])
        return {max(can): 1} if can and capacity - max(can) <= GAP else None
    last = near(shape[-1])
    best = None
    for s in near(shape[-2]):
        take[s] = take.get(s, 0) + 1
        rest = room - s
        fit = rest if rest in left and free(rest) and abs(rest - shape[-1] * grain) <= 2 * grain else max((x for x in last if x <= rest and free(x)), default=0)
        take[s] -= 1
        if fit and (best is None or s + fit > best[0]):
            best = s + fit, s, fit
            if best[0] == room:
                break
    if best is None or room - best[0] > GAP:
        return None
    for s in best[1:]:
        take[s] = take.get(s, 0) + 1
    return {s: k for s, k in take.items() if k}


def plan(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES) -> tuple[list[tuple[int, int, int, int, int, bool]], int]:
    """Runs (size, first rank, count, first container, copies per container, by pattern) and the number of containers: the largest of SHARES whose plan is within SLACK of the fewest containers."""
    plans = [_plan(histogram, capacity, classes, share) for share in SHARES]
    enough = SLACK * min(n for _, n in plans)
    return next(x for x in plans if x[1] <= enough)


def _plan(histogram: dict[int, int], capacity: int, classes: int, share: float) -> tuple[list[tuple[int, int, int, int, int, bool]], int]:
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    if not left:
        return [], 0
    grain = max(1, -(-capacity // classes))
    top = capacity // grain
    of = lambda s: max(1, min(top, (2 * s + grain) // (2 * grain)))
    pools: dict[int, list[int]] = defaultdict(list)
    for s in sorted(left):
        pools[of(s)].append(s)
    shapes = patterns(top, sorted(pools))
    a = np.zeros((top + 1, len(shapes)))
    for j, p in enumerate(shapes):
        for c in p:
            a[c, j] += 1
    bins: list[list] = []  # [count, {size: copies}, room, {size: copies by pattern}]
    placed = bool(shapes)
    while placed:
        placed = False
        target = np.array([float(sum(left[s] for s in pools[c])) if c in pools else 0.0 for c in range(top + 1)])
        use = (target > 0) | ~a.any(1)
        cols = np.flatnonzero(~(a[~use] > 0).any(0)) if (~use).any() else np.arange(len(shapes))
        if not len(cols):
            break
        repeat = np.floor(share * bounded_fit(a[:, cols], target) + 1e-9).astype(int)
        for k in np.argsort(-repeat, kind="stable"):
            want = int(repeat[k])
            while want > 0 and (take := _take(shapes[cols[k]], pools, left, capacity, grain)):
                times = min([want, *(left[s] // n for s, n in take.items())])
                for s, n in take.items():
                    left[s] -= n * times
                bins.append([times, dict(take), capacity - sum(s * n for s, n in take.items()), dict(take)])
                want -= times
                placed = True
        if share < 1:
            break
    # Best fit of the residuals, largest first; open containers by room.
    open_: dict[int, list[list]] = defaultdict(list)
    for b in bins:
        open_[b[2]].append(b)
    rooms = sorted(r for r, v in open_.items() if v and r > 0)
    done: list[list] = open_.pop(0, [])


    def add(b: list) -> None:
        if b[2] == 0:
            done.append(b)
            return
        if not open_[b[2]]:
            bisect.insort(rooms, b[2])
        open_[b[2]].append(b)

    for s in sorted(left, reverse=True):
        while left[s] > 0:
            k = bisect.bisect_left(rooms, s)
            if k == len(rooms):
                each = capacity // s
                if left[s] >= each:
                    times = left[s] // each
                    left[s] -= times * each
                    add([times, {s: each}, capacity - each * s, {}])
                else:
                    add([1, {s: left[s]}, capacity - left[s] * s, {}])
                    left[s] = 0
                continue
            room = rooms[k]
            b = open_[room].pop()
            if not open_[room]:
                rooms.pop(k)
            each = min(room // s, max(1, left[s] // b[0]))
            times = min(b[0], left[s] // each)
            left[s] -= times * each
            if times < b[0]:
                add([b[0] - times, dict(b[1]), room, b[3]])
            more = dict(b[1])
            more[s] = more.get(s, 0) + each
            add([times, more, room - each * s, b[3]])
    done += [b for v in open_.values() for b in v]
    runs, rank, container = [], defaultdict(int), 0
    for times, take, _, first in done:
        for s, k in sorted(take.items()):
            for each, by_pattern in ((first.get(s, 0), True), (k - first.get(s, 0), False)):
                if each:
                    runs.append((s, rank[s], times * each, container, each, by_pattern))
                    rank[s] += times * each
        container += times
    return runs, container


BLOCK = 4096


def packed(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """(key, piece, n_tokens, container, by_pattern): every document, or every piece of one above the capacity."""
    spark = sizes.sparkSession
    sizes = cut_lineage(sizes.select(F.col(key).alias("k"), F.col(size).cast("bigint").alias("n")))
    numbered = cut_lineage(sizes.withColumn("part", F.spark_partition_id()))
    rest = F.when(F.col("n") <= capacity, F.col("n")).otherwise(F.pmod("n", F.lit(capacity)))
    numbered = numbered.withColumn("full", F.when(F.col("n") > capacity, F.floor(F.col("n") / capacity)).otherwise(F.lit(0)).cast("bigint")).withColumn("rest", rest)
    per = numbered.groupBy("rest", "part").agg(F.count("*").alias("c"), F.sum("full").alias("f"))
    per = cut_lineage(per)
    histogram = {r["rest"]: r["c"] for r in per.groupBy("rest").agg(F.sum("c").alias("c")).collect()}  # at most capacity + 1 rows
    runs, containers = plan(histogram, capacity)
    # Ranks within a size: offset of the partition, then place within it. Both windows are bounded: a size has one row
    # a partition here, and a partition holds a bounded slice of the documents.
    off = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("rest", "part", F.coalesce(F.sum("c").over(off), F.lit(0)).alias("_from"))
    fulls = per.groupBy("part").agg(F.sum("f").alias("f"))
    full_from = fulls.select("part", F.coalesce(F.sum("f").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_full"))
    at = Window.partitionBy("part", "rest").orderBy("k")
    ranked = (
        numbered.join(starts, ["rest", "part"])
        .withColumn("rank", F.col("_from") + F.row_number().over(at) - 1)
        .withColumn("block", F.floor(F.col("rank") / BLOCK))
    )
    rows = spark.createDataFrame(runs, "size bigint, first bigint, count bigint, container bigint, each bigint, by_pattern boolean")
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.col("count") - 1) / BLOCK))))
    small = ranked.join(rows, (F.col("rest") == F.col("size")) & (ranked["block"] == rows["block"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count")), "left")
    rests = small.filter("rest > 0 OR full = 0").select(
        F.col("k").alias(key),
        F.col("full").alias("piece"),
        F.col("rest").alias("n_tokens"),
        F.when(F.col("rest") == 0, F.lit(0)).otherwise(F.col("container") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).cast("bigint").alias("container"),
        F.coalesce("by_pattern", F.lit(False)).alias("by_pattern"),
    )
    run = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        numbered.filter("full > 0")
        .withColumn("_before", F.coalesce(F.sum("full").over(run), F.lit(0)))
        .join(full_from, "part")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("full") - 1)))
        .select(F.col("k").alias(key), "piece", F.lit(capacity).cast("bigint").alias("n_tokens"), (F.lit(containers) + F.col("_full") + F.col("_before") + F.col("piece")).cast("bigint").alias("container"), F.lit(False).alias("by_pattern"))
    )
    return rests.unionByName(cut)


def p7_packing(spark: SparkSession, sf_dir: str, capacity: int = CAPACITY, tokenizers: str = TOKENIZERS) -> DataFrame:
    return packed(encoded(table(spark, sf_dir, "documents"), tokenizers=tokenizers, counts=True), capacity=capacity)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, the fewest that could do, pieces, tokens, the share of pieces placed by patterns and the share of unused room."""
    p = p7_packing(spark, sf_dir)
    per = p.groupBy("container").agg(F.sum("n_tokens").alias("load"), F.count("*").alias("pieces"), F.count_if("by_pattern").alias("placed"))
    return per.agg(
        F.count("*").alias("containers"),
        F.ceil(F.sum("load") / CAPACITY).alias("least"),
        F.sum("pieces").alias("pieces"),
        F.sum("load").alias("tokens"),
        F.max("load").alias("fullest"),
        F.round(F.sum("placed") / F.sum("pieces"), 6).alias("by_pattern"),
        F.round(1 - F.sum("load") / (F.count("*") * CAPACITY), 6).alias("unused"),
    )
