"""Percentiles of very large numeric columns by dyadic Count-sketches (problem 2).

A measurement v >= 0 is encoded by the top bits of its double: 11 exponent and MANTISSA mantissa bits, so its code keeps the
order and gives v back within 2 ** -(MANTISSA + 1) of itself. For every binary resolution j of the codes a signed
Count-sketch of ROWS x WIDTH counters counts the prefixes ``code >> j``; resolutions of at most TOP prefixes keep
exact counters, all derived from the one of exactly TOP. A sketch is an integer array, so sketches merge by addition
(partitions, days, models) and deletions subtract. A rank is inverted from the coarsest resolution down: at each
node the estimated count of the lower half says whether to go left or right.

A sketch is a linear function of the vector of code counts, so until it is inverted or stored that vector stands for it: partitions ship counts
added up per (group, code), which is never more than a sketch's size of 2 ** LEVELS numbers and mostly far less, and sketches are made where they meet.

Error: at each of the LEVELS - log2(TOP) sketched resolutions a node's count is off by at most
about sqrt(F2 / WIDTH) (median of ROWS), F2 being the sum of squared prefix counts; ``rank_bound`` reads three
standard deviations of their sum off the sketch itself. WIDTH keeps that bound below WANTED for the measures here, ties and zeros included.

Scale: rows become counts of (group, code) with a partial aggregate before the only wide shuffle, so a group that holds a
third of all rows is at most 2 ** LEVELS counts wide; then each group's counts go to one task as a stream.

Defined results: null, NaN and negative values are no measurements; zero is one; infinity is the largest code and reads
back as infinity; a group without measurements has no row; repeated rows count as often as they are delivered only if
their key differs (see ``measurements``); an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.neardup import groups_of
from assayer.runtime import table

MANTISSA = 7
LEVELS = 11 + MANTISSA
TOP_BITS = 12
TOP = 1 << TOP_BITS
HASHED = LEVELS - TOP_BITS  # resolutions 0 .. HASHED - 1 are sketched, HASHED is exact
ROWS = 5
WIDTH = 4096  # chosen for a rank error of at most WANTED
WANTED = 0.01
HEAVIEST = 64
SIZE = HASHED * ROWS * WIDTH + TOP
QS = (0.5, 0.9, 0.95, 0.99)
GROUPS = 32  # sketches held at once
MEASURES = ("latency_ms", "ttfd_ms", "tokens")
# Odd multipliers of the multiply-shift hashes, drawn once from a seeded generator; part of the sketch's format.
_RNG = np.random.default_rng(20240607)
MUL = _RNG.integers(1, 1 << 62, size=(HASHED, ROWS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def encode(v: np.ndarray) -> np.ndarray:
    return (np.asarray(v, np.float64) + 0.0).view(np.int64) >> (52 - MANTISSA)


def decode(code: np.ndarray) -> np.ndarray:
    """The middle of the code's values; exactly 0 for the code of zero."""
    low = (np.asarray(code, np.int64) << (52 - MANTISSA)).view(np.float64)
    high = ((np.asarray(code, np.int64) + 1) << (52 - MANTISSA)).view(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        return np.where(code == 0, 0.0, np.where(np.isfinite(high), low + (high - low) / 2, low))


def _slots(prefix: np.ndarray, level: int, row: int) -> tuple[np.ndarray, np.ndarray]:
    x = prefix.astype(np.uint64)
    mixed = x * MUL[level, row, 0]
    mixed ^= mixed >> np.uint64(29)
    mixed *= MUL[level, row, 1]
    slot = (mixed >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)
    sign = 1 - 2 * ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
    return slot, sign


def build(group: np.ndarray, code: np.ndarray, count: np.ndarray, groups: int) -> np.ndarray:
    """Sketches of ``groups`` groups, one per row, from (group, code, signed count)."""
    out = np.zeros((groups, SIZE), np.int64)
    for level in range(HASHED):
        prefix = code >> level
        for row in range(ROWS):
            slot, sign = _slots(prefix, level, row)
            base = (level * ROWS + row) * WIDTH
            out[:, base : base + WIDTH] += np.bincount(group * WIDTH + slot, weights=sign * count, minlength=groups * WIDTH).reshape(groups, WIDTH).astype(np.int64)
    out[:, HASHED * ROWS * WIDTH :] += np.bincount(group * TOP + (code >> HASHED), weights=count, minlength=groups * TOP).reshape(groups, TOP).astype(np.int64)
    return out


def total(sketch: np.ndarray) -> np.ndarray:
    return sketch[:, HASHED * ROWS * WIDTH :].sum(1)


def estimate(sketch: np.ndarray, level: int, prefix: np.ndarray) -> np.ndarray:
    """Count of one prefix per sketch."""
    g = np.arange(len(sketch))
    if level == HASHED:
        return sketch[g, HASHED * ROWS * WIDTH + prefix]
    got = np.empty((ROWS, len(sketch)), np.int64)
    for row in range(ROWS):
        slot, sign = _slots(prefix, level, row)
        got[row] = sign * sketch[g, (level * ROWS + row) * WIDTH + slot]
    return np.median(got, axis=0)


def invert(sketch: np.ndarray, q: float) -> np.ndarray:
    """Codes of the values of nearest rank ceil(q n)."""
    n = total(sketch)
    rank = np.maximum(1, np.ceil(q * n - 1e-9))
    exact = np.cumsum(sketch[:, HASHED * ROWS * WIDTH :], axis=1)
    node = np.minimum((exact < rank[:, None]).sum(1), TOP - 1)
    g = np.arange(len(sketch))
    inside = sketch[g, HASHED * ROWS * WIDTH + node].astype(np.float64)
    rank = rank - (exact[g, node] - inside)
    for level in range(HASHED - 1, -1, -1):
        # Both halves are estimated and made to add up to the node's count, which halves the error.
        low, high = estimate(sketch, level, 2 * node), estimate(sketch, level, 2 * node + 1)
        low = np.clip((low + inside - high) / 2, 0, inside)
        right = rank > low
        rank = np.where(right, rank - low, rank)
        inside = np.where(right, inside - low, low)
        node = 2 * node + right
    return node


def rank_bound(sketch: np.ndarray) -> np.ndarray:
    """Bound of the rank error as a share of n: 3 standard deviations of the sum over resolutions, whose hashes are independent.

    Averaging both halves of a node leaves F2 / (2 WIDTH) of variance a resolution. The HEAVIEST counters are left out of F2: a median of five rows
    goes wrong by one of them only if three rows put it on the same counter, a chance of about 10 (HEAVIEST / WIDTH) ** 3.
    """
    n = np.maximum(total(sketch), 1)
    var = np.zeros(len(sketch))
    for level in range(HASHED):
        rows = sketch[:, level * ROWS * WIDTH : (level + 1) * ROWS * WIDTH].reshape(len(sketch), ROWS, WIDTH).astype(np.float64)
        rest = np.partition(rows**2, WIDTH - HEAVIEST, axis=2)[:, :, : WIDTH - HEAVIEST].sum(2)
        var += np.median(rest, axis=1) / (2 * WIDTH)
    return np.minimum(3 * np.sqrt(var) / n, 1.0)


def pack(sketch: np.ndarray) -> bytes:
    """Non-zero counters of one sketch: gaps of their places, then values, in the least integer types."""
    at = np.flatnonzero(sketch)
    head = np.array([len(at)], np.int32).tobytes()
    return zlib.compress(head + np.diff(at, prepend=0).astype(np.uint32).tobytes() + sketch[at].astype(np.int64).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    out = np.zeros(SIZE, np.int64)
    out[np.cumsum(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64))] = np.frombuffer(raw[4 + 4 * n :], np.int64, n)
    return out


# --------------------------------------------------------------------------------------------------- Spark


def _percent_columns(sketch: np.ndarray) -> list[pa.Array]:
    return [pa.array(decode(invert(sketch, q))) for q in QS] + [pa.array(rank_bound(sketch))]


PERCENTS = "p50 double, p90 double, p95 double, p99 double, rank_bound double"


def _sketcher(keys: Sequence[str], what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in groups_of(batches, ["gid"]):
            for lo in range(0, len(starts), GROUPS):
                s = starts[lo : lo + GROUPS]
                end = starts[lo + GROUPS] if lo + GROUPS < len(starts) else t.num_rows
                part = t.slice(s[0], end - s[0])
                group = np.repeat(np.arange(len(s)), np.diff(np.append(s, end)))
                sketch = build(group, np.asarray(part["code"]).astype(np.int64), np.asarray(part["count"]), len(s))
                own = [part[k].take(pa.array(s - s[0])).combine_chunks() for k in keys]
                if what == "percents":
                    cols, names = _percent_columns(sketch), ["p50", "p90", "p95", "p99", "rank_bound"]
                else:
                    cols, names = [pa.array([pack(x) for x in sketch], pa.binary())], ["sketch"]
                yield pa.RecordBatch.from_arrays([*own, pa.array(total(sketch)), *cols], names=[*keys, "n", *names])

    return run


def _code(v: Column) -> Column:
    """``encode`` in Spark: exponent by the base-2 logarithm, put right by one where that rounds; then the mantissa's top bits."""
    e = F.floor(F.log2(v)).cast("int")
    e = F.when(F.pow(F.lit(2.0), e) > v, e - 1).when(F.pow(F.lit(2.0), e + 1) <= v, e + 1).otherwise(e)
    normal = ((e + 1023).cast("bigint") * (1 << MANTISSA)) + F.floor((v / F.pow(F.lit(2.0), e) - 1) * (1 << MANTISSA)).cast("bigint")
    tiny = F.floor(v / F.lit(2.0**-1022) * (1 << MANTISSA)).cast("bigint")
    return (
        F.when(v == float("inf"), F.lit(2047 << MANTISSA))
        .when(v < 2.0**-1022, tiny)
        .when(v > 2.0**1023, (F.lit(2046) * (1 << MANTISSA) + F.floor((v / F.lit(2.0**1023) - 1) * (1 << MANTISSA))).cast("bigint"))
        .otherwise(normal)
        .cast("int")
    )


def sketched(counted: DataFrame, keys: Sequence[str], what: str = "percents") -> DataFrame:
    """One row per group: keys, n and either the percentiles or the packed sketch."""
    gid = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys])
    kinds = ", ".join(f"`{k}` {counted.schema[k].dataType.simpleString()}" for k in keys)
    c = counted.withColumn("gid", gid)
    ordered = c.repartition(int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gid").sortWithinPartitions("gid", *keys)
    return ordered.mapInArrow(_sketcher(list(keys), what), f"{kinds}, n bigint, " + (PERCENTS if what == "percents" else "sketch binary"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Percentiles of coarser groups from packed sketches, added up per partition before the shuffle and after it."""
    kinds = ", ".join(f"`{k}` {sketches.schema[k].dataType.simpleString()}" for k in keys)

    def add(final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, np.ndarray] = {}

            def flush() -> Iterator[pa.RecordBatch]:
                if not held:
                    return
                names = list(keys)
                rows = list(held)
                cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
                stack = np.stack([held[r] for r in rows])
                tail = _percent_columns(stack) if final else [pa.array([pack(x) for x in stack], pa.binary())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(total(stack)), *tail], names=[*names, "n", *(["p50", "p90", "p95", "p99", "rank_bound"] if final else ["sketch"])])
                held.clear()

            types = None
            last = None
            for b in batches:
                types = [b.schema.field(k).type for k in keys]
                ks = list(zip(*[b[k].to_pylist() for k in keys], strict=True)) if keys else [()] * b.num_rows
                for k, data in zip(ks, b["sketch"].to_pylist(), strict=True):
                    if k != last and len(held) >= GROUPS and k not in held:
                        yield from flush()
                    last = k
                    x = unpack(data)
                    if k in held:
                        held[k] += x
                    else:
                        held[k] = x
            yield from flush()

        return run

    cols = [*keys, "sketch"]
    part = sketches.select(*cols).sortWithinPartitions(*keys).mapInArrow(add(False), f"{kinds}, n bigint, sketch binary").select(*cols)
    return part.repartition(int(part.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys).mapInArrow(add(True), f"{kinds}, n bigint, {PERCENTS}")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, day, measure, code, count). A redelivered row repeats pos and content, so a pos counts once, and a null pos once per hash of the content without the arrival."""
    t = table(spark, sf_dir, "predictions")
    content = F.when(F.col("pos").isNull(), F.xxhash64(F.to_json(F.struct(*[c for c in t.columns if c != "arrived_at"]))))
    own = t.select("pos", content.alias("content"), "model", F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros("recorded_at") / F.lit(86_400_000_000)).cast("int")).alias("day"), *[F.col(m).cast("double").alias(m) for m in MEASURES])
    own = own.groupBy("pos", "content").agg(F.min(F.struct("model", "day", *MEASURES)).alias("r")).select("r.*")
    codes = [F.when((F.col(m) >= 0) & ~F.isnan(m), _code(F.col(m))).alias(m) for m in MEASURES]
    long = own.select("model", "day", *codes).select(
        "model", "day", F.explode(F.create_map(*[x for m in MEASURES for x in (F.lit(m), F.col(m))])).alias("measure", "code")
    )
    return long.filter("code IS NOT NULL").groupBy("model", "day", "measure", "code").agg(F.count("*").alias("count"))


DAY = ("model", "day", "measure")


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model, UTC day and measure: n, p50, p90, p95, p99 and the bound of the rank error."""
    return sketched(measurements(spark, sf_dir), DAY)


def p2_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per model and month, from the sketches of days."""
    days = sketched(measurements(spark, sf_dir), DAY, "sketch").withColumn("month", F.trunc("day", "month"))
    return merged(days, ("model", "month", "measure"))


def p2_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per measure over all models and days, from the sketches of days."""
    return merged(sketched(measurements(spark, sf_dir), DAY, "sketch"), ("measure",))
