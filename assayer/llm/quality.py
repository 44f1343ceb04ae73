"""Text quality statistics (problem 8) and a boosted-tree judgement of what is natural prose.

``p8_stats`` computes plain statistics with built-in expressions. ``p8_found`` gives the statistics of ``shape``, which need no language and read
every text whole, to gradient-boosted trees (histogram splits, logistic loss, numpy). The trees are fitted on weak labels: what several independent
``voters`` say of a sample. No voter's output is an input of the trees. Probabilities are calibrated by Platt scaling on documents
drawn by hash and judged by reading (``holdout.DRAWN``).

The sample is the SAMPLE documents with the smallest hashes of their key, at any size of the table: the first pass reads keys only and keeps
the smallest per task. Voters run on the sample alone, so all else is one pass of vectorised counting.

Defined results: null, empty and blank texts are no cases and have null ratios; n_chars is counted, never read from the table; repeated texts
get equal results; an empty table gives an empty result; other columns are ignored; where the sample has fewer than LEAST labelled texts of a class,
the texts of ``holdout.WRITTEN`` join it, so a table of one class is judged too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.holdout import DRAWN, WRITTEN
from assayer.llm.shape import NAMES, shapes
from assayer.llm.voters import WORDS, weak_label
from assayer.runtime import table

SAMPLE = 8_000
LEAST = 40

# ------------------------------------------------------------------------------------------------ boosted trees

BINS, DEPTH, TREES, RATE, LAMBDA = 32, 3, 60, 0.2, 1.0


def fit_trees(x: np.ndarray, y: np.ndarray) -> list:
    """Trees as (feature, threshold, leaf values) of complete depth-DEPTH trees; the first element is the base score."""
    if not len(x) or y.min() == y.max():
        return [0.0 if not len(x) else (4.0 if y[0] else -4.0)]
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    model: list = [base]
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        levels = []
        for depth in range(DEPTH):
            k = 1 << depth
            gain = np.full((k, x.shape[1], BINS), -np.inf)
            for f in range(x.shape[1]):
                key = node * BINS + binned[:, f]
                gs = np.bincount(key, g, k * BINS).reshape(k, BINS).cumsum(1)
                hs = np.bincount(key, h, k * BINS).reshape(k, BINS).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                s = gs**2 / (hs + LAMBDA) + (gt - gs) ** 2 / (ht - hs + LAMBDA) - gt**2 / (ht + LAMBDA)
                s[(hs < 1) | (ht - hs < 1)] = -np.inf
                gain[:, f, : len(cuts[f])] = s[:, : len(cuts[f])]
            best = gain.reshape(k, -1).argmax(1)
            feature, at = best // BINS, best % BINS
            none = ~np.isfinite(gain.reshape(k, -1).max(1))
            threshold = np.array([np.inf if none[i] else cuts[feature[i]][at[i]] for i in range(k)])
            levels.append((feature, threshold))
            node = 2 * node + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = -np.bincount(node, g, 1 << DEPTH) / (np.bincount(node, h, 1 << DEPTH) + LAMBDA) * RATE
        score += leaf[node]
        model.append((levels, leaf))
    return model


def raw_score(model: list, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), float(model[0]))
    for levels, leaf in model[1:]:
        node = np.zeros(len(x), np.int64)
        for feature, threshold in levels:
            node = 2 * node + (x[np.arange(len(x)), feature[node]] > threshold[node])
        out += leaf[node]
    return out


def platt(score: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a score + b))), with Platt's smoothed targets; a ridge towards (1, 0) and halved steps keep both finite."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    home = np.array([1.0, 0.0])
    m = np.stack([score, np.ones_like(score)], 1)

    def loss(w: np.ndarray) -> float:
        z = m @ w
        return float(np.sum(np.logaddexp(0, z) - t * z) + 0.5 * np.sum((w - home) ** 2))

    w = home.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        grad = m.T @ (p - t) + (w - home)
        step = np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return float(w[0]), float(w[1])


def fit_quality(x: np.ndarray, label: np.ndarray) -> tuple[list, float, float]:
    """Trees over the shapes of weakly labelled texts, and their calibration on DRAWN.

    The rows of the rarer class are repeated up to the number of the other, so that the cuts and the least leaf weight hold for any mixture.
    """
    if min(label.sum(), (1 - label).sum()) < LEAST:
        x, label = np.concatenate([x, shapes([t for t, _ in WRITTEN])]), np.concatenate([label, [float(k) for _, k in WRITTEN]])
    own = [np.flatnonzero(label == k) for k in (0, 1)]
    even = np.concatenate([np.resize(k, max(map(len, own))) for k in own])
    model = fit_trees(x[even], label[even])
    return model, *platt(raw_score(model, shapes([t for t, _ in DRAWN])), np.array([float(k) for _, k in DRAWN]))


def probability(fitted: tuple[list, float, float], x: np.ndarray) -> np.ndarray:
    model, a, b = fitted
    return 1 / (1 + np.exp(-(a * raw_score(model, x) + b)))


def fitting_sample(docs: DataFrame, key: str, text: str, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapes and weak labels of the ``sample`` documents whose keys have the smallest hashes; repeated keys count once."""
    h = F.xxhash64(F.col(key), F.lit(8))
    least = docs.select(h.alias("h")).orderBy("h").limit(sample).agg(F.max("h").alias("h")).first()["h"]
    if least is None:
        return np.zeros((0, len(NAMES))), np.zeros(0)
    chosen = docs.select(h.alias("h"), F.col(text).alias("t")).filter((F.col("h") <= least) & F.col("t").rlike(r"\S")).dropDuplicates(["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            label = [weak_label(t) for t in texts]
            keep = [i for i, y in enumerate(label) if y is not None]
            rows = pa.array(shapes([texts[i] for i in keep]).astype(np.float32).ravel())
            x = pa.FixedSizeListArray.from_arrays(rows, len(NAMES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), x, pa.array([label[i] for i in keep], pa.float64())], names=["h", "x", "y"])

    rows = sorted((r["h"], r["y"], r["x"]) for r in chosen.mapInArrow(run, "h bigint, x array<float>, y double").collect())
    return np.array([r[2] for r in rows], np.float64).reshape(-1, len(NAMES)), np.array([r[1] for r in rows])


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(key, p): calibrated probability that a document with words is not prose; null and blank documents are left out."""
    fitted = docs.sparkSession.sparkContext.broadcast(fit_quality(*fitting_sample(docs, key, text, sample)))  # at most TREES trees of 2 ** DEPTH leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            p = [probability(fitted.value, shapes(texts[lo : lo + 256]).astype(np.float32).astype(np.float64)) for lo in range(0, len(texts), 256)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(p) if p else np.zeros(0))], names=[key, "p"])

    own = docs.select(F.col(key), F.col(text)).filter(F.col(text).rlike(r"\S"))
    return own.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, p double")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).filter("p >= 0.5").select("doc_id")


def p8_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id", F.round("p", 6).alias("p_junk"))


def text_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Plain statistics with built-in expressions; words are runs of a-z0-9, so other scripts count as letters only."""
    t = F.coalesce(F.col(text), F.lit(""))
    common = F.array(*[F.lit(w) for w in sorted(WORDS) if w.isascii()])
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\r", ""))) > 0)
    d = docs.select(F.col(key).alias("k"), t.alias("t"))
    d = d.withColumn("w", F.regexp_extract_all(F.lower("t"), F.lit("[a-z0-9]+"), F.lit(0))).withColumn("l", lines).withColumn("n", F.length("t"))
    share = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    return d.select(
        F.col("k").alias(key),
        F.col("n").cast("bigint").alias("chars"),
        F.size("w").cast("bigint").alias("words"),
        share(F.length(F.array_join("w", "")), F.size("w")).alias("mean_word_length"),
        share(F.length(F.regexp_replace("t", r"[\p{L}\p{N} \t\r\n]", "")), F.col("n")).alias("symbol_ratio"),
        share(F.size(F.filter("l", lambda x: x.rlike(r"[.!?:][ \t\r]*$"))), F.size("l")).alias("line_end_share"),
        share(F.size(F.filter("w", lambda x: F.array_contains(common, x))), F.size("w")).alias("common_share"),
    )


def p8_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_stats(table(spark, sf_dir, "documents"))


def p8_stats_sql() -> str:
    common = ", ".join("'" + w + "'" for w in sorted(WORDS) if w.isascii())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, t, length(t) AS n, regexp_extract_all(lower(t), '[a-z0-9]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: length(trim(replace(replace(x, chr(9), ''), chr(13), ''))) > 0) AS l FROM d)
SELECT doc_id, n::BIGINT AS chars, len(w)::BIGINT AS words,
  CASE WHEN len(w) > 0 THEN round(length(array_to_string(w, ''))::DOUBLE / len(w), 6) END AS mean_word_length,
  CASE WHEN n > 0 THEN round(length(regexp_replace(t, '[\p{{L}}\p{{N}} \t\r\n]', '', 'g'))::DOUBLE / n, 6) END AS symbol_ratio,
  CASE WHEN len(l) > 0 THEN round(len(list_filter(l, lambda x: regexp_matches(x, '[.!?:][ \t\r]*$')))::DOUBLE / len(l), 6) END AS line_end_share,
  CASE WHEN len(w) > 0 THEN round(len(list_filter(w, lambda x: list_contains([{common}], x)))::DOUBLE / len(w), 6) END AS common_share
FROM e"""
