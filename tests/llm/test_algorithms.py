import base64
import itertools
import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import bpe, consensus, contraction, neardup, overlap, packing, quantiles, skew
from assayer.llm import records as R
from assayer.llm.fmindex import FMIndex

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
RECS = "relation string, id string, text string, split string, origin string, origin_key string, owner_key string"


def recs(spark, rows):
    """rows: id, text, split[, origin, owner]; a column whose name clashes with an inner one rides along."""
    full = [("seed_entries", r[0], r[1], r[2], *(r[3:4] or [None]), *(r[3:4] or [None]), *(r[4:5] or [None])) for r in rows]
    return spark.createDataFrame(full, RECS).withColumn("cls", F.lit(1)).withColumn("tokens", F.lit("x"))


def word_list(t):
    return re.findall("[a-z0-9]+", (t or "").lower())


def near(a, b):
    x, y = set(a), set(b)
    return bool(a) and bool(b) and (a == b or (min(len(x), len(y)) >= 6 and 10 * len(x & y) >= 7 * len(x | y)))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(40)]
    out = [None, "", "  ?!", "one two", "One, two!", "two one", "a b c d e f", "A b c d e f."]
    for _ in range(25):
        base = list(rng.choice(vocabulary, rng.integers(6, 25)))
        for _ in range(rng.integers(1, 4)):
            t = [w for w in base if rng.random() > 0.1]
            rng.shuffle(t)
            out.append(" ".join(t))
    out += ["hot words stand here in every single copy"] * 30  # a third of the rows
    out.append(" ".join(f"long{i}" for i in range(3000)))
    return out


def test_near_groups_equal_brute_force(spark, texts):
    df = recs(spark, [(f"i{k:03d}", t, "train") for k, t in enumerate(texts)]).drop("cls", "tokens")
    m, _ = neardup.near_groups(df)
    got = {r["id"]: r["group_id"] for r in m.collect()}
    ws = {f"i{k:03d}": word_list(t) for k, t in enumerate(texts)}
    assert set(got) == {k for k, w in ws.items() if w}
    parent = {k: k for k in got}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(got), 2):
        if near(ws[a], ws[b]):
            parent[find(a)] = find(b)
    for a, b in itertools.combinations(sorted(got), 2):
        assert (got[a] == got[b]) == (find(a) == find(b)), (ws[a], ws[b])


def test_near_groups_of_an_empty_table(spark):
    m, edges = neardup.near_groups(recs(spark, []).drop("cls", "tokens"))
    assert m.count() == 0 and edges.count() == 0


@pytest.mark.parametrize(("heavy", "block"), [(1 << 16, 8192), (1 << 16, 16), (8, 16), (1, 4)])
def test_blocks_lose_no_pair(spark, heavy, block):
    """Columns within a block, columns of the list and columns outside it that are cut into blocks."""
    rng = np.random.default_rng(2)
    rows = [(i, sorted({int(x) for x in rng.integers(0, 25, 18)} | {1000 + i} if i % 3 else {int(x) for x in rng.integers(0, 25, 18)})) for i in range(150)]
    classes = spark.createDataFrame(rows, "cls bigint, tokens array<bigint>")
    near_pair = {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if 10 * len(set(x) & set(y)) >= 7 * len(set(x) | set(y))}
    got = [tuple(sorted(r)) for r in neardup.near_classes(classes, heavy, block).collect()]
    assert len(got) == len(set(got)) and set(got) == near_pair and near_pair
    sided = classes.withColumn("side", F.when(F.col("cls") % 3 == 0, neardup.LEFT).when(F.col("cls") % 3 == 1, neardup.RIGHT).otherwise(3))
    side = {i: (1, 2, 3)[i % 3] for i, _ in rows}
    got = [tuple(sorted(r)) for r in neardup.near_classes(sided, heavy, block).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in near_pair if side[a] | side[b] == 3}


def test_counts_of_a_pair_are_added_up(spark):
    """Pairs that share one prefix word only are discarded before their sets are met."""
    rows = [(0, list(range(10))), (1, list(range(9)) + [50]), (2, [0] + list(range(60, 69)))]
    classes = spark.createDataFrame(rows, "cls bigint, tokens array<bigint>").withColumn("side", F.lit(3))
    order = neardup.token_order(classes)
    cell = neardup.blocked(classes.select("cls", "side", "tokens").mapInArrow(neardup.cells(order), neardup.CELLS), classes, order)
    met = cell.repartition(3, "token", "bi", "bj").sortWithinPartitions("token", "bi", "bj").mapInArrow(neardup.product, neardup.PAIRS).groupBy("a", "b").agg(F.sum("shared").alias("s")).collect()
    assert {tuple(sorted((r["a"], r["b"]))) for r in met if r["s"] >= neardup.SHARED} == {(0, 1)}


def test_pairs_of_a_large_group(spark):
    m = spark.createDataFrame([("r", f"i{k:03d}", "g" if k < 90 else f"h{k}") for k in range(100)], "relation string, id string, group_id string")
    got = [tuple(r)[1:] for r in neardup.pairs_within(m, block=7).collect()]
    assert len(got) == len(set(got)) and set(got) == set(itertools.combinations([f"i{k:03d}" for k in range(90)], 2))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, how):
    left = spark.createDataFrame([("a" if k % 3 else None if k % 7 == 0 else f"k{k % 5}", k) for k in range(200)], "k string, x int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("k1", 3), ("z", 4), (None, 5)], "k string, y int")
    hot = skew.hot_keys(left, ["k"], over=20)
    assert hot[0] == ("a", 7)
    assert sorted(map(repr, skew.skew_join(left, right, ["k"], how, over=20).collect())) == sorted(map(repr, left.join(right, ["k"], how).collect()))


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7), (500, 501)]
    e = spark.createDataFrame([*pairs, (None, 1)], "a bigint, b bigint").withColumn("mate", F.lit(0)).withColumn("node", F.lit(0))
    got = {r["node"]: r["component"] for r in contraction.components(e).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    assert set(got) == {x for a, b in pairs if a != b for x in (a, b)}
    groups = {(find(x), got[x]) for x in got}
    assert len(groups) == len({g for g, _ in groups}) == len({g for _, g in groups})


def test_components_of_no_edges(spark):
    assert contraction.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_units_and_splits(spark):
    rows = [("1", "x", "train", "s", "a"), ("2", "x", None, None, "a"), ("3", "x", "test", "s", None), ("4", "x", "test", "t", "b"), ("5", "x", "train", None, None), ("6", "x", "test", None, None)]
    rows += [(f"h{i}", "x", "train", "hub", None) for i in range(40)]
    df = recs(spark, rows)
    assert {r["id"] for r in contraction.broken_units(df).collect()} == {"1", "2", "3"}
    a = contraction.assign_splits(df).collect()
    assert len(a) == len(rows) and len({(r["unit"], r["assigned"]) for r in a}) == len({r["unit"] for r in a})
    assert contraction.broken_units(df.limit(0)).count() == 0 and contraction.assign_splits(df.limit(0)).count() == 0


def test_shares_of_many_units(spark):
    u = spark.createDataFrame([("r", f"u{i}", 1 + i % 3) for i in range(3000)], "relation string, unit string, weight bigint")
    got = contraction.split_by_weight(u).join(u, ["relation", "unit"]).groupBy("assigned").agg(F.sum("weight").alias("w")).collect()
    total = sum(r["w"] for r in got)
    assert {r["assigned"]: round(r["w"] / total, 2) for r in got} == {"train": 0.7, "validation": 0.15, "test": 0.15}


@pytest.mark.parametrize(("over", "words"), [(100_000, 1 << 17), (3, 40)])
def test_overlaps_equal_brute_force(spark, texts, monkeypatch, over, words):
    """With the defaults, and with tiny shards, several streams a shard and salted keys."""
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (over,))
    monkeypatch.setattr(overlap, "SHARD_WORDS", words)
    monkeypatch.setattr(overlap, "STREAM_WORDS", words)
    inner = "the quick old pump was shut by nobody at noon"
    rows = [(f"i{k:03d}", t, ("train", "test", "validation", None)[k % 4]) for k, t in enumerate(texts)]
    rows += [("c1", inner, "test"), ("c2", f"we heard that {inner} and left", "train"), ("c3", f"we heard that {inner.replace('old', 'new')} and left", "train"), ("c4", inner, None)]
    got = {(r["train_id"], r["eval_id"]) for r in overlap.overlaps(recs(spark, rows).drop("cls", "tokens")).collect()}
    want = set()
    for a, x, s in rows:
        for b, y, t in rows:
            if s == "train" and t in ("test", "validation"):
                u, v = word_list(x), word_list(y)
                if near(u, v) or (len(v) >= 8 and f" {' '.join(v)} " in f" {' '.join(u)} "):
                    want.add((a, b))
    assert got == want and ("c2", "c1") in got


def test_overlap_counts_equal_the_pairs_without_making_them(spark, texts, monkeypatch):
    inner = "the quick old pump was shut by nobody at noon"
    rows = [(f"i{k:03d}", t, ("train", "test", "validation", None)[k % 4]) for k, t in enumerate(texts)]
    rows += [("c1", inner, "test"), ("c2", f"we heard that {inner} and left", "train"), ("c3", f"{inner} now", "train"), ("c4", "one two", "train"), ("c5", "One two", "test")]
    df = recs(spark, rows).drop("cls", "tokens")
    want = Counter(r["eval_id"] for r in overlap.overlaps(df).collect())
    monkeypatch.setattr(overlap, "overlaps", None)
    monkeypatch.setattr(overlap, "records", lambda *_: df)
    got = overlap.overlap_counts(df).collect()
    assert {r["id"]: r["pairs"] for r in got} == dict(want) and len(got) == len(want) and want["c1"] == 2
    report = overlap.p4_report(spark, "").collect()
    assert sum(r["pairs"] for r in report) == sum(want.values()) and sum(r["found"] for r in report) == len(want)


def test_overlaps_of_an_empty_table(spark):
    assert overlap.overlaps(recs(spark, []).drop("cls", "tokens")).count() == 0


def test_index_finds_whole_texts_and_runs():
    rng = np.random.default_rng(0)
    for _ in range(40):
        known = list({tuple(map(int, rng.integers(1, 4, rng.integers(1, 6)))) for _ in range(5)})
        asked = [tuple(map(int, rng.integers(1, 5, rng.integers(1, 14)))) for _ in range(4)]
        fm = FMIndex(np.concatenate([np.array(x) for x in known]), np.array([len(x) for x in known]))
        flat, n = np.concatenate([np.array(x) for x in asked]), np.array([len(x) for x in asked])
        q, s = fm.whole_matches(flat, n, 2)
        assert set(zip(q.tolist(), s.tolist(), strict=True)) == {(i, j) for i, x in enumerate(asked) for j, y in enumerate(known) if len(y) >= 2 and any(x[k : k + len(y)] == y for k in range(len(x)))}
        start = np.cumsum(n) - n
        want = sorted(start[i] + k + 2 for i, x in enumerate(asked) for k in range(len(x) - 2) if any(x[k : k + 3] == y[m : m + 3] for y in known for m in range(len(y) - 2)))
        assert fm.ends_of_matches(flat, n, 3).tolist() == want


def test_index_is_a_few_bytes_a_symbol():
    rng = np.random.default_rng(1)
    fm = FMIndex(rng.integers(0, 4000, 1 << 16), np.full(1 << 8, 1 << 8))
    assert fm.nbytes < 3 * fm.n


def test_texts_that_share_a_run_share_a_minimizer():
    rng = np.random.default_rng(7)
    for _ in range(50):
        run = rng.integers(0, 1 << 40, overlap.LEAST_WORDS)
        a, b = (np.concatenate([rng.integers(0, 9, rng.integers(0, 20)), run, rng.integers(0, 9, rng.integers(0, 20))]) for _ in range(2))
        at, key = overlap.minimizers(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert set(key[at < len(a)]) & set(key[at >= len(a)])
    assert len(overlap.minimizers(np.arange(14), np.array([7, 7]))[0]) == 0


def test_spans_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(12)]
    evals = [" ".join(rng.choice(vocabulary, 20)) for _ in range(12)]
    trains = []
    for k in range(40):
        a, b = rng.choice(evals, 2)
        trains.append(" ".join([*rng.choice(vocabulary, k % 5), *a.split()[k % 7 : 8 + k % 11], *rng.choice(vocabulary, k % 3), *b.split()[2 : 9 + k % 4]]))
    df = recs(spark, [(f"e{k}", t, "test") for k, t in enumerate(evals)] + [(f"t{k}", t, "train") for k, t in enumerate(trains)] + [("c", trains[0], "train")]).drop("cls", "tokens")
    runs = {tuple(w[k : k + 8]) for w in map(str.split, evals) for k in range(len(w) - 7)}
    want = {}
    for k, t in [*enumerate(trains), ("c", trains[0])]:
        w = t.split()
        covered = [False] * len(w)
        last, n = -1, 0
        for i in range(len(w) - 7):
            if tuple(w[i : i + 8]) in runs:
                n += i > last
                last = i + 8
                covered[i : i + 8] = [True] * 8
        if n:
            want[k if k == "c" else f"t{k}"] = (n, sum(covered))
    for streams in (overlap.STREAM_WORDS, 50):
        monkeypatch.setattr(overlap, "STREAM_WORDS", streams)
        monkeypatch.setattr(overlap, "SHARD_WORDS", streams)
        assert {r["id"]: (r["spans"], r["covered"]) for r in overlap.spans(df).collect()} == want
    assert overlap.spans(df.limit(0)).count() == 0


def test_quantiles_merge_delete_and_stay_within_bounds():
    rng = np.random.default_rng(1)
    a, b = np.exp(rng.normal(4, 1.5, 20000)), np.concatenate([np.zeros(500), np.full(3000, 7.0), np.exp(rng.normal(2, 1, 4000)), [1e300, np.inf]])
    sketch = lambda v, sign=1: quantiles.build(np.zeros(len(v), np.int64), quantiles.encode(v), np.full(len(v), sign), 1)
    both = sketch(a) + sketch(b)
    assert (both == sketch(np.concatenate([a, b]))).all() and ((both + sketch(b, -1)) == sketch(a)).all()
    assert (quantiles.unpack(quantiles.pack(both[0])) == both[0]).all()
    s = np.sort(np.concatenate([a, b]))
    for q in quantiles.QS:
        v = quantiles.decode(quantiles.invert(both, q))[0]
        low, high = np.searchsorted(s, v * (1 - 2**-7), "left") / len(s), np.searchsorted(s, v * (1 + 2**-7), "right") / len(s)
        assert low - quantiles.rank_bound(both)[0] <= q <= high + quantiles.rank_bound(both)[0]
    code = quantiles.encode(np.array([0.0, 5e-324, 1e-310, 1.0, 1.0078125, 1e308, np.inf]))
    assert (np.diff(code) >= 0).all() and quantiles.decode(code)[0] == 0 and np.isinf(quantiles.decode(code)[-1])


def test_ranks_of_all_rows_against_the_exact_ones(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    exact = {m: np.sort([r[0] for r in spark.read.parquet(f"{SF}/predictions.parquet").dropDuplicates(["pos"]).select(F.col(m).cast("double")).filter(f"{m} >= 0 AND NOT isnan({m})").collect()]) for m in quantiles.MEASURES}
    for query in (quantiles.p2_whole, quantiles.p2_percentiles):
        assert query(spark, SF).agg(F.max("rank_bound")).first()[0] <= quantiles.WANTED
    for r in quantiles.p2_whole(spark, SF).collect():
        v = exact[r["measure"]]
        assert r["n"] == len(v)
        for q in quantiles.QS:
            x = r[f"p{int(100 * q)}"]
            low, high = np.searchsorted(v, x * (1 - 2**-7), "left") / len(v), np.searchsorted(v, x * (1 + 2**-7), "right") / len(v)
            assert low - r["rank_bound"] <= q <= high + r["rank_bound"]


def test_codes_in_spark_equal_numpy(spark):
    rng = np.random.default_rng(3)
    v = [0.0, 1e-310, 2.0**-1022, 0.1, 1.0, 2.0, 1023.999, 2.0**1023, 1.7e308, float("inf"), *map(float, np.exp(rng.normal(0, 20, 2000)))]
    got = [r["c"] for r in spark.createDataFrame([(x,) for x in v], "v double").select(quantiles._code(F.col("v")).alias("c")).collect()]
    assert got == quantiles.encode(np.array(v)).tolist()


def test_sketched_groups(spark):
    rows = [("a", c, n) for c, n in Counter(quantiles.encode(np.arange(1.0, 101.0)).tolist()).items()] + [(None, int(quantiles.encode(np.array([5.0]))[0]), 1)]
    c = spark.createDataFrame(rows, "k string, code int, count bigint")
    got = {r["k"]: r for r in quantiles.sketched(c, ("k",)).collect()}
    assert got["a"]["n"] == 100 and abs(got["a"]["p50"] - 50) < 1 and got[None]["n"] == 1
    merged = quantiles.merged(quantiles.sketched(c, ("k",), "sketch").withColumn("all", F.lit("x")), ("all",)).collect()
    assert merged[0]["n"] == 101
    assert quantiles.sketched(c.limit(0), ("k",)).count() == 0


def test_measurements_without_pos_are_kept_apart(spark, tmp_path):
    rows = [(1, "a", 5.0, 1), (1, "a", 5.0, 2), (None, "m", 5.0, 1), (None, "m", 5.0, 2), (None, "m", 7.0, 1), (None, "n", 5.0, 1)]
    df = spark.createDataFrame(rows, "pos bigint, model string, latency_ms double, day int").select(
        "pos", "model", "latency_ms", F.lit(None).cast("double").alias("ttfd_ms"), F.lit(None).cast("bigint").alias("tokens"), F.lit("2020-01-01").cast("timestamp").alias("recorded_at"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")).cast("timestamp").alias("arrived_at")
    )
    df.write.parquet(f"{tmp_path}/predictions.parquet")
    got = quantiles.measurements(spark, str(tmp_path)).groupBy("model").agg(F.sum("count").alias("n")).collect()
    assert {r["model"]: r["n"] for r in got} == {"a": 1, "m": 2, "n": 1}


VOTES = "item_id string, question_id string, kind string, k int, rater_id string, label string"


def test_consensus_finds_unreliable_raters(spark):
    rng = np.random.default_rng(8)
    skill = {f"r{i}": 0.85 for i in range(12)} | {"bad0": 0.3, "bad1": 0.25}
    rows, truth = [], {}
    for j in range(250):
        truth[f"i{j}"] = y = int(rng.integers(0, 3))
        for r in rng.choice(list(skill), 5, replace=False):
            x = y if rng.random() < skill[r] else (y + int(rng.integers(1, 3))) % 3
            rows.append((f"i{j}", "q", "choice", 3, str(r), str(x)))
    post, raters = consensus.fit(spark.createDataFrame(rows, VOTES), rounds=3)
    assert {r["rater_id"] for r in raters.collect() if r["accuracy"] < consensus.UNRELIABLE} == {"bad0", "bad1"}
    best: dict = {}
    for r in post.collect():
        best[r["item_id"]] = max(best.get(r["item_id"], (0, "")), (r["q"], r["label"]))
    assert np.mean([best[i][1] == str(y) for i, y in truth.items()]) > 0.9


def simulated_votes(seed=8, questions=250):
    rng = np.random.default_rng(seed)
    skill = {f"r{i}": 0.85 for i in range(12)} | {"bad0": 0.3, "bad1": 0.25}
    rows = []
    for j in range(questions):
        y, k = int(rng.integers(0, 2)), 2 + j % 2
        for r in rng.choice(list(skill), 5, replace=False):
            rows.append((f"i{j}", "q", ("noul", "choice")[j % 2], k, str(r), str(y if rng.random() < skill[r] else (y + int(rng.integers(1, k))) % k)))
    return rows


def test_the_dual_rises_until_it_gains_little(spark, monkeypatch):
    votes = spark.createDataFrame(simulated_votes(), VOTES)
    numbers, _, raters = consensus.coded(votes)
    _, tilts, values = consensus.dual_ascent(numbers, raters)
    assert len(values) > 3 and all(b > a for a, b in itertools.pairwise(values)) and values[-1] - values[-2] < consensus.GAIN * values[-1]
    plain = {r["rid"]: r["s"] for r in tilts.collect()}
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (40,))  # salted raters and labels change nothing
    assert len(skew.hot_keys(numbers, ["rid"])) > 0
    _, tilts, again = consensus.dual_ascent(numbers, raters)
    assert np.allclose(again, values) and all(abs(r["s"] - plain[r["rid"]]) < 1e-9 for r in tilts.collect())
    monkeypatch.setattr(consensus, "MOST", 2)
    with pytest.raises(ArithmeticError):
        consensus.dual_ascent(numbers, raters)


def test_consensus_of_no_votes(spark):
    post, raters = consensus.fit(spark.createDataFrame([], VOTES))
    assert post.count() == 0 and raters.count() == 0


def test_counted_votes(spark):
    asked = spark.createDataFrame([("i", "q", "choice", ["yes", "no"])], "item_id string, question_id string, kind string, options array<string>")
    rows = [("i", "q", "a", " YES ", "2020-01-01"), ("i", "q", "a", "no", "2020-01-02"), ("i", "q", "b", "n/a", "2020-01-01"), ("i", "q", "c", None, None), ("i", "q", "d", "no", None), ("x", "q", "a", "no", None), ("i", "q", None, "no", None)]
    v = spark.createDataFrame(rows, "item_id string, question_id string, rater_id string, label string, at string").withColumn("voted_at", F.col("at").cast("timestamp")).drop("at").withColumn("options", F.lit(1))
    got = sorted((r["rater_id"], r["label"], r["k"]) for r in consensus.counted_votes(v.drop("options"), asked).collect())
    assert got == [("a", "no", 2), ("d", "no", 2)]
    assert consensus.counted_votes(v.limit(0).drop("options"), asked).count() == 0


def test_bpe_equals_a_plain_merge():
    ranks = {bytes([i]): i for i in range(256)}
    for n, t in enumerate([b"ab", b"bc", b"abc", b"aa", b"aaaa", b"ca", b"abcab", b" a"]):
        ranks[t] = 256 + n

    def plain(piece):
        parts = [bytes([x]) for x in piece]
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: (ranks.get(parts[i] + parts[i + 1], 1 << 40), i))
            if parts[at] + parts[at + 1] not in ranks:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    rng = np.random.default_rng(6)
    for n in [1, 2, 3, 5, 17, 64, 700]:
        for _ in range(20):
            piece = bytes(rng.choice(list(b"abc "), n).astype(np.uint8))
            assert bpe.merge(piece, ranks) == plain(piece)
    content = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    assert bpe.read_ranks(content) == ranks


def test_bpe_of_hard_texts(spark):
    tiktoken = pytest.importorskip("tiktoken")
    rows = [(1, None), (2, ""), (3, " \n "), (4, "The pump's 12 valves — ok?\r\n\té日本語🚧"), (5, "=" * 70000), (6, "ab" * 20000), (4, "The pump's 12 valves — ok?\r\n\té日本語🚧")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(0)).withColumn("n_tokens", F.lit("x"))
    got = sorted((r["doc_id"], r["ids"]) for r in bpe.encoded(df).collect())
    content = open(f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb").read()
    plain = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(content), special_tokens={})
    assert got == sorted((k, plain.encode_ordinary(t) if t else []) for k, t in rows)
    assert bpe.encoded(df.limit(0)).count() == 0


def test_packing(spark):
    rng = np.random.default_rng(9)
    sizes = [*map(int, np.minimum(np.exp(rng.normal(3, 1.2, 700)), 400).astype(int)), 0, 0, 100, 101, 250, 300, *[37] * 300]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, n_tokens bigint").withColumn("k", F.lit(1)).withColumn("part", F.lit(1)).withColumn("container", F.lit(9)).repartition(5)
    rows = packing.packed(df, capacity=100).collect()
    load, whole = Counter(), Counter()
    for r in rows:
        load[r["container"]] += r["n_tokens"]
        whole[r["doc_id"]] += r["n_tokens"]
        assert sizes[r["doc_id"]] > 100 or r["piece"] == 0
    assert whole == Counter(dict(enumerate(sizes))) and max(load.values()) <= 100 and len(whole) == len(sizes)
    assert len(load) <= -(-sum(sizes) // 100) * 1.03 + 1
    assert packing.packed(df.limit(0), capacity=100).count() == 0


def test_nnls_matches_the_conditions():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random((20, 12)) * (rng.random((20, 12)) < 0.6), rng.random(20)
        x = packing.nnls(a, b)
        w = a.T @ (b - a @ x)
        assert (x >= 0).all() and (w[x == 0] <= 1e-8).all() and np.allclose(w[x > 0], 0, atol=1e-8)


def test_patterns_are_all_partitions():
    got = packing.patterns(9, [1, 2, 3, 5, 9], 4)
    want = {p for n in range(1, 5) for p in itertools.combinations_with_replacement([9, 5, 3, 2, 1], n) if sum(p) == 9}
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_most_documents_are_packed_by_patterns(seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(np.exp(rng.normal(5.2, 1.0, 4000)).astype(int) + 1, 2048)
    histogram = Counter(sizes.tolist())
    runs, containers = packing.plan(histogram)
    plain = packing._plan(histogram, packing.CAPACITY, packing.CLASSES, 0.0)[1]
    by_pattern = sum(r[2] for r in runs if r[5])
    assert sum(r[2] for r in runs) == len(sizes) and by_pattern > 0.5 * len(sizes)
    assert containers <= packing.SLACK * plain + 1 and containers <= 1.01 * np.ceil(sizes.sum() / 2048) + 1
    load: Counter = Counter()
    for s, _, count, first, each, _ in runs:
        for c in range(count // each):
            load[first + c] += s * each
    assert max(load.values()) <= 2048 and len(load) == containers


def test_records(spark):
    q = '{"a": {"type": "choice", "instructions": "Do it?", "criteria": {"Yes": "go on", "no": null}}, "b": {"criteria": ["Low: x", "High"], "type": "score", "instructions": "How much"}}'
    df = spark.createDataFrame([(q,), (q[:60],), (None,), ("",), ("[1]",)], "questions string")
    assert [r["w"] for r in df.select(R.words(R.question_text(F.col("questions"))).alias("w")).collect()] == [
        ["a", "do", "it", "yes", "go", "on", "no", "b", "how", "much", "low", "x", "high"], [], [], [], []
    ]
    names = spark.createDataFrame([("Central-Desk 1",), ("central desk_1",), ("N/A",), (" ",), (None,)], "n string")
    assert [r["k"] for r in names.select(R.name_key(F.col("n")).alias("k")).collect()] == ["centraldesk1", "centraldesk1", None, None, None]


def test_words_are_sorted_without_a_comparator_and_questions_read_once(spark):
    df = spark.createDataFrame([("a", '{"q":{"instructions":"b a","criteria":{"k":"v"}}}')], "id string, questions string")
    plan = R.with_words(df.select("id", R.question_text(F.col("questions")).alias("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "comparator" not in plan and "array_sort" not in plan
    assert plan.count("StructField(instructions") == 1 and plan.count("StructField(criteria") == 1


def test_sides_meet_once_and_only_each_other():
    side = np.array([1, 2, 3, 1, 2, 3], np.int32)
    x, y = np.arange(6), np.array([5, 3, 1, 0, 2, 4])
    met = [(i, j) for a, b in neardup.sided(x, y, side) for i in a.tolist() for j in b.tolist()]
    assert len(met) == len(set(met))
    assert set(met) == {(i, j) for i in range(6) for j in range(6) if side[i] & 1 and side[j] & 2 or side[i] & 2 and side[j] & 1}
    assert not list(neardup.sided(x[[0, 3]], y[[1, 3]], side)), "one side has no pairs to test"
