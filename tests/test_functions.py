import math

from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import text as T


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first().asDict(recursive=True)


def test_normalisers_and_shingles(spark):
    t = F.lit("  The Pump, é PUMP! ")
    got = one(spark, a=T.normalize_text(t), u=T.unicode_fold(t), f=T.alnum_fold(t), s=T.shingles(F.lit("a b c d e f")), short=T.shingles(F.lit("a b")), none=T.shingles(F.lit("?!")))
    assert got["a"] == "the pump pump" and got["u"] == "the pump é pump" and got["f"] == "thepumppump"
    assert got["s"] == ["a b c d e", "b c d e f"] and got["short"] == ["a b"] and got["none"] == []


def test_jaccard_of_empty_sets(spark):
    e, a = T.no_words(), F.array(F.lit("x"))
    got = one(spark, both=T.jaccard(e, e), one_=T.jaccard(e, a), same=T.jaccard(a, a))
    assert (got["both"], got["one_"], got["same"]) == (1.0, 0.0, 1.0)


def test_three_tie_rules(spark):
    m = F.create_map(F.lit("b"), F.lit(0.4), F.lit("a"), F.lit(0.4), F.lit("escalate:x"), F.lit(0.1), F.lit("escalate"), F.lit(0.1))
    r = L.rollup(m)
    got = one(spark, top=L.top_candidate(r)["key"], gate=L.gate_argmax(r, F.array(F.lit("b"), F.lit("a")))["key"], first=L.first_argmax(F.array(F.lit(0.4), F.lit(0.4))), esc=L.mass_of(r, F.lit("escalate")))
    assert got["top"] == "a" and got["gate"] == "b" and got["first"] == 0 and math.isclose(got["esc"], 0.2)


def test_bins_brier_and_wilson(spark):
    r = L.rollup(F.create_map(F.lit("a"), F.lit(0.7), F.lit("b"), F.lit(0.3)))
    low, high = L.wilson(F.lit(0), F.lit(0))
    got = one(spark, b3=L.bin_index(F.lit(0.1) * 3), b1=L.bin_index(F.lit(1.0)), absent=L.brier(r, F.lit("c")), low=low, high=high)
    assert got["b3"] == 3 and got["b1"] == 9 and math.isclose(got["absent"], 0.49 + 0.09 + 1) and (got["low"], got["high"]) == (0.0, 1.0)


def test_scaling_and_targets(spark):
    m = F.create_map(F.lit("a"), F.lit(0.8), F.lit("b"), F.lit(0.2))
    got = one(
        spark, t=L.temperature_scale(m, 2.0), n=L.row_nll(m, F.lit("z")), o=L.ordinal_target(F.lit(3), F.lit(0), 0.1), s=L.soften(F.array(F.lit(0.0), F.lit(1.0)), 2.0),
        p=L.unpermuted(L.permuted(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.array(F.lit(2), F.lit(0), F.lit(1))), F.array(F.lit(2), F.lit(0), F.lit(1))),
    )
    assert math.isclose(got["t"]["a"], math.sqrt(0.8) / (math.sqrt(0.8) + math.sqrt(0.2))) and got["n"] is None
    assert got["o"] == [0.9, 0.1, 0.0] and got["s"] == [0.0, 1.0] and got["p"] == [1.0, 2.0, 3.0]


def test_fake_quantisation_keeps_the_sign_of_zero(spark):
    rows = [([1.4, -0.01, 0.01, -1.4],), ([1e-8, -1e-8],), ([-0.0, 0.0],), ([],), ([None, -7.0, -0.1],)]
    got = [r["q"] for r in spark.createDataFrame(rows, "e array<double>").select(L.fake_quantised(F.col("e"), 4).alias("q")).collect()]
    assert [[repr(x) for x in q] for q in got] == [["1.4", "-0.0", "0.0", "-1.4"], ["0.0", "-0.0"], ["0.0", "0.0"], [], ["None", "-7.0", "-0.0"]]
