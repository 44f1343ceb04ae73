"""Queries of row predicates, metric blocks and calibration."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.operators import decisions as D
from assayer.operators.quantile import discrete, interpolated, values_at
from assayer.operators.ranking import running
from assayer.plans.base import CAND, CANON, GOLD, JUDGED, KIND, P, S, entries, judged, preds, query, r6, slim, slim_preds
from assayer.runtime import table

# ------------------------------------------------------------------------------------------------ row predicates


@query("a1_predictions_scan", f"WITH {P} SELECT pos, id, model, outcome, operation, tokens, len(map_keys(candidates))::INT AS n_candidates FROM p")
def a1(spark, d):
    return preds(spark, d).select("pos", "id", "model", "outcome", "operation", "tokens", F.when(F.col("candidates").isNotNull(), F.size("candidates")).alias("n_candidates"))


@query(
    "a2_violations",
    f"""WITH {P} SELECT pos, rule FROM (
 SELECT pos, unnest([CASE WHEN abs(list_sum(map_values(candidates)) - 1) > 1e-4 THEN 'distribution_sum' END,
  CASE WHEN latency_ms < 0 OR isnan(latency_ms) OR latency_ms IS NULL THEN 'latency' END, CASE WHEN ttfd_ms < 0 OR isnan(ttfd_ms) OR ttfd_ms IS NULL THEN 'ttfd' END,
  CASE WHEN tokens < 0 OR tokens IS NULL THEN 'tokens' END, CASE WHEN outcome = 'propose' AND operation IS NULL THEN 'operation' END,
  CASE WHEN outcome != 'propose' AND operation IS NOT NULL THEN 'operation' END]) AS rule FROM p) WHERE rule IS NOT NULL""",
)
def a2(spark, d):
    bad = lambda c: F.coalesce((F.col(c) < 0) | F.isnan(F.col(c).cast("double")), F.lit(True))
    rules = [
        F.when(F.abs(L.total(F.map_values("candidates")) - 1) > 1e-4, "distribution_sum"), F.when(bad("latency_ms"), "latency"), F.when(bad("ttfd_ms"), "ttfd"), F.when(bad("tokens"), "tokens"),
        F.when((F.col("outcome") == "propose") & F.col("operation").isNull(), "operation"), F.when((F.col("outcome") != "propose") & F.col("operation").isNotNull(), "operation"),
    ]
    return preds(spark, d).select("pos", F.explode(F.array_compact(F.array(*rules))).alias("rule"))


@query("b1_expectation_kind", f"WITH {P} SELECT pos, {KIND} AS kind FROM p")
def b1(spark, d):
    return preds(spark, d).select("pos", L.kind_of(F.col("expected")).alias("kind"))


@query("b2_expected_label", f"WITH {P} SELECT pos, {GOLD} AS gold FROM p")
def b2(spark, d):
    return preds(spark, d).select("pos", L.expected_label(F.col("expected")).alias("gold"))


@query(
    "b3_canonical_label",
    f"WITH {P}, c AS (SELECT DISTINCT unnest(map_keys(candidates)) AS label FROM p) SELECT label, {CANON.format('label')} AS canonical, CASE WHEN starts_with(label, 'escalate:') THEN nullif(label[10:], '') END AS reason FROM c",
)
def b3(spark, d):
    c = preds(spark, d).select(F.explode(F.map_keys("candidates")).alias("label")).distinct()
    return c.select("label", L.canonical(F.col("label")).alias("canonical"), L.escalate_reason(F.col("label")).alias("reason"))


@query("b4_argument_validation", f"WITH {JUDGED} SELECT pos, reason FROM j WHERE outcome = 'propose'")
def b4(spark, d):
    return judged(spark, d).filter("outcome = 'propose'").select("pos", "reason")


@query("b5_invalid_reason", f"WITH {JUDGED} SELECT model, reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY ALL")
def b5(spark, d):
    return judged(spark, d).filter("reason IS NOT NULL").groupBy("model", "reason").agg(F.count("*").alias("n"))


@query("b6_outcome_predicates", f"WITH {JUDGED} SELECT pos, proposed, escalated, mutating FROM j")
def b6(spark, d):
    return judged(spark, d).select("pos", "proposed", "escalated", "mutating")


@query("b7_same_arguments", f"WITH {JUDGED} SELECT pos, same_args FROM j WHERE proposed AND same_op")
def b7(spark, d):
    return judged(spark, d).filter("proposed AND same_op").select("pos", D.same_arguments(F.col("arguments"), F.col("expected.args")).alias("same_args"))


@query("b8_right_and_wrong", f'WITH {JUDGED} SELECT pos, "right", wrong_operation, wrong_arguments FROM j')
def b8(spark, d):
    return judged(spark, d).select("pos", "right", "wrong_operation", "wrong_arguments")


@query(
    "b9_mutating_lookup",
    f"WITH {P}, l AS (SELECT DISTINCT unnest(map_keys(candidates)) AS label FROM p) SELECT label, CASE WHEN label IN ('explain') OR label = 'escalate' OR starts_with(label, 'escalate:') THEN false ELSE NOT coalesce(o.read_only, false) END AS mutating FROM l LEFT JOIN operations o ON o.name = l.label",
)
def b9(spark, d):
    labels = preds(spark, d).select(F.explode(F.map_keys("candidates")).alias("label")).distinct()
    ops = table(spark, d, "operations").select(F.col("name").alias("label"), "read_only")
    control = L.canonical(F.col("label")).isin(L.ESCALATE, L.EXPLAIN)
    return labels.join(ops, "label", "left").select("label", F.when(control, F.lit(False)).otherwise(~F.coalesce("read_only", F.lit(False))).alias("mutating"))


SLICE = "CASE WHEN gold IN ('escalate', 'explain') THEN 'escalate_or_explain' WHEN coalesce(g.read_only, false) THEN 'read_only' ELSE 'mutating' END"
SLICED = f"{JUDGED}, sl AS (SELECT j.*, {SLICE} AS slice FROM j LEFT JOIN operations g ON g.name = j.gold)"


def raw_sliced(spark, d):
    """With copies of redelivered rows, for queries that remove them once their few columns are made."""
    ops = table(spark, d, "operations")
    return D.with_slice(D.judged(table(spark, d, "predictions"), ops), ops)


def sliced(spark, d):
    return D.with_slice(judged(spark, d), table(spark, d, "operations"))


@query("b10_slice_name", f"WITH {SLICED} SELECT slice, kind, count(*) AS n FROM sl GROUP BY ALL")
def b10(spark, d):
    return sliced(spark, d).groupBy("slice", "kind").agg(F.count("*").alias("n"))


@query("b11_missing_candidate", f"WITH {JUDGED} SELECT pos, missing FROM j")
def b11(spark, d):
    return judged(spark, d).select("pos", "missing")


@query(
    "b12_missing_candidate_slice",
    f"WITH {S} SELECT id || '-nocand' AS id, list_sort(list_filter(coalesce(candidates, (SELECT list(name ORDER BY pos) FROM operations)), lambda x: x != expect.operation)) AS candidates, true AS escalate FROM s WHERE expect.operation IS NOT NULL AND expect.escalate IS NULL AND expect.explain IS NULL",
)
def b12(spark, d):
    every = table(spark, d, "operations").agg(F.array_sort(F.collect_list("name")).alias("every"))  # one row
    e = entries(spark, d).filter("expect.operation IS NOT NULL AND expect.escalate IS NULL AND expect.explain IS NULL")
    return e.crossJoin(F.broadcast(every)).select(F.concat("id", F.lit("-nocand")).alias("id"), F.array_sort(F.array_remove(F.coalesce("candidates", "every"), F.col("expect.operation"))).alias("candidates"), F.lit(True).alias("escalate"))


@query("b20_candidate_offer", f"WITH {P} SELECT pos, len(offered)::INT AS n, offered[1] AS first, list_position(offered, {GOLD})::INT AS gold_place FROM p WHERE offered IS NOT NULL")
def b20(spark, d):
    at = F.array_position("offered", L.expected_label(F.col("expected"))).cast("int")
    return preds(spark, d).filter("offered IS NOT NULL").select("pos", F.size("offered").alias("n"), F.get("offered", F.lit(0)).alias("first"), F.when(at > 0, at).alias("gold_place"))


@query("b22_failing", f"""WITH {JUDGED} SELECT pos, CASE WHEN kind = 'operation' THEN NOT "right" WHEN kind = 'escalate' THEN NOT escalated ELSE outcome != 'explain' END AS failing FROM j""")
def b22(spark, d):
    c = F.when(F.col("kind") == "operation", ~F.col("right")).when(F.col("kind") == "escalate", ~F.col("escalated")).otherwise(F.col("outcome") != "explain")
    return judged(spark, d).select("pos", c.alias("failing"))


# ---------------------------------------------------------------------------------------------------- metric blocks

RATE = lambda n, m: f"round({n}::DOUBLE / nullif({m}, 0), 6)"
CNT = lambda c: f"count(*) FILTER (WHERE {c})"


@query(
    "d1_metric_block",
    f"""WITH {JUDGED}, a AS (SELECT model, count(*) AS n, {CNT("kind = 'operation'")} AS n_operation, {CNT("kind = 'operation' AND right_")} AS right_proposals,
 {CNT("kind = 'escalate' AND escalated")} AS tp, {CNT("kind = 'escalate' AND NOT escalated")} AS fn, {CNT("kind = 'operation' AND escalated")} AS fp, {CNT("kind = 'explain' AND escalated")} AS on_explain,
 {CNT("kind != 'operation' AND proposed")} AS false_calls, {CNT("kind != 'operation'")} AS declines, {CNT("wrong_operation")} AS wrong_operation, {CNT("wrong_arguments")} AS wrong_arguments, {CNT("reason IS NOT NULL")} AS invalid, {CNT("outcome = 'abstain_uncertain'")} AS abstained
 FROM (SELECT *, "right" AS right_ FROM j) GROUP BY model)
SELECT *, {RATE("right_proposals", "n_operation")} AS right_rate, {RATE("tp", "tp + fn")} AS recall, {RATE("tp", "tp + fp")} AS "precision", {RATE("tp", "tp + fp + on_explain")} AS precision_strict, {RATE("false_calls", "declines")} AS false_call_rate, {RATE("invalid", "n")} AS invalid_rate FROM a""",
)
def d1(spark, d):
    n = lambda c: F.count_if(F.expr(c))
    small = ("model", "kind", "outcome", "right", "escalated", "proposed", "wrong_operation", "wrong_arguments", F.col("reason").isNotNull().alias("bad"))
    a = slim(spark, d, *small).groupBy("model").agg(
        F.count("*").alias("n"), n("kind = 'operation'").alias("n_operation"), n("kind = 'operation' AND right").alias("right_proposals"), n("kind = 'escalate' AND escalated").alias("tp"), n("kind = 'escalate' AND NOT escalated").alias("fn"),
        n("kind = 'operation' AND escalated").alias("fp"), n("kind = 'explain' AND escalated").alias("on_explain"), n("kind != 'operation' AND proposed").alias("false_calls"), n("kind != 'operation'").alias("declines"),
        n("wrong_operation").alias("wrong_operation"), n("wrong_arguments").alias("wrong_arguments"), n("bad").alias("invalid"), n("outcome = 'abstain_uncertain'").alias("abstained"),
    )
    rate = lambda x, y: F.round(F.try_divide(F.expr(x), F.expr(y)), 6)
    return a.select(
        "*", rate("right_proposals", "n_operation").alias("right_rate"), rate("tp", "tp + fn").alias("recall"), rate("tp", "tp + fp").alias("precision"),
        rate("tp", "tp + fp + on_explain").alias("precision_strict"), rate("false_calls", "declines").alias("false_call_rate"), rate("invalid", "n").alias("invalid_rate"),
    )


def calibrated(spark, d):
    """Once per pos: only numbers and names are shuffled, not the distributions they come from."""
    c = raw_sliced(spark, d).filter("candidates IS NOT NULL")
    return c.select("pos", "model", "slice", F.col("top.value").alias("top_p"), (F.col("top.key") == F.col("gold")).alias("correct"), L.brier(F.col("rolled"), F.col("gold")).alias("brier")).distinct()


CAL = f"""{SLICED}, {CAND}, cal AS (SELECT sl.pos, sl.model, sl.slice, sl.gold, top.top_p, top.top = sl.gold AS correct,
 (SELECT sum((r.v - CASE WHEN r.label = sl.gold THEN 1 ELSE 0 END) ** 2) + CASE WHEN bool_or(r.label = sl.gold) THEN 0 ELSE 1 END FROM roll r WHERE r.pos = sl.pos) AS brier
 FROM sl JOIN top USING (pos))"""
BIN = "least(greatest(floor(round(top_p * 10, 9)), 0), 9)::INT"


def ece_table(c, keys):
    """Rows per key and bin, empty bins included."""
    bins = c.sparkSession.range(10).select(F.col("id").cast("int").alias("bin"))
    have = c.groupBy(*keys, L.bin_index(F.col("top_p")).alias("bin")).agg(F.count("*").alias("n"), F.avg("top_p").alias("confidence"), F.avg(F.col("correct").cast("double")).alias("accuracy"))
    grid = have.select(*keys).distinct().crossJoin(F.broadcast(bins))  # ten rows
    return grid.join(have, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query(
    "d5_ece_bins",
    f"""WITH {CAL}, h AS (SELECT slice, {BIN} AS bin, count(*) AS n, avg(top_p) AS confidence, avg(correct::INT) AS accuracy FROM cal GROUP BY ALL)
SELECT g.slice, g.bin, coalesce(h.n, 0) AS n, round(h.confidence, 6) AS confidence, round(h.accuracy, 6) AS accuracy FROM (SELECT DISTINCT slice, b::INT AS bin FROM h, range(10) t(b)) g LEFT JOIN h USING (slice, bin)""",
)
def d5(spark, d):
    return ece_table(calibrated(spark, d), ["slice"]).select("slice", "bin", "n", r6(F.col("confidence")).alias("confidence"), r6(F.col("accuracy")).alias("accuracy"))


@query("d6_brier", f"WITH {CAL} SELECT pos, round(brier, 9) AS brier FROM cal")
def d6(spark, d):
    return calibrated(spark, d).select("pos", F.round("brier", 9).alias("brier"))


BLOCK = f"""h AS (SELECT {{k}}, {BIN} AS bin, count(*) AS n, avg(top_p) AS c, avg(correct::INT) AS a, sum(brier) AS b, sum(correct::INT) AS ok FROM cal GROUP BY ALL)
SELECT {{k}}, sum(n)::BIGINT AS n, round(sum(ok)::DOUBLE / sum(n), 6) AS accuracy, round(sum(n * abs(a - c)) / sum(n), 6) AS ece, round(sum(b) / sum(n), 6) AS brier FROM h GROUP BY {{k}}"""


def calibration_block(c, keys):
    h = c.groupBy(*keys, L.bin_index(F.col("top_p")).alias("bin")).agg(F.count("*").alias("n"), F.avg("top_p").alias("c"), F.avg(F.col("correct").cast("double")).alias("a"), F.sum("brier").alias("b"), F.count_if("correct").alias("ok"))
    return h.groupBy(*keys).agg(
        F.sum("n").alias("n"), r6(F.sum("ok") / F.sum("n")).alias("accuracy"), r6(F.sum(F.col("n") * F.abs(F.col("a") - F.col("c"))) / F.sum("n")).alias("ece"), r6(F.sum("b") / F.sum("n")).alias("brier")
    )


@query("d7_calibration_by_model", f"WITH {CAL}, {BLOCK.format(k='model')}")
def d7(spark, d):
    return calibration_block(calibrated(spark, d), ["model"])


@query("d8_calibration_by_slice", f"WITH {CAL}, {BLOCK.format(k='slice')}")
def d8(spark, d):
    return calibration_block(calibrated(spark, d), ["slice"])


@query(
    "d8_slice_offers",
    f"WITH {SLICED} SELECT slice, count(*) AS n, round(avg(len(offer)), 6) AS mean_offered, quantile_cont(len(offer), 0.5)::DOUBLE AS median_offered, round(avg(missing::INT), 6) AS missing_rate FROM sl WHERE offer IS NOT NULL GROUP BY slice",
)
def d8b(spark, d):
    s = sliced(spark, d).filter("offer IS NOT NULL").withColumn("k", F.size("offer"))
    return s.groupBy("slice").agg(F.count("*").alias("n"), r6(F.avg("k")).alias("mean_offered"), F.percentile("k", F.lit(0.5)).alias("median_offered"), r6(F.avg(F.col("missing").cast("double"))).alias("missing_rate"))


@query(
    "d9_escalation_reasons",
    f"WITH {P}, {CAND}, rt AS (SELECT pos, raw FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY v DESC, raw) AS n FROM cand) WHERE n = 1) SELECT raw[10:] AS reason, count(*) AS n FROM rt WHERE starts_with(raw, 'escalate:') AND raw != 'escalate:' GROUP BY ALL",
)
def d9(spark, d):
    top = L.top_candidate(F.map_entries("candidates"))["key"]
    return preds(spark, d).filter("candidates IS NOT NULL").select(L.escalate_reason(top).alias("reason")).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


GOOD = "latency_ms >= 0 AND NOT isnan(latency_ms)"


@query(
    "d10_timing",
    f"""WITH {P}, o AS (SELECT model, latency_ms, row_number() OVER (PARTITION BY model ORDER BY pos) AS n FROM p WHERE {GOOD})
SELECT model, max(latency_ms) FILTER (WHERE n = 1) AS cold_ms, round(quantile_cont(latency_ms, 0.5) FILTER (WHERE n > 1), 6) AS warm_median_ms, quantile_disc(latency_ms, 0.95) FILTER (WHERE n > 1) AS warm_p95_ms FROM o GROUP BY model""",
)
def d10(spark, d):
    """The first row of a model is cold; found by its least pos, so no model is sorted in one task. Quantiles come from ranks of buckets."""
    p = slim_preds(spark, d, "model", "latency_ms", where=GOOD)
    first = p.groupBy("model").agg(F.min_by("latency_ms", "pos").alias("cold_ms"), F.min("pos").alias("first"))
    warm = p.join(first.select("model", "first"), "model").filter("pos > first")
    low, high, share = interpolated(0.5)
    w = values_at(warm, ["model"], "latency_ms", {"low": low, "high": high, "warm_p95_ms": discrete(0.95)})
    median = F.col("low") + (F.col("high") - F.col("low")) * share
    return first.select("model", "cold_ms").join(w.select("model", r6(median).alias("warm_median_ms"), "warm_p95_ms"), "model", "left")


@query(
    "d11_top_k_accuracy",
    f"""WITH {JUDGED}, {CAND}, r AS (SELECT pos, label, row_number() OVER (PARTITION BY pos ORDER BY v DESC, label) AS n FROM roll)
SELECT model, count(*) AS n, round(avg((place <= 1)::INT), 6) AS top1, round(avg((place <= 3)::INT), 6) AS top3, round(avg((place <= 5)::INT), 6) AS top5
FROM (SELECT j.model, coalesce(r.n, 99) AS place FROM j LEFT JOIN r ON r.pos = j.pos AND r.label = j.gold WHERE j.kind = 'operation' AND j.candidates IS NOT NULL) GROUP BY model""",
)
def d11(spark, d):
    order = F.array_sort("rolled", lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).otherwise(1))
    place = F.array_position(F.transform(order, lambda e: e["key"]), F.col("gold"))
    j = slim(spark, d, "model", F.when(place > 0, place).otherwise(99).alias("place"), where="kind = 'operation' AND candidates IS NOT NULL")
    return j.groupBy("model").agg(F.count("*").alias("n"), *[r6(F.avg((F.col("place") <= k).cast("double"))).alias(f"top{k}") for k in (1, 3, 5)])


@query(
    "d12_log_loss",
    f"WITH {JUDGED}, {CAND} SELECT model, round(avg(-ln(greatest(coalesce(r.v, 0), 1e-12))), 6) AS log_loss FROM j LEFT JOIN roll r ON r.pos = j.pos AND r.label = j.gold WHERE j.candidates IS NOT NULL GROUP BY model",
)
def d12(spark, d):
    loss = L.log_loss(L.mass_of(F.col("rolled"), F.col("gold")))
    return slim(spark, d, "model", loss.alias("loss"), where="candidates IS NOT NULL").groupBy("model").agg(r6(F.avg("loss")).alias("log_loss"))


@query("d13_missing_candidate_summary", f"WITH {JUDGED} SELECT model, count(*) FILTER (WHERE missing) AS missing, round(avg(missing::INT), 6) AS share, count(*) FILTER (WHERE missing AND escalated) AS escalated, round(avg(escalated::INT) FILTER (WHERE missing), 6) AS rate FROM j GROUP BY model")
def d13(spark, d):
    return judged(spark, d).groupBy("model").agg(
        F.count_if("missing").alias("missing"), r6(F.avg(F.col("missing").cast("double"))).alias("share"), F.count_if(F.expr("missing AND escalated")).alias("escalated"), r6(F.avg(F.when(F.col("missing"), F.col("escalated").cast("double")))).alias("rate")
    )


@query(
    "d15_macro_f1",
    f"""WITH {CAL}, pr AS (SELECT c.model, c.gold, top.top AS pred FROM cal c JOIN top USING (pos)),
k AS (SELECT model, gold AS label, count(*) AS g, 0 AS q, count(*) FILTER (WHERE gold = pred) AS ok FROM pr GROUP BY ALL UNION ALL SELECT model, pred, 0, count(*), 0 FROM pr GROUP BY ALL),
f AS (SELECT model, label, CASE WHEN sum(g) + sum(q) = 0 THEN 0 ELSE 2.0 * sum(ok) / (sum(g) + sum(q)) END AS f1 FROM k GROUP BY ALL) SELECT model, count(*) AS classes, round(avg(f1), 6) AS macro_f1 FROM f GROUP BY model""",
)
def d15(spark, d):
    j = slim(spark, d, "model", "gold", F.col("top.key").alias("pred"), where="candidates IS NOT NULL")
    g = j.groupBy("model", F.col("gold").alias("label")).agg(F.count("*").alias("g"), F.count_if(F.expr("gold = pred")).alias("ok"))
    q = j.groupBy("model", F.col("pred").alias("label")).agg(F.count("*").alias("q"))
    f = g.join(q, ["model", "label"], "full_outer").na.fill(0, ["g", "q", "ok"]).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("ok"), F.col("g") + F.col("q")), F.lit(0.0)))
    return f.groupBy("model").agg(F.count("*").alias("classes"), r6(F.avg("f1")).alias("macro_f1"))


@query("d23_coverage", f"""WITH {JUDGED} SELECT model, count(*) AS n, round(avg((NOT escalated AND reason IS NULL)::INT), 6) AS coverage, round(avg(("right" OR (kind = 'explain' AND outcome = 'explain'))::INT) FILTER (WHERE NOT escalated AND reason IS NULL), 6) AS selective_accuracy FROM j GROUP BY model""")
def d23(spark, d):
    answered = ~F.col("escalated") & F.col("reason").isNull()
    ok = (F.col("right") | ((F.col("kind") == "explain") & (F.col("outcome") == "explain"))).cast("double")
    return judged(spark, d).groupBy("model").agg(F.count("*").alias("n"), r6(F.avg(answered.cast("double"))).alias("coverage"), r6(F.avg(F.when(answered, ok))).alias("selective_accuracy"))


@query(
    "d24_model_stats",
    f"""WITH {JUDGED}, {CAND} SELECT j.model, count(*) AS n, count(top.pos) AS answered, round(avg(coalesce(top.top = j.gold, false)::INT), 6) AS accuracy FROM j LEFT JOIN top USING (pos) GROUP BY j.model""",
)
def d24(spark, d):
    return judged(spark, d).groupBy("model").agg(F.count("*").alias("n"), F.count("candidates").alias("answered"), r6(F.avg(F.coalesce(F.col("top.key") == F.col("gold"), F.lit(False)).cast("double"))).alias("accuracy"))


@query(
    "d25_difference_to_first",
    f"""WITH {CAL}, {BLOCK.format(k="model").split("SELECT model, sum")[0].rstrip()}
, m AS (SELECT model, sum(ok)::DOUBLE / sum(n) AS acc FROM h GROUP BY model), b AS (SELECT acc FROM m WHERE model = 'scorer-main')
SELECT m.model, round(m.acc - b.acc, 6) AS difference, CASE WHEN 1 - b.acc > 0 THEN round((m.acc - b.acc) / (1 - b.acc), 6) END AS gap_closed FROM m, b""",
)
def d25(spark, d):
    """Difference to a reference model, and the share of its gap to 1 that a model closes; null without a gap."""
    m = calibrated(spark, d).groupBy("model").agg(F.avg(F.col("correct").cast("double")).alias("acc"))
    b = m.filter("model = 'scorer-main'").select(F.col("acc").alias("base"))
    return m.crossJoin(F.broadcast(b)).select("model", r6(F.col("acc") - F.col("base")).alias("difference"), r6(F.when(F.col("base") < 1, (F.col("acc") - F.col("base")) / (1 - F.col("base")))).alias("gap_closed"))


@query(
    "d26_wilson",
    f"""WITH {JUDGED}, a AS (SELECT model, count(*) FILTER (WHERE kind = 'operation')::DOUBLE AS n, (count(*) FILTER (WHERE kind = 'operation' AND "right"))::DOUBLE AS k FROM j GROUP BY model),
w AS (SELECT model, k, n, k / greatest(n, 1) AS p, greatest(n, 1) AS m, 1.959964 AS z FROM a)
SELECT model, k::BIGINT AS correct, n::BIGINT AS n, CASE WHEN n = 0 THEN 0 ELSE round(greatest(0, (p + z*z/(2*m) - z * sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m)), 6) END::DOUBLE AS low,
 CASE WHEN n = 0 THEN 1 ELSE round(least(1, (p + z*z/(2*m) + z * sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m)), 6) END::DOUBLE AS high FROM w""",
)
def d26(spark, d):
    a = slim(spark, d, "model", "kind", "right").groupBy("model").agg(F.count_if(F.expr("kind = 'operation' AND right")).alias("correct"), F.count_if(F.expr("kind = 'operation'")).alias("n"))
    low, high = L.wilson(F.col("correct"), F.col("n"))
    return a.select("model", "correct", "n", r6(low).alias("low"), r6(high).alias("high"))


@query(
    "d27_latency_summary",
    f"WITH {P} SELECT m.host_class, count(*) AS n, round(quantile_cont(p.latency_ms, 0.5), 6) AS median_ms, quantile_disc(p.latency_ms, 0.95) AS p95_ms, max(p.latency_ms) AS max_ms FROM p JOIN models m USING (model) WHERE {GOOD} GROUP BY m.host_class",
)
def d27(spark, d):
    p = slim_preds(spark, d, "model", "latency_ms", where=GOOD).join(table(spark, d, "models"), "model")
    low, high, share = interpolated(0.5)
    w = values_at(p, ["host_class"], "latency_ms", {"low": low, "high": high, "p95_ms": discrete(0.95), "max_ms": F.col("n")})
    return w.select("host_class", "n", r6(F.col("low") + (F.col("high") - F.col("low")) * share).alias("median_ms"), "p95_ms", "max_ms")


@query(
    "d28_grouping_sets",
    f"WITH {SLICED} SELECT slice, CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind, count(*) AS n, round(avg(escalated::INT), 6) AS escalated, round(avg(proposed::INT), 6) AS proposed FROM sl GROUP BY GROUPING SETS ((slice, kind), (slice))",
)
def d28(spark, d):
    s = sliced(spark, d)
    g = s.groupingSets([[F.col("slice"), F.col("kind")], [F.col("slice")]], "slice", "kind").agg(F.grouping("kind").alias("g"), F.count("*").alias("n"), r6(F.avg(F.col("escalated").cast("double"))).alias("escalated"), r6(F.avg(F.col("proposed").cast("double"))).alias("proposed"))
    return g.select("slice", F.when(F.col("g") == 1, "all").otherwise(F.col("kind")).alias("kind"), "n", "escalated", "proposed")


@query("d29_spend", f"WITH {P} SELECT m.backbone, m.weight_bits, round(sum(greatest(p.tokens, 0) * m.weight_bits) / 1e6, 6) AS cost, sum(greatest(p.tokens, 0))::BIGINT AS tokens FROM p JOIN models m USING (model) WHERE p.tokens IS NOT NULL GROUP BY ALL")
def d29(spark, d):
    """Cost by price class: tokens times the model's own rate, a million tokens a unit."""
    p = slim_preds(spark, d, "model", "tokens", where="tokens IS NOT NULL").join(table(spark, d, "models"), "model").withColumn("t", F.greatest("tokens", F.lit(0)))
    return p.groupBy("backbone", "weight_bits").agg(r6(F.sum(F.col("t") * F.col("weight_bits")) / 1e6).alias("cost"), F.sum("t").alias("tokens"))


@query(
    "d30_gate_report",
    f"""WITH {SLICED}, {CAND}, x AS (SELECT sl.model, sl.slice, top.top_p, top.top = sl.gold AS ok FROM sl LEFT JOIN top USING (pos))
SELECT slice, CASE WHEN top_p IS NULL THEN 'none' WHEN top_p < 0.5 THEN 'low' WHEN top_p < 0.8 THEN 'middle' ELSE 'high' END AS confidence, count(*) AS n, round(avg(ok::INT), 6) AS top1 FROM x GROUP BY ALL""",
)
def d30(spark, d):
    p = F.col("top.value")
    bucket = F.when(p.isNull(), "none").when(p < 0.5, "low").when(p < 0.8, "middle").otherwise("high")
    return sliced(spark, d).groupBy("slice", bucket.alias("confidence")).agg(F.count("*").alias("n"), r6(F.avg((F.col("top.key") == F.col("gold")).cast("double"))).alias("top1"))


@query("d36_truncation_stop", f"WITH {P} SELECT model, count(*) AS answers, count(*) FILTER (WHERE outcome = 'invalid' AND invalid_reason = 'torn output') AS cut, count(*) >= 20 AND count(*) FILTER (WHERE outcome = 'invalid' AND invalid_reason = 'torn output')::DOUBLE / count(*) >= 0.01 AS stop FROM p GROUP BY model")
def d36(spark, d):
    a = preds(spark, d).groupBy("model").agg(F.count("*").alias("answers"), F.count_if(F.expr("outcome = 'invalid' AND invalid_reason = 'torn output'")).alias("cut"))
    return a.withColumn("stop", (F.col("answers") >= 20) & (F.col("cut") / F.col("answers") >= 0.01))


@query(
    "d37_row_metrics",
    f"""WITH {SLICED}, {CAND}, e AS (SELECT pos, -sum(CASE WHEN v > 0 THEN v * ln(v) ELSE 0 END) AS h FROM roll GROUP BY pos), s2 AS (SELECT r.pos, max(r.v) AS second FROM roll r JOIN top USING (pos) WHERE r.label != top.top GROUP BY r.pos)
SELECT sl.pos, sl.slice, top.pos IS NOT NULL AS measurable, top.top = sl.gold AS top1, round(top.top_p - coalesce(s2.second, 0), 6) AS margin, round(-ln(greatest(coalesce(g.v, 0), 1e-12)), 6) AS log_loss,
 round(CASE WHEN len(list_distinct(list_transform(offer, lambda x: {CANON.format("x")}))) <= 1 THEN 0 ELSE e.h / ln(len(list_distinct(list_transform(offer, lambda x: {CANON.format("x")})))) END, 6) AS entropy
FROM sl JOIN top USING (pos) LEFT JOIN e USING (pos) LEFT JOIN s2 USING (pos) LEFT JOIN roll g ON g.pos = sl.pos AND g.label = sl.gold""",
)
def d37(spark, d):
    n = F.size(F.array_distinct(F.transform("offer", L.canonical)))
    return (
        raw_sliced(spark, d)
        .filter("candidates IS NOT NULL")
        .select(
            "pos", "slice", F.lit(True).alias("measurable"), (F.col("top.key") == F.col("gold")).alias("top1"), r6(F.col("top.value") - L.second_place(F.col("rolled"), F.col("top.key"))).alias("margin"),
            r6(L.log_loss(L.mass_of(F.col("rolled"), F.col("gold")))).alias("log_loss"), r6(L.entropy(F.col("rolled"), n)).alias("entropy"),
        )
        .distinct()
    )


# ------------------------------------------------------------------------------------------- order-sensitive labels


@query("e1_top_candidate", f"WITH {P}, {CAND} SELECT pos, top, round(top_p, 6) AS top_p FROM top")
def e1(spark, d):
    return judged(spark, d).filter("candidates IS NOT NULL").select("pos", F.col("top.key").alias("top"), r6(F.col("top.value")).alias("top_p"))


OFFER = f"""ord AS (SELECT pos, label, min(i) AS place FROM (SELECT pos, {CANON.format("x")} AS label, i FROM (SELECT pos, unnest(offer) AS x, generate_subscripts(offer, 1) AS i FROM j)) GROUP BY ALL),
ga AS (SELECT pos, label AS g_label, v AS g_top FROM (SELECT r.*, row_number() OVER (PARTITION BY r.pos ORDER BY r.v DESC, coalesce(o.place, 1000000), r.label) AS n FROM roll r LEFT JOIN ord o USING (pos, label)) WHERE n = 1)"""


@query("e2_gate_argmax", f"WITH {JUDGED}, {CAND}, {OFFER} SELECT pos, g_label, round(g_top, 6) AS g_top FROM ga")
def e2(spark, d):
    g = D.gate_features(judged(spark, d), table(spark, d, "operations"))
    return g.filter("candidates IS NOT NULL").select("pos", "g_label", r6(F.col("g_top")).alias("g_top"))


@query(
    "e3_array_argmax",
    f"WITH {P} SELECT pos, (list_position(list_transform(list_sort(map_entries(candidates)), lambda e: e.value), list_max(map_values(candidates))) - 1)::INT AS at FROM p WHERE candidates IS NOT NULL",
)
def e3(spark, d):
    values = F.transform(F.array_sort(F.map_entries("candidates")), lambda e: e["value"])
    return preds(spark, d).filter("candidates IS NOT NULL").select("pos", L.first_argmax(values).alias("at"))


@query("e5_margin", f"WITH {JUDGED}, {CAND}, {OFFER} SELECT ga.pos, round(g_top - coalesce(max(r.v) FILTER (WHERE r.label != g_label), 0), 6) AS margin FROM ga JOIN roll r USING (pos) GROUP BY ga.pos, g_top")
def e5(spark, d):
    return D.gate_features(judged(spark, d), table(spark, d, "operations")).filter("candidates IS NOT NULL").select("pos", r6(F.col("g_margin")).alias("margin"))


@query("e9_interleave", f"WITH {P}, f AS (SELECT model, min(pos) AS first FROM p GROUP BY model), o AS (SELECT p.pos, p.model, f.first, row_number() OVER (PARTITION BY p.model ORDER BY p.pos) AS turn FROM p JOIN f USING (model)) SELECT pos, model, turn, row_number() OVER (PARTITION BY turn ORDER BY first) AS place FROM o")
def e9(spark, d):
    """One item of each model a turn, models by first appearance."""
    p = preds(spark, d).select("pos", "model")
    first = p.groupBy("model").agg(F.min("pos").alias("first"))
    o = running(p, ["model"], F.floor(F.col("pos") / 65536), ["pos"], F.lit(1).cast("bigint"), "turn").join(first, "model")
    return o.select("pos", "model", "turn", F.row_number().over(Window.partitionBy("turn").orderBy("first")).alias("place"))


# ------------------------------------------------------------------------------------------------ gates and sweeps

GATE = D.Gate(0.35, D.Class(0.4, 0.05, 0.95), D.Class(0.5, 0.1, 0.9))
N_OFFER = f"len(list_distinct(list_transform(j.offer, lambda x: {CANON.format('x')})))"
GF = f"""{JUDGED}, {CAND}, {OFFER}, gf AS (SELECT j.*, ga.g_label, ga.g_top, coalesce(o.read_only, false) AS g_read_only,
 g_top - coalesce((SELECT max(r.v) FROM roll r WHERE r.pos = j.pos AND r.label != ga.g_label), 0) AS g_margin,
 coalesce((SELECT max(r.v) FROM roll r WHERE r.pos = j.pos AND r.label = 'escalate'), 0) AS g_escalate,
 CASE WHEN ga.g_label IS NULL THEN NULL WHEN {N_OFFER} <= 1 THEN 0 ELSE (SELECT -sum(CASE WHEN r.v > 0 THEN r.v * ln(r.v) ELSE 0 END) FROM roll r WHERE r.pos = j.pos) / ln({N_OFFER}) END AS g_entropy
 FROM j LEFT JOIN ga USING (pos) LEFT JOIN operations o ON o.name = ga.g_label)"""


def decide_sql(e, rf, rm, re, mf, mm, me):
    return f"""CASE WHEN g_label IS NULL THEN NULL WHEN g_label = 'escalate' THEN 'escalate' WHEN g_escalate >= {e} THEN 'escalate' WHEN g_label = 'explain' THEN 'explain'
 WHEN g_top < CASE WHEN g_read_only THEN {rf} ELSE {mf} END THEN 'abstain_uncertain' WHEN g_margin < CASE WHEN g_read_only THEN {rm} ELSE {mm} END THEN 'abstain_uncertain'
 WHEN g_entropy > CASE WHEN g_read_only THEN {re} ELSE {me} END THEN 'abstain_uncertain' ELSE 'propose' END"""


def redecide_sql(new):
    same = "(outcome = 'propose' AND operation = g_label)"
    return f"CASE WHEN {new} IS NULL THEN outcome WHEN {new} != 'propose' THEN {new} WHEN {same} AND reason IS NULL THEN 'propose' ELSE 'invalid' END"


FEATURES = ("outcome", "operation", "kind", "reason", "right", "wrong_operation", "wrong_arguments", "missing", "g_label", "g_top", "g_margin", "g_entropy", "g_escalate", "g_read_only")


def features(spark, d):
    """What a gate decides on, once per pos."""
    ops = table(spark, d, "operations")
    return D.gate_features(D.judged(table(spark, d, "predictions"), ops), ops).select("pos", *FEATURES).distinct()


def literal(gate):
    return {k: F.lit(v).cast("double") for k, v in gate.columns().items()}


@query("j4_gate_decision", f"WITH {GF} SELECT pos, {decide_sql(0.35, 0.4, 0.05, 0.95, 0.5, 0.1, 0.9)} AS outcome FROM gf WHERE g_label IS NOT NULL")
def j4(spark, d):
    outcome, _ = D.decide(literal(GATE))
    return features(spark, d).filter("g_label IS NOT NULL").select("pos", outcome.alias("outcome"))


@query("j6_redecide", f"WITH {GF}, n AS (SELECT *, {decide_sql(0.35, 0.4, 0.05, 0.95, 0.5, 0.1, 0.9)} AS new FROM gf) SELECT pos, {redecide_sql('new')} AS outcome FROM n")
def j6(spark, d):
    return D.redecided(features(spark, d), literal(GATE)).select("pos", F.col("n_outcome").alias("outcome"))


def threshold_grid(spark, escalate, floors, margins, entropies):
    """Cartesian product in listed order; null is disabled; mutating thresholds follow the read-only ones."""
    points = [(i, e, f, m, h) for i, (e, f, m, h) in enumerate((e, f, m, h) for e in escalate for f in floors for m in margins for h in entropies)]
    return spark.createDataFrame(points, "grid int, escalate double, floor double, margin double, max_entropy double")


ESC, FLOORS, MARGINS, ENTROPIES = (None, 0.3, 0.5), (None, 0.4, 0.6), (None, 0.1), (None, 0.9)
VALUES = lambda xs: ", ".join(f"({i}, {'NULL' if x is None else x}::DOUBLE)" for i, x in enumerate(xs))
GRID = f"""grid AS (SELECT (a.i * 12 + b.i * 4 + c.i * 2 + e.i)::INT AS grid, a.v AS escalate, b.v AS floor, c.v AS margin, e.v AS max_entropy
 FROM (VALUES {VALUES(ESC)}) a(i, v), (VALUES {VALUES(FLOORS)}) b(i, v), (VALUES {VALUES(MARGINS)}) c(i, v), (VALUES {VALUES(ENTROPIES)}) e(i, v))"""


@query("i13_threshold_grid", f"WITH {GRID} SELECT * FROM grid")
def i13(spark, d):
    return threshold_grid(spark, ESC, FLOORS, MARGINS, ENTROPIES)


MOST_POINTS = 10_000


def sweep(f, grid):
    """All grid points over all rows in one job: rows meet the broadcast grid (bounded by the caller's grid) and are added up map-side."""
    t = {"t_escalate": F.col("escalate")} | {f"t_{k}_{x}": F.col(c) for k in ("read_only", "mutating") for x, c in (("floor", "floor"), ("margin", "margin"), ("max_entropy", "max_entropy"))}
    points = grid.limit(MOST_POINTS + 1).count()
    if points > MOST_POINTS:
        raise ValueError(f"a sweep takes at most {MOST_POINTS} points; split the grid")
    rows = f.select(*FEATURES).crossJoin(F.broadcast(grid))
    r = D.redecided(rows, t)
    esc = F.col("n_outcome").isin("escalate", "abstain_uncertain")
    kept = F.col("n_outcome") == "propose"
    return r.groupBy("grid").agg(
        F.count_if(F.col("n_right") & (F.col("kind") == "operation")).alias("right_proposals"), F.count_if(kept & (F.col("wrong_operation") | F.col("wrong_arguments"))).alias("wrong_mutating"),
        F.count_if(F.col("n_outcome") == "abstain_uncertain").alias("abstained"), F.count_if(esc & (F.col("kind") == "escalate")).alias("tp"), F.count_if(esc & (F.col("kind") == "operation")).alias("fp"), F.count_if(esc & F.col("missing")).alias("missing_escalated"),
    )


SWEEP = f"""WITH {GF}, {GRID}, n AS (SELECT gf.*, grid.grid, {decide_sql("grid.escalate", *["grid.floor", "grid.margin", "grid.max_entropy"] * 2)} AS new FROM gf, grid), m AS (SELECT *, {redecide_sql("new")} AS o FROM n),
sw AS (SELECT grid, count(*) FILTER (WHERE o = 'propose' AND "right" AND kind = 'operation') AS right_proposals, count(*) FILTER (WHERE o = 'propose' AND (wrong_operation OR wrong_arguments)) AS wrong_mutating, count(*) FILTER (WHERE o = 'abstain_uncertain') AS abstained,
 count(*) FILTER (WHERE o IN ('escalate', 'abstain_uncertain') AND kind = 'escalate') AS tp, count(*) FILTER (WHERE o IN ('escalate', 'abstain_uncertain') AND kind = 'operation') AS fp, count(*) FILTER (WHERE o IN ('escalate', 'abstain_uncertain') AND missing) AS missing_escalated FROM m GROUP BY grid)"""


@query("j7_threshold_sweep", f"{SWEEP} SELECT * FROM sw")
def j7(spark, d):
    return sweep(features(spark, d), threshold_grid(spark, ESC, FLOORS, MARGINS, ENTROPIES))


@query("f5_gate_objective", f"{SWEEP} SELECT grid, wrong_mutating, right_proposals FROM sw ORDER BY wrong_mutating, -right_proposals, grid LIMIT 1")
def f5(spark, d):
    """The point of fewest wrong mutating calls, then most right proposals, then first in the grid."""
    s = sweep(features(spark, d), threshold_grid(spark, ESC, FLOORS, MARGINS, ENTROPIES))
    return s.select("grid", "wrong_mutating", "right_proposals").orderBy("wrong_mutating", F.desc("right_proposals"), "grid").limit(1)


@query(
    "j9_lexicographic_select",
    f"""WITH {JUDGED}, {CAND}, m AS (SELECT j.model, count(*) FILTER (WHERE wrong_operation OR wrong_arguments)::DOUBLE / count(*) AS wrong, avg("right"::INT) FILTER (WHERE kind = 'operation') AS rate, avg(coalesce(top.top = gold, false)::INT) AS acc FROM j LEFT JOIN top USING (pos) GROUP BY j.model),
a AS (SELECT * FROM m WHERE wrong <= (SELECT min(wrong) FROM m) + 0.05), b AS (SELECT * FROM a WHERE rate >= (SELECT max(rate) FROM a) - 0.05), c AS (SELECT * FROM b WHERE acc >= (SELECT max(acc) FROM b) - 0.02)
SELECT m.model, CASE WHEN c.model IS NOT NULL THEN 3 WHEN b.model IS NOT NULL THEN 2 WHEN a.model IS NOT NULL THEN 1 ELSE 0 END AS passed, m.model = (SELECT min(model) FROM c) AS chosen FROM m LEFT JOIN a USING (model) LEFT JOIN b USING (model) LEFT JOIN c USING (model)""",
)
def j9(spark, d):
    """Safety, then rate, then accuracy, each within a tolerance of the best that is left; the first name wins. One row a model."""
    m = judged(spark, d).groupBy("model").agg(
        (F.count_if(F.col("wrong_operation") | F.col("wrong_arguments")) / F.count("*")).alias("wrong"), F.avg(F.when(F.col("kind") == "operation", F.col("right").cast("double"))).alias("rate"), F.avg(F.coalesce(F.col("top.key") == F.col("gold"), F.lit(False)).cast("double")).alias("acc")
    )
    all_ = Window.partitionBy(F.lit(0))  # models, not rows
    m = m.withColumn("a", F.col("wrong") <= F.min("wrong").over(all_) + 0.05)
    m = m.withColumn("b", F.col("a") & (F.col("rate") >= F.max(F.when(F.col("a"), F.col("rate"))).over(all_) - 0.05))
    m = m.withColumn("c", F.col("b") & (F.col("acc") >= F.max(F.when(F.col("b"), F.col("acc"))).over(all_) - 0.02))
    passed = F.coalesce(F.when(F.col("c"), 3).when(F.col("b"), 2).when(F.col("a"), 1), F.lit(0))
    return m.select("model", passed.alias("passed"), (F.col("model") == F.min(F.when(F.col("c"), F.col("model"))).over(all_)).alias("chosen"))


@query("j14_case_verdicts", f"""WITH {JUDGED} SELECT pos, CASE WHEN kind = 'operation' THEN "right" WHEN kind = 'escalate' THEN escalated ELSE outcome = 'explain' END AS right_action, wrong_operation OR wrong_arguments AS wrong_mutating, kind != 'escalate' OR escalated AS abstains, NOT missing OR escalated AS handles_missing FROM j""")
def j14(spark, d):
    right = F.when(F.col("kind") == "operation", F.col("right")).when(F.col("kind") == "escalate", F.col("escalated")).otherwise(F.col("outcome") == "explain")
    return judged(spark, d).select("pos", right.alias("right_action"), (F.col("wrong_operation") | F.col("wrong_arguments")).alias("wrong_mutating"), ((F.col("kind") != "escalate") | F.col("escalated")).alias("abstains"), (~F.col("missing") | F.col("escalated")).alias("handles_missing"))
