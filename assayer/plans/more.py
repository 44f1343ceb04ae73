"""Queries of splits, folds, sampling, ledgers, streams, fits and intervals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import text as T
from assayer.operators import bootstrap, calibration
from assayer.operators.ranking import quota, rank_by_hash, running
from assayer.plans.base import CANON, GOLD, JUDGED, KIND, P, S, entries, judged, preds, query, quota_sql, r6, slim
from assayer.plans.metrics import SLICED, sliced
from assayer.plans.text import SW, sided, worded
from assayer.runtime import table
from assayer.streaming import shadow

FOLD = "CASE WHEN ('0x' || left(sha256('5:' || id), 15))::BIGINT % 10 < 6 THEN 'fit' ELSE 'selection' END"


def fold(c):
    return F.when(T.seeded_hash("5", c, 15).cast("bigint") % 10 < 6, "fit").otherwise("selection")


@query("a4_entry_problems", f"WITH {S} SELECT id, unnest(list_filter([CASE WHEN coalesce(trim(text), '') = '' THEN 'text' END, CASE WHEN expect.operation IS NULL AND expect.escalate IS NULL AND expect.explain IS NULL THEN 'expect' END, CASE WHEN expect.operation IS NOT NULL AND expect.operation NOT IN (SELECT name FROM operations) THEN 'operation' END, CASE WHEN source IS NULL THEN 'source' END], lambda x: x IS NOT NULL)) AS problem FROM s")
def a4(spark, d):
    ops = table(spark, d, "operations").select(F.col("name").alias("op"), F.lit(True).alias("known"))
    e = entries(spark, d).withColumn("op", F.col("expect.operation")).join(ops, "op", "left")
    rules = [F.when(F.coalesce(F.trim("text"), F.lit("")) == "", "text"), F.when(F.expr("expect.operation IS NULL AND expect.escalate IS NULL AND expect.explain IS NULL"), "expect"), F.when(F.col("op").isNotNull() & F.col("known").isNull(), "operation"), F.when(F.col("source").isNull(), "source")]
    return e.select("id", F.explode(F.array_compact(F.array(*rules))).alias("problem"))


@query("a16_response_cache", f"WITH {P}, k AS (SELECT *, sha256(coalesce(model, '') || '|' || coalesce(id, '')) AS key FROM p) SELECT key, count(*) AS uses, min(pos) AS first FROM k GROUP BY key")
def a16(spark, d):
    key = F.sha2(F.concat_ws("|", F.coalesce("model", F.lit("")), F.coalesce("id", F.lit(""))), 256)
    return preds(spark, d).groupBy(key.alias("key")).agg(F.count("*").alias("uses"), F.min("pos").alias("first"))


@query("a17_billed_once", f"WITH {S} SELECT kind, count(DISTINCT source_id) + count(*) FILTER (WHERE source_id IS NULL) AS billed FROM s GROUP BY kind")
def a17(spark, d):
    """Each attempt of a kind counts once; one without an id is never a repeat."""
    return entries(spark, d).groupBy("kind").agg((F.countDistinct("source_id") + F.count_if(F.col("source_id").isNull())).alias("billed"))


@query("a18_progress", f"WITH {P}, {S} SELECT s.kind, count(*) AS planned, count(*) FILTER (WHERE s.id IN (SELECT id FROM p WHERE outcome != 'invalid')) AS done FROM s GROUP BY s.kind")
def a18(spark, d):
    done = preds(spark, d).filter("outcome != 'invalid'").select("id").distinct().withColumn("done", F.lit(True))
    return entries(spark, d).select("id", "kind").join(done, "id", "left").groupBy("kind").agg(F.count("*").alias("planned"), F.count("done").alias("done"))


@query("a31_evidence_join", f"WITH {P}, {S}, e AS (SELECT id, min(pos) AS first, count(*) AS n FROM p WHERE outcome = 'escalate' GROUP BY id) SELECT s.id, e.first, coalesce(e.n, 0) AS n FROM s LEFT JOIN e USING (id)")
def a31(spark, d):
    e = preds(spark, d).filter("outcome = 'escalate'").groupBy("id").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    return entries(spark, d).select("id").join(e, "id", "left").select("id", "first", F.coalesce("n", F.lit(0)).alias("n"))


@query("a35_model_registry", f"WITH {P} SELECT m.backbone, count(DISTINCT p.model) AS models, count(*) AS n FROM p LEFT JOIN models m USING (model) GROUP BY m.backbone")
def a35(spark, d):
    return preds(spark, d).join(table(spark, d, "models"), "model", "left").groupBy("backbone").agg(F.countDistinct("model").alias("models"), F.count("*").alias("n"))


@query("a36_prompt_set", "SELECT item_id, list_sort(list(DISTINCT question_id)) AS questions FROM rater_votes GROUP BY item_id")
def a36(spark, d):
    return table(spark, d, "rater_votes").groupBy("item_id").agg(F.array_sort(F.collect_set("question_id")).alias("questions"))


@query("b15_fold_filter", f"WITH {P} SELECT {FOLD} AS fold, count(*) AS n, count(*) FILTER (WHERE candidates IS NULL) AS without FROM p GROUP BY 1")
def b15(spark, d):
    return preds(spark, d).groupBy(fold(F.col("id")).alias("fold")).agg(F.count("*").alias("n"), F.count_if(F.col("candidates").isNull()).alias("without"))


@query("b26_pools", f"WITH {SW} SELECT CASE WHEN split IS NULL THEN 'unplaced' WHEN coalesce(n, '') = '' THEN 'empty' WHEN train_only THEN 'train_only' WHEN author IS NULL THEN 'anonymous' ELSE 'signed' END AS pool, count(*) AS n FROM w GROUP BY 1")
def b26(spark, d):
    pool = F.when(F.col("split").isNull(), "unplaced").when(F.coalesce("n", F.lit("")) == "", "empty").when(F.col("train_only"), "train_only").when(F.col("author").isNull(), "anonymous").otherwise("signed")
    return worded(spark, d).groupBy(pool.alias("pool")).agg(F.count("*").alias("n"))


@query("b29_answer_classes", f"WITH {P} SELECT CASE WHEN outcome != 'invalid' THEN 'answer' WHEN invalid_reason = 'torn output' THEN 'malformed' WHEN invalid_reason IN ('bad choice', 'unknown operation') THEN 'not_offered' ELSE 'pending' END AS class, count(*) AS n FROM p GROUP BY 1")
def b29(spark, d):
    c = F.when(F.col("outcome") != "invalid", "answer").when(F.col("invalid_reason") == "torn output", "malformed").when(F.col("invalid_reason").isin("bad choice", "unknown operation"), "not_offered").otherwise("pending")
    return preds(spark, d).groupBy(c.alias("class")).agg(F.count("*").alias("n"))


@query("b30_budget_plan", f"WITH {P}, r AS (SELECT pos, model, sum(greatest(coalesce(tokens, 0), 0)) OVER (PARTITION BY model ORDER BY pos ROWS UNBOUNDED PRECEDING) AS spent FROM p) SELECT model, count(*) FILTER (WHERE spent <= 4000) AS admitted, max(spent) FILTER (WHERE spent <= 4000)::BIGINT AS used FROM r GROUP BY model")
def b30(spark, d):
    """Calls admitted in order while their sum stays within the cap; the running sum is made in buckets of places."""
    p = preds(spark, d).select("model", "pos", F.greatest(F.coalesce("tokens", F.lit(0)), F.lit(0)).alias("cost"))
    r = running(p, ["model"], F.floor(F.col("pos") / 65536), ["pos"], F.col("cost"), "spent")
    return r.groupBy("model").agg(F.count_if(F.col("spent") <= 4000).alias("admitted"), F.max(F.when(F.col("spent") <= 4000, F.col("spent"))).alias("used"))


ARGS_OF = "list_sort(map_entries(coalesce({0}.expect.args, MAP {{}}::MAP(VARCHAR, VARCHAR))))"


@query("c5_variation_to_source", f"WITH {SW}, f AS (SELECT source, kind, min(id) AS origin FROM w WHERE source IS NOT NULL GROUP BY 1, 2) SELECT w.id, f.origin, w.expect.operation IS NOT DISTINCT FROM o.expect.operation AND w.expect.escalate IS NOT DISTINCT FROM o.expect.escalate AND {ARGS_OF.format('w')} = {ARGS_OF.format('o')} AS same FROM w JOIN f USING (source, kind) JOIN w o ON o.id = f.origin WHERE w.id != f.origin")
def c5(spark, d):
    """An entry against the first of its source and kind, of which it is a variation."""
    w = worded(spark, d).select("id", "source", "kind", F.col("expect.operation").alias("op"), F.col("expect.escalate").alias("esc"), F.array_sort(F.map_entries(F.coalesce("expect.args", F.create_map().cast("map<string,string>")))).alias("args"))
    f = w.filter("source IS NOT NULL").groupBy("source", "kind").agg(F.min_by(F.struct("id", "op", "esc", "args"), "id").alias("o"))
    j = w.join(f, ["source", "kind"]).filter("id != o.id")
    return j.select("id", F.col("o.id").alias("origin"), (F.col("op").eqNullSafe(F.col("o.op")) & F.col("esc").eqNullSafe(F.col("o.esc")) & (F.col("args") == F.col("o.args"))).alias("same"))


@query("c16_candidate_count_slice", f"WITH {JUDGED} SELECT coalesce(len(offered)::VARCHAR, 'n/m') AS offered, count(*) AS n, round(avg(escalated::INT), 6) AS escalated FROM j GROUP BY 1")
def c16(spark, d):
    return judged(spark, d).groupBy(F.coalesce(F.when(F.col("offered").isNotNull(), F.size("offered")).cast("string"), F.lit("n/m")).alias("k")).agg(F.count("*").alias("n"), r6(F.avg(F.col("escalated").cast("double"))).alias("escalated")).withColumnRenamed("k", "offered")


@query("c20_twins", f"WITH {JUDGED}, t AS (SELECT id, model, bool_or(missing) AS missing, bool_or(NOT missing) AS present FROM j GROUP BY ALL) SELECT model, count(*) AS twins FROM t WHERE missing AND present GROUP BY model")
def c20(spark, d):
    t = judged(spark, d).groupBy("id", "model").agg(F.bool_or("missing").alias("missing"), F.bool_or(~F.col("missing")).alias("present"))
    return t.filter("missing AND present").groupBy("model").agg(F.count("*").alias("twins"))


@query("c25_consistent_expectation", f"WITH {P} SELECT golds, count(*) AS ids FROM (SELECT id, count(DISTINCT {GOLD}) AS golds FROM p GROUP BY id) GROUP BY golds")
def c25(spark, d):
    """Ids by the number of different expectations their predictions carry; more than one is a conflict."""
    g = preds(spark, d).groupBy("id").agg(F.countDistinct(L.expected_label(F.col("expected"))).alias("golds"))
    return g.groupBy("golds").agg(F.count("*").alias("ids"))


@query("c30_replay_missing", f"WITH {P}, {SW} SELECT w.id FROM w WHERE w.split = 'test' AND w.id NOT IN (SELECT id FROM p WHERE id IS NOT NULL AND model = 'scorer-main')")
def c30(spark, d):
    return worded(spark, d).filter("split = 'test'").select("id").join(table(spark, d, "predictions").filter("model = 'scorer-main'").select("id"), "id", "left_anti")


@query("d33_decision_counts", f"WITH {JUDGED} SELECT kind, outcome, count(*) AS n FROM j GROUP BY ALL")
def d33(spark, d):
    return judged(spark, d).groupBy("kind", "outcome").agg(F.count("*").alias("n"))


@query("d35_readout_tally", f"WITH {P} SELECT model, count(*) FILTER (WHERE raw_scores IS NULL) AS none, count(*) FILTER (WHERE raw_scores IS NOT NULL AND len(map_keys(raw_scores)) = len(map_keys(candidates))) AS complete, count(*) FILTER (WHERE raw_scores IS NOT NULL AND (candidates IS NULL OR len(map_keys(raw_scores)) != len(map_keys(candidates)))) AS incomplete FROM p GROUP BY model")
def d35(spark, d):
    has, same = F.col("raw_scores").isNotNull(), F.coalesce(F.size(F.map_keys("raw_scores")) == F.size(F.map_keys("candidates")), F.lit(False)) & F.col("candidates").isNotNull()
    return preds(spark, d).groupBy("model").agg(F.count_if(~has).alias("none"), F.count_if(has & same).alias("complete"), F.count_if(has & ~same).alias("incomplete"))


@query("e11_cold_flag", f"WITH {P}, o AS (SELECT pos, row_number() OVER (PARTITION BY model ORDER BY pos) = 1 AS cold FROM p) SELECT pos, cold FROM o")
def e11(spark, d):
    p = preds(spark, d).select("pos", "model")
    return p.join(p.groupBy("model").agg(F.min("pos").alias("first")), "model").select("pos", (F.col("pos") == F.col("first")).alias("cold"))


@query("e12_vote_replay", "WITH v AS (SELECT DISTINCT item_id, question_id, rater_id, voted_at, lower(trim(label)) AS label FROM rater_votes WHERE voted_at IS NOT NULL AND label IS NOT NULL AND trim(label) != ''), x AS (SELECT *, lag(label) OVER (PARTITION BY item_id, question_id, rater_id ORDER BY voted_at, label) AS before FROM v) SELECT item_id, question_id, rater_id, count(*) FILTER (WHERE before IS NOT NULL AND before != label) AS changes FROM x GROUP BY ALL")
def e12(spark, d):
    """An ordered fold of each rater's votes on a question."""
    v = table(spark, d, "rater_votes").filter("voted_at IS NOT NULL AND label IS NOT NULL AND trim(label) != ''").select("item_id", "question_id", "rater_id", F.struct("voted_at", F.lower(F.trim("label")).alias("label")).alias("v"))
    g = v.groupBy("item_id", "question_id", "rater_id").agg(F.array_sort(F.collect_set("v")).alias("vs"))
    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).cast("bigint").alias("changes"))
    step = lambda a, x: F.struct(x["label"].alias("last"), (a["changes"] + F.when(a["last"].isNotNull() & (a["last"] != x["label"]), 1).otherwise(0)).alias("changes"))
    return g.select("item_id", "question_id", "rater_id", F.aggregate("vs", zero, step)["changes"].alias("changes"))


@query("h9_choice_letters", f"WITH {P} SELECT pos, chr((64 + list_position(offered, operation))::INT) AS letter FROM p WHERE outcome = 'propose' AND list_position(offered, operation) > 0")
def h9(spark, d):
    at = F.array_position("offered", F.col("operation"))
    return preds(spark, d).filter("outcome = 'propose'").withColumn("at", at).filter("at > 0").select("pos", F.char(F.col("at") + 64).alias("letter"))


@query("h13_entropy", f"WITH {JUDGED}, cand AS (SELECT pos, unnest(map_keys(candidates)) AS raw, unnest(map_values(candidates)) AS v FROM p), e AS (SELECT pos, -sum(CASE WHEN v > 0 THEN v * ln(v) ELSE 0 END) AS h FROM (SELECT pos, {CANON.format('raw')} AS l, sum(v) AS v FROM cand GROUP BY ALL) GROUP BY pos) SELECT j.pos, round(h, 6) AS h FROM j JOIN e USING (pos)")
def h13(spark, d):
    h = -F.aggregate("rolled", F.lit(0.0), lambda a, e: a + F.when(e["value"] > 0, e["value"] * F.ln(e["value"])).otherwise(0.0))
    return judged(spark, d).filter("candidates IS NOT NULL").select("pos", r6(h).alias("h"))


@query("h16_raw_scores_readout", f"WITH {P}, c AS (SELECT pos, unnest(map_keys(raw_scores)) AS label, unnest(map_values(raw_scores)) AS v FROM p) SELECT pos, label, round(exp(v) / sum(exp(v)) OVER (PARTITION BY pos), 6) AS v FROM c")
def h16(spark, d):
    m = F.transform_values("raw_scores", lambda _, v: F.exp(v))
    z = L.total(F.map_values(m))
    return preds(spark, d).filter("raw_scores IS NOT NULL").select("pos", F.explode(F.transform_values(m, lambda _, v: v / z)).alias("label", "v")).select("pos", "label", r6(F.col("v")).alias("v"))


@query("h21_content_hash", f"WITH {S} SELECT id, sha256('{{\"id\":\"' || id || '\",\"kind\":\"' || kind || '\"}}') AS h FROM s WHERE kind IS NOT NULL")
def h21(spark, d):
    return entries(spark, d).filter("kind IS NOT NULL").select("id", F.sha2(F.to_json(F.struct("id", "kind")), 256).alias("h"))


@query("h29_bars", f"WITH {JUDGED}, m AS (SELECT model, avg(\"right\"::INT) FILTER (WHERE kind = 'operation') AS rate FROM j GROUP BY model), b AS (SELECT greatest(0.05, (SELECT rate FROM m WHERE model = 'scorer-main')) AS bar) SELECT model, CASE WHEN rate IS NULL THEN 'fail' WHEN rate >= bar THEN 'pass' ELSE 'fail' END AS verdict FROM m, b")
def h29(spark, d):
    m = judged(spark, d).groupBy("model").agg(F.avg(F.when(F.col("kind") == "operation", F.col("right").cast("double"))).alias("rate"))
    bar = m.filter("model = 'scorer-main'").select(F.greatest(F.lit(0.05), "rate").alias("bar"))  # one row
    return m.crossJoin(F.broadcast(bar)).select("model", F.when(F.col("rate") >= F.col("bar"), "pass").otherwise("fail").alias("verdict"))


@query("h33_decision_rows", f"WITH {JUDGED} SELECT pos, CASE WHEN reason IS NOT NULL THEN 'invalid' WHEN outcome = 'propose' THEN 'tool_call' WHEN escalated THEN 'escalation' ELSE 'answer' END AS decision, CASE WHEN proposed THEN operation END AS tool FROM j")
def h33(spark, d):
    c = F.when(F.col("reason").isNotNull(), "invalid").when(F.col("outcome") == "propose", "tool_call").when(F.col("escalated"), "escalation").otherwise("answer")
    return judged(spark, d).select("pos", c.alias("decision"), F.when(F.col("proposed"), F.col("operation")).alias("tool"))


I1 = ("0.8", "0.1", "0.1")


@query("i1_stratified_split", f"WITH {S}, g AS (SELECT min(kind) AS kind, coalesce(source_id, id) AS unit FROM s GROUP BY coalesce(source_id, id)), n AS (SELECT kind, count(*) AS n FROM g GROUP BY kind), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY sha256('11:' || unit), unit) AS k FROM g) SELECT s.id, CASE WHEN r.k <= a THEN 'train' WHEN r.k <= a + b THEN 'validation' ELSE 'test' END AS side FROM s JOIN r ON r.unit = coalesce(s.source_id, s.id) JOIN {quota_sql('kind', 'n', I1)} q ON q.kind = r.kind")
def i1(spark, d):
    """Grouped by source, stratified by the group's kind, in hash order; ranks come from buckets of the hash, quotas from largest remainders."""
    e = entries(spark, d).select("id", "kind", F.coalesce("source_id", "id").alias("unit"))
    g = e.groupBy("unit").agg(F.min("kind").alias("kind"))
    n = g.groupBy("kind").agg(F.count("*").alias("n")).withColumn("q", quota(F.col("n"), [F.lit(float(x)) for x in I1]))
    r = rank_by_hash(g.withColumn("h", F.sha2(F.concat(F.lit("11:"), "unit"), 256)), ["kind"], "h", "unit").join(n, "kind")
    return e.select("id", "unit").join(r.select("unit", sided().alias("side")), "unit").select("id", "side")


@query("i3_grouped_folds", f"WITH {S}, g AS (SELECT DISTINCT coalesce(source_id, id) AS id FROM s) SELECT id, {FOLD} AS fold FROM g")
def i3(spark, d):
    """A fold by threshold on the group's hash: no sort and no shuffle beyond the distinct groups."""
    return entries(spark, d).select(F.coalesce("source_id", "id").alias("id")).distinct().select("id", fold(F.col("id")).alias("fold"))


@query("i4_nested_carve", f"WITH {S}, h AS (SELECT id, ('0x' || left(sha256('3:' || coalesce(source_id, id)), 15))::BIGINT % 1000 AS h FROM s) SELECT id, CASE WHEN h < 100 THEN 'held_out' WHEN h < 820 THEN CASE WHEN h < 676 THEN 'fit' ELSE 'selection' END ELSE 'test' END AS side FROM h")
def i4(spark, d):
    h = T.seeded_hash("3", F.coalesce("source_id", "id"), 15).cast("bigint") % 1000
    return entries(spark, d).withColumn("h", h).select("id", F.when(F.col("h") < 100, "held_out").when(F.col("h") < 676, "fit").when(F.col("h") < 820, "selection").otherwise("test").alias("side"))


@query("i6_hash_permutation", f"WITH {P}, o AS (SELECT pos, id, unnest(offered) AS label FROM p), r AS (SELECT pos, label, row_number() OVER (PARTITION BY pos ORDER BY sha256('9:' || coalesce(id, '') || '|' || label), label) AS place FROM (SELECT DISTINCT * FROM o)) SELECT pos, label, place::INT AS place FROM r")
def i6(spark, d):
    keyed = F.array_sort(F.transform(F.array_distinct("offered"), lambda x: F.struct(F.sha2(F.concat(F.lit("9:"), F.coalesce("id", F.lit("")), F.lit("|"), x), 256).alias("h"), x.alias("label"))))
    return preds(spark, d).filter("offered IS NOT NULL").select("pos", F.posexplode(keyed).alias("i", "e")).select("pos", F.col("e.label").alias("label"), (F.col("i") + 1).alias("place"))


@query("i7_missing_candidate_rows", f"WITH {S}, h AS (SELECT *, ('0x' || left(sha256('4:' || id), 15))::BIGINT % 100 < 20 AS drawn FROM s WHERE expect.operation IS NOT NULL) SELECT id || '-nocand' AS id, true AS escalate FROM h WHERE drawn UNION ALL SELECT id, false FROM h")
def i7(spark, d):
    e = entries(spark, d).filter("expect.operation IS NOT NULL").select("id", (T.seeded_hash("4", F.col("id"), 15).cast("bigint") % 100 < 20).alias("drawn"))
    return e.select(F.explode(F.when(F.col("drawn"), F.array(F.struct(F.concat("id", F.lit("-nocand")).alias("id"), F.lit(True).alias("escalate")), F.struct("id", F.lit(False).alias("escalate")))).otherwise(F.array(F.struct("id", F.lit(False).alias("escalate"))))).alias("r")).select("r.*")


@query("i14_smoke_scope", f"WITH {SW} SELECT split, id FROM (SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY id) AS k FROM w WHERE split IS NOT NULL) WHERE k <= 5")
def i14(spark, d):
    """The first five of each split; Catalyst keeps five a task before the shuffle."""
    return worded(spark, d).filter("split IS NOT NULL").withColumn("k", F.row_number().over(Window.partitionBy("split").orderBy("id"))).filter("k <= 5").select("split", "id")


@query("i16_model_eligibility", f"WITH {P} SELECT DISTINCT p.model, coalesce(m.weight_bits <= 8 AND m.backbone IS NOT NULL, false) AS eligible FROM p LEFT JOIN models m USING (model)")
def i16(spark, d):
    return preds(spark, d).select("model").distinct().join(table(spark, d, "models"), "model", "left").select("model", F.coalesce((F.col("weight_bits") <= 8) & F.col("backbone").isNotNull(), F.lit(False)).alias("eligible"))


@query("j12_heal_trigger", f"WITH {JUDGED}, a AS (SELECT m.weight_bits, avg(\"right\"::INT) FILTER (WHERE kind = 'operation') AS rate, list_sort(list(DISTINCT id) FILTER (WHERE wrong_operation OR wrong_arguments)) AS ids FROM j JOIN models m USING (model) GROUP BY 1), b AS (SELECT * FROM a WHERE weight_bits = 16) SELECT a.weight_bits, round(100 * (b.rate - a.rate), 6) AS loss_points, coalesce(len(list_filter(a.ids, lambda x: NOT list_contains(coalesce(b.ids, []), x))), 0)::INT AS new_wrong FROM a, b WHERE a.weight_bits != 16")
def j12(spark, d):
    """Loss against the widest weights, and how many ids are newly wrong. Differences are counted by anti-join, not in arrays."""
    j = judged(spark, d).join(table(spark, d, "models").select("model", "weight_bits"), "model")
    rate = j.groupBy("weight_bits").agg(F.avg(F.when(F.col("kind") == "operation", F.col("right").cast("double"))).alias("rate"))
    wrong = j.filter("wrong_operation OR wrong_arguments").select("weight_bits", "id").distinct()
    new = wrong.filter("weight_bits != 16").join(wrong.filter("weight_bits = 16").select("id"), "id", "left_anti").groupBy("weight_bits").agg(F.count("*").alias("new_wrong"))
    base = rate.filter("weight_bits = 16").select(F.col("rate").alias("base"))
    return rate.filter("weight_bits != 16").crossJoin(F.broadcast(base)).join(new, "weight_bits", "left").select("weight_bits", r6(100 * (F.col("base") - F.col("rate"))).alias("loss_points"), F.coalesce("new_wrong", F.lit(0)).cast("int").alias("new_wrong"))


# ----------------------------------------------------------------------------------------------------- streams


HOURS = "SELECT time_bucket(INTERVAL 1 HOUR, ts::TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS peak FROM events GROUP BY ALL"


@query("k8_windows", HOURS)
def k8(spark, d):
    return shadow.windowed(table(spark, d, "events"))


@query("k8_stream", HOURS)
def k8_stream(spark, d):
    """The same by Structured Streaming, to the end of the files."""
    return shadow.run_stream(spark, d)


@query("k8_sessions", "WITH o AS (SELECT user_id, ts::TIMESTAMP AS ts, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE, true) AS new FROM events), s AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def k8_sessions(spark, d):
    return shadow.sessions(table(spark, d, "events"))


# ------------------------------------------------------------------------------------------- intervals and fits (no SQL)


@query("d2_bootstrap_interval")
def d2(spark, d):
    return bootstrap.mean_interval(judged(spark, d).filter("kind = 'operation'").select("model", F.col("right").cast("int").alias("v")), ["model"], "v")


@query("d3_stratified_bootstrap")
def d3(spark, d):
    j = judged(spark, d).filter("kind != 'explain'").select("model", "kind", (F.col("escalated") & (F.col("kind") == "escalate")).alias("hit"), F.col("escalated").alias("all"))
    return bootstrap.ratio_interval(j, ["model"], "kind", "hit", "all")


@query("d4_paired_bootstrap")
def d4(spark, d):
    return bootstrap.paired_interval(judged(spark, d).select("id", "model", F.col("right").cast("int").alias("v")), "id", "model", "v", "scorer-main")


@query("j3_calibration")
def j3(spark, d):
    j = judged(spark, d).select("candidates", "gold", fold(F.col("id")).alias("fold"))
    got = calibration.select_calibration(j.filter("fold = 'fit'"), j.filter("fold = 'selection'"))
    rows = [("temperature", "", got["temperature"]), *(("vector", k, v) for k, v in sorted(got["vector"].items())), *(("ece", k, v) for k, v in got["errors"].items())]
    return spark.createDataFrame(rows, "part string, label string, value double").withColumn("kept", F.lit(got["kept"]))


@query("d2_point_values", f"WITH {JUDGED} SELECT model, count(*) AS n, round(avg(\"right\"::INT), 6) AS mean FROM j WHERE kind = 'operation' GROUP BY model")
def d2_points(spark, d):
    """What the interval of d2 stands around."""
    return slim(spark, d, "model", F.col("right").cast("double").alias("v"), where="kind = 'operation'").groupBy("model").agg(F.count("*").alias("n"), r6(F.avg("v")).alias("mean"))


@query("d3_point_values", f"WITH {JUDGED} SELECT model, count(*) FILTER (WHERE escalated) AS calls, round(count(*) FILTER (WHERE escalated AND kind = 'escalate')::DOUBLE / nullif(count(*) FILTER (WHERE escalated), 0), 6) AS ratio FROM j WHERE kind != 'explain' GROUP BY model")
def d3_points(spark, d):
    hit, every = F.count_if(F.col("escalated") & (F.col("kind") == "escalate")), F.count_if("escalated")
    return slim(spark, d, "model", "kind", "escalated", where="kind != 'explain'").groupBy("model").agg(every.alias("calls"), r6(F.try_divide(hit, every)).alias("ratio"))


@query("d4_point_values", f"WITH {JUDGED}, v AS (SELECT id, model, avg(\"right\"::INT) AS v FROM j GROUP BY ALL) SELECT a.model, count(*) AS n, round(avg(a.v - b.v), 6) AS difference FROM v a JOIN v b ON a.id = b.id AND b.model = 'scorer-main' AND a.model != 'scorer-main' GROUP BY a.model")
def d4_points(spark, d):
    v = slim(spark, d, "id", "model", F.col("right").cast("double").alias("v")).groupBy("id", "model").agg(F.avg("v").alias("v"))
    b = v.filter("model = 'scorer-main'").select("id", F.col("v").alias("b"))
    return v.filter("model != 'scorer-main'").join(b, "id").groupBy("model").agg(F.count("*").alias("n"), r6(F.avg(F.col("v") - F.col("b"))).alias("difference"))
