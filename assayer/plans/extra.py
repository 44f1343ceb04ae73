"""Queries of guards, lookups, provenance, typed gates, format choice and report bars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import text as T
from assayer.operators.quantile import discrete, interpolated, values_at
from assayer.operators.ranking import quota, rank_by_hash
from assayer.plans.base import CAND, JUDGED, P, S, entries, judged, preds, query, quota_sql, r6, slim
from assayer.plans.metrics import GOOD
from assayer.plans.text import SIDE, SW, sided, worded
from assayer.plans.typed import AL, GT, T as TBL, TQ, VT, aligned, bench, gold_and_teacher, typed
from assayer.runtime import table
from assayer.sources import records as R


@query("b19_publish_projection", f"WITH {SW} SELECT id, kind, entry_class, coalesce(split, 'none') AS split, CASE WHEN expect.answer IS NOT NULL THEN 'text' WHEN expect.operation IS NOT NULL THEN 'call' ELSE 'none' END AS answer_kind FROM w")
def b19(spark, d):
    kind = F.when(F.col("expect.answer").isNotNull(), "text").when(F.col("expect.operation").isNotNull(), "call").otherwise("none")
    return worded(spark, d).select("id", "kind", "entry_class", F.coalesce("split", F.lit("none")).alias("split"), kind.alias("answer_kind"))


@query(
    "b27_vote_validation",
    f"""WITH {TQ}, b0 AS (SELECT id, question::JSON->'criteria' AS criteria FROM bn WHERE json_valid(question)),
q0 AS (SELECT id, qid, options FROM tq UNION ALL SELECT id, 'question', CASE WHEN json_type(criteria) = 'OBJECT' THEN json_keys(criteria) ELSE list_transform(range(0, json_array_length(criteria)::BIGINT), lambda i: i::VARCHAR) END FROM b0),
q AS (SELECT id, qid, list_transform(options, lambda o: lower(trim(o))) AS options FROM q0), v AS (SELECT item_id, question_id, lower(trim(label)) AS label FROM rater_votes)
SELECT CASE WHEN label IS NULL OR label = '' THEN 'blank' WHEN q.id IS NULL THEN 'unknown_question' WHEN NOT coalesce(list_contains(options, label), false) THEN 'unknown_label' ELSE 'valid' END AS state, count(*) AS n FROM v LEFT JOIN q ON q.id = v.item_id AND q.qid = v.question_id GROUP BY 1""",
)
def b27(spark, d):
    """States of all votes, on typed_rows and on bench_rows, whatever their ids."""
    asked = R.typed_questions(typed(spark, d)).select("id", "qid", "options").unionByName(R.bench_questions(bench(spark, d).filter(F.try_parse_json("question").isNotNull())).select("id", F.lit("question").alias("qid"), "options"))
    q = asked.select(F.col("id").alias("item_id"), F.col("qid").alias("question_id"), F.transform("options", lambda o: F.lower(F.trim(o))).alias("options"), F.lit(True).alias("asked"))
    v = table(spark, d, "rater_votes").select("item_id", "question_id", F.lower(F.trim("label")).alias("label"))
    known = F.coalesce(F.array_contains("options", F.col("label")), F.lit(False))
    state = F.when(F.col("label").isNull() | (F.col("label") == ""), "blank").when(F.col("asked").isNull(), "unknown_question").when(~known, "unknown_label").otherwise("valid")
    return v.join(q, ["item_id", "question_id"], "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("b28_scored_pool", f"WITH {P} SELECT model, bool_or(len(list_filter(coalesce(offered, []), lambda x: starts_with(x, 'escalate:'))) > 0) AS offers_reasons, count(offered) AS with_offer FROM p GROUP BY model")
def b28(spark, d):
    has = F.coalesce(F.exists("offered", lambda x: x.startswith("escalate:")), F.lit(False))
    return preds(spark, d).groupBy("model").agg(F.bool_or(has).alias("offers_reasons"), F.count("offered").alias("with_offer"))


@query("c3_duplicate_lookup", f"WITH {SW}, f AS (SELECT n, min(id) AS first FROM w WHERE split = 'train' AND n != '' GROUP BY n) SELECT w.id, f.first FROM w JOIN f USING (n) WHERE w.split = 'test'")
def c3(spark, d):
    w = worded(spark, d).filter("n != ''").select("id", "n", "split")
    first = w.filter("split = 'train'").groupBy("n").agg(F.min("id").alias("first"))
    return w.filter("split = 'test'").join(first, "n").select("id", "first")


@query("c7_supplement_append", f"WITH {SW}, e AS (SELECT DISTINCT n FROM w WHERE split IN ('validation', 'test') AND n != '') SELECT w.id, CASE WHEN coalesce(w.n, '') = '' THEN 'no_text' WHEN e.n IS NOT NULL THEN 'excluded' ELSE 'added' END AS state, coalesce(w.source, 'supplement') AS source FROM w LEFT JOIN e USING (n) WHERE w.kind = 'typo'")
def c7(spark, d):
    w = worded(spark, d).select("id", "n", "kind", "split", "source")
    held = w.filter("split IN ('validation', 'test') AND n != ''").select("n").distinct().withColumn("held", F.lit(True))
    state = F.when(F.coalesce("n", F.lit("")) == "", "no_text").when(F.col("held"), "excluded").otherwise("added")
    return w.filter("kind = 'typo'").join(held, "n", "left").select("id", state.alias("state"), F.coalesce("source", F.lit("supplement")).alias("source"))


@query("c13_agreement_series", f"WITH {GT} SELECT id, qid, CASE WHEN label = teacher THEN 1 ELSE 0 END::DOUBLE AS same FROM gt")
def c13(spark, d):
    return gold_and_teacher(spark, d).select("id", "qid", F.when(F.col("label") == F.col("teacher"), 1.0).otherwise(0.0).alias("same"))


@query("c15_source_table", f"WITH {TQ}, x AS (SELECT regexp_replace(lower(t.workflow), '[^a-z0-9]', '', 'g') AS source, tq.kind, tq.id FROM tq JOIN t USING (id)) SELECT source, list_sort(list(DISTINCT kind)) AS kinds, count(DISTINCT id) AS records, count(DISTINCT id) >= 10 AS headline FROM x GROUP BY source")
def c15(spark, d):
    t = typed(spark, d)
    x = R.typed_questions(t).select("id", "kind").join(t.select("id", T.alnum_fold(F.col("workflow")).alias("source")), "id")
    return x.groupBy("source").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.countDistinct("id").alias("records")).withColumn("headline", F.col("records") >= 10)


@query("c19_name_hits", f"WITH {S} SELECT s.id, o.name FROM s JOIN operations o ON contains(lower(s.text), string_split(o.name, '_')[2])")
def c19(spark, d):
    """Texts that contain a listed name; the list is a dimension of the domain, a few dozen rows by contract."""
    names = F.broadcast(table(spark, d, "operations").select("name", F.get(F.split("name", "_"), F.lit(1)).alias("part")))
    e = entries(spark, d).select("id", F.lower("text").alias("t"))
    return e.join(names, F.col("t").contains(F.col("part"))).select("id", "name")


@query("c24_rater_provenance", "SELECT item_id, count(DISTINCT rater_id) AS raters, min(rater_id) AS first, count(DISTINCT rater_id) FILTER (WHERE contains(rater_id, 'central')) AS central FROM rater_votes GROUP BY item_id")
def c24(spark, d):
    return table(spark, d, "rater_votes").groupBy("item_id").agg(F.countDistinct("rater_id").alias("raters"), F.min("rater_id").alias("first"), F.countDistinct(F.when(F.col("rater_id").contains("central"), F.col("rater_id"))).alias("central"))


SPLIT_T = SIDE.replace("side", "split")


@query("c28_refused_intake", f"WITH {TBL} SELECT {SPLIT_T} AS split, count(*) AS votes FROM rater_votes v JOIN t ON t.id = v.item_id WHERE coalesce({SPLIT_T}, '') != 'train' GROUP BY 1")
def c28(spark, d):
    s = F.lower(F.trim("split"))
    name = F.when(s.isin("train", "training"), "train").when(s.isin("validation", "val", "dev"), "validation").when(s == "test", "test")
    t = typed(spark, d).select(F.col("id").alias("item_id"), name.alias("split")).filter("coalesce(split, '') != 'train'")
    return table(spark, d, "rater_votes").select("item_id").join(t, "item_id").groupBy("split").agg(F.count("*").alias("votes"))


@query("c31_approval_completeness", f"WITH {TQ}, v AS (SELECT DISTINCT item_id AS id, question_id AS qid FROM rater_votes WHERE label IS NOT NULL AND trim(label) != ''), a AS (SELECT id, qid, count(v.qid) AS voted FROM tq LEFT JOIN v USING (id, qid) GROUP BY ALL), r AS (SELECT id, count(*) AS questions, count(*) FILTER (WHERE voted > 0) AS voted FROM a GROUP BY id) SELECT id, questions, voted, voted = questions AS complete FROM r")
def c31(spark, d):
    """Questions of each row and how many have an answer of someone; a row is approved only if all have."""
    voted = table(spark, d, "rater_votes").filter("trim(label) != ''").select(F.col("item_id").alias("id"), F.col("question_id").alias("qid")).distinct().withColumn("v", F.lit(1))
    q = R.typed_questions(typed(spark, d)).select("id", "qid").join(voted, ["id", "qid"], "left")
    r = q.groupBy("id").agg(F.count("*").alias("questions"), F.count("v").alias("voted"))
    return r.withColumn("complete", F.col("voted") == F.col("questions"))


@query("c32_equal_maps", f"WITH {P} SELECT pos, list_sort(map_entries(raw_probabilities)) = list_sort(map_entries(candidates)) AS same FROM p WHERE raw_probabilities IS NOT NULL AND candidates IS NOT NULL")
def c32(spark, d):
    s = lambda c: F.array_sort(F.map_entries(c))
    return preds(spark, d).filter("raw_probabilities IS NOT NULL AND candidates IS NOT NULL").select("pos", (s("raw_probabilities") == s("candidates")).alias("same"))


@query(
    "d22_probe_report",
    f"""WITH {JUDGED}, {CAND}, x AS (SELECT j.id, j.kind, j.model, top.top FROM j JOIN top USING (pos) WHERE j.id IS NOT NULL), b AS (SELECT id, min(top) AS base FROM x WHERE model = 'scorer-main' GROUP BY id),
e AS (SELECT x.kind, x.id, count(*) AS trials, count(*) FILTER (WHERE x.top != b.base) AS changes FROM x JOIN b USING (id) WHERE x.model != 'scorer-main' GROUP BY ALL) SELECT kind, count(*) AS entries, sum(trials)::BIGINT AS trials, sum(changes)::BIGINT AS changes, round(sum(changes)::DOUBLE / sum(trials), 6) AS rate FROM e GROUP BY kind""",
)
def d22(spark, d):
    x = judged(spark, d).filter("candidates IS NOT NULL AND id IS NOT NULL").select("id", "kind", "model", F.col("top.key").alias("top"))
    b = x.filter("model = 'scorer-main'").groupBy("id").agg(F.min("top").alias("base"))
    e = x.filter("model != 'scorer-main'").join(b, "id").groupBy("kind", "id").agg(F.count("*").alias("trials"), F.count_if(F.expr("top != base")).alias("changes"))
    return e.groupBy("kind").agg(F.count("*").alias("entries"), F.sum("trials").alias("trials"), F.sum("changes").alias("changes"), r6(F.sum("changes") / F.sum("trials")).alias("rate"))


@query(
    "d38_typed_calibration",
    f"""WITH {AL}, g AS (SELECT id, qid, max(q) AS top_p, arg_max(opt, q + (1000 - i) * 1e-9) AS pred FROM al GROUP BY ALL), x AS (SELECT tg.kind, g.top_p, (g.pred = tg.label)::INT AS ok FROM g JOIN tg USING (id, qid) WHERE tg.label IS NOT NULL),
h AS (SELECT CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind, least(floor(round(top_p * 10, 9)), 9)::INT AS bin, count(*) AS n, avg(top_p) AS c, avg(ok) AS a FROM x GROUP BY GROUPING SETS ((kind, bin), (bin))) SELECT kind, sum(n)::BIGINT AS n, round(sum(n * abs(a - c)) / sum(n), 6) AS ece FROM h GROUP BY kind""",
)
def d38(spark, d):
    x = aligned(spark, d).filter("label IS NOT NULL").withColumn("at", L.first_argmax(F.col("q")))
    x = x.select("kind", F.array_max("q").alias("top_p"), (F.get("names", F.col("at")) == F.col("label")).cast("double").alias("ok")).withColumn("bin", L.bin_index(F.col("top_p")))
    h = x.groupingSets([[F.col("kind"), F.col("bin")], [F.col("bin")]], "kind", "bin").agg(F.grouping("kind").alias("g"), F.count("*").alias("n"), F.avg("top_p").alias("c"), F.avg("ok").alias("a"))
    k = F.when(F.col("g") == 1, "all").otherwise(F.col("kind"))
    return h.groupBy(k.alias("k")).agg(F.sum("n").alias("n"), r6(F.sum(F.col("n") * F.abs(F.col("a") - F.col("c"))) / F.sum("n")).alias("ece")).withColumnRenamed("k", "kind")


@query(
    "d39_benchmark_rollup",
    f"""WITH {JUDGED}, {CAND} SELECT j.model, count(*) AS "rows", count(*) FILTER (WHERE outcome = 'invalid') AS failures, round(quantile_cont(latency_ms, 0.5) FILTER (WHERE latency_ms >= 0 AND NOT isnan(latency_ms)), 6) AS median_ms, round(avg((coalesce(top.top = gold, false))::INT), 6) AS top1 FROM j LEFT JOIN top USING (pos) GROUP BY j.model""",
)
def d39(spark, d):
    j = slim(spark, d, "model", "outcome", "latency_ms", F.coalesce(F.col("top.key") == F.col("gold"), F.lit(False)).alias("ok"))
    low, high, share = interpolated(0.5)
    ms = values_at(j.filter(GOOD), ["model"], "latency_ms", {"low": low, "high": high}).select("model", r6(F.col("low") + (F.col("high") - F.col("low")) * share).alias("median_ms"))
    a = j.groupBy("model").agg(F.count("*").alias("rows"), F.count_if(F.col("outcome") == "invalid").alias("failures"), r6(F.avg(F.col("ok").cast("double"))).alias("top1"))
    return a.join(ms, "model", "left").select("model", "rows", "failures", "median_ms", "top1")


@query("d40_training_evaluation", f"WITH {JUDGED}, {CAND} SELECT j.model, count(*) AS n, round(avg(-ln(greatest(coalesce(r.v, 0), 1e-12))), 6) AS ce, round(avg((top.top = gold)::INT), 6) AS accuracy, round(avg(top_p), 6) AS mean_top FROM j JOIN top USING (pos) LEFT JOIN roll r ON r.pos = j.pos AND r.label = j.gold WHERE j.gold IS NOT NULL GROUP BY j.model")
def d40(spark, d):
    j = judged(spark, d).filter("candidates IS NOT NULL AND gold IS NOT NULL")
    return j.groupBy("model").agg(F.count("*").alias("n"), r6(F.avg(L.log_loss(L.mass_of(F.col("rolled"), F.col("gold"))))).alias("ce"), r6(F.avg((F.col("top.key") == F.col("gold")).cast("double"))).alias("accuracy"), r6(F.avg("top.value")).alias("mean_top"))


@query("e4_readout_choice", f"WITH {P}, c AS (SELECT pos, unnest(map_keys(raw_scores)) AS label, unnest(map_values(raw_scores)) AS v FROM p WHERE offered IS NOT NULL), x AS (SELECT c.*, coalesce(nullif(list_position(p.offered, c.label), 0), 1000000) AS place FROM c JOIN p USING (pos)) SELECT pos, label AS choice FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY v DESC, place, label) AS n FROM x) WHERE n = 1")
def e4(spark, d):
    """The first maximum in listing order."""
    entries_ = F.transform(F.map_entries("raw_scores"), lambda e: F.struct((-e["value"]).alias("v"), F.coalesce(F.nullif(F.array_position("offered", e["key"]), F.lit(0)), F.lit(1000000)).alias("place"), e["key"].alias("label")))
    return preds(spark, d).filter("raw_scores IS NOT NULL AND offered IS NOT NULL AND size(raw_scores) > 0").select("pos", F.array_min(entries_)["label"].alias("choice"))


@query("f3_limit", f"WITH {SW} SELECT id, source_id FROM w WHERE split = 'train' ORDER BY id LIMIT 50")
def f3(spark, d):
    return worded(spark, d).filter("split = 'train'").select("id", "source_id").orderBy("id").limit(50)


@query("h27_publishable_text", rf"WITH x AS (SELECT doc_id, regexp_replace(text, '\b(?:10|192\.168|172\.(?:1[6-9]|2\d|3[01]))(?:\.\d{{1,3}}){{1,2}}\.(\d{{1,3}})\b', '192.0.2.\1', 'g') AS t, text FROM documents) SELECT doc_id, md5(t) AS digest, t != text AS changed FROM x WHERE text IS NOT NULL")
def h27(spark, d):
    t = F.regexp_replace("text", r"\b(?:10|192\.168|172\.(?:1[6-9]|2\d|3[01]))(?:\.\d{1,3}){1,2}\.(\d{1,3})\b", "192.0.2.$1")
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(t).alias("digest"), (t != F.col("text")).alias("changed"))


@query("h28_state_strings", f"WITH {TBL} SELECT id, state::JSON->>'$.unit.name' AS unit, state::JSON->>'$.note' AS note, json_array_length(state::JSON->'limits')::INT AS limits FROM t WHERE json_valid(state)")
def h28(spark, d):
    s = R.parsed(F.col("state"), "struct<unit:struct<name:string>,note:string,limits:array<string>>")
    n = F.when(F.col("s.limits").isNotNull(), F.size("s.limits"))
    return typed(spark, d).withColumn("s", s).filter(F.try_parse_json("state").isNotNull()).select("id", F.col("s.unit.name").alias("unit"), F.col("s.note").alias("note"), n.alias("limits"))


@query("h32_option_edit", f"WITH {AL}, o AS (SELECT id, qid, opt, q * 0.9 AS v FROM al UNION ALL SELECT DISTINCT id, qid, 'zz_other', 0.1 FROM al) SELECT id, qid, opt, round(v, 6) AS v FROM o")
def h32(spark, d):
    """An option added with a tenth of the mass."""
    x = aligned(spark, d).select("id", "qid", F.array_append("names", F.lit("zz_other")).alias("names"), F.array_append(F.transform("q", lambda v: v * 0.9), F.lit(0.1)).alias("v"))
    return x.select("id", "qid", F.explode(F.arrays_zip("names", "v")).alias("e")).select("id", "qid", F.col("e.names").alias("opt"), r6(F.col("e.v")).alias("v"))


@query("h36_attribution", f"WITH {S} SELECT kind, array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source IS NOT NULL)), '; ') AS notice FROM s GROUP BY kind")
def h36(spark, d):
    return entries(spark, d).groupBy("kind").agg(F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("notice"))


@query("h38_decision_rule", f"WITH {VT}, g AS (SELECT id, qid, count(*) AS labels, max(c) AS top, sum(c) AS n, count(*) FILTER (WHERE n = 1) AS x, max(c) FILTER (WHERE n = 2) AS second FROM vs GROUP BY ALL) SELECT CASE WHEN labels = 1 THEN 'unanimous' WHEN top = second THEN 'tie' WHEN 2 * top > n THEN 'majority' ELSE 'plurality' END AS rule, count(*) AS n FROM g GROUP BY 1")
def h38(spark, d):
    v = table(spark, d, "rater_votes").filter("label IS NOT NULL AND trim(label) != ''").select("item_id", "question_id", "rater_id", F.lower(F.trim("label")).alias("label")).distinct()
    c = v.groupBy("item_id", "question_id", "label").agg(F.count("*").alias("c"))
    g = c.groupBy("item_id", "question_id").agg(F.sort_array(F.collect_list("c"), asc=False).alias("cs"), F.sum("c").alias("n"))  # one entry a label
    top = F.get("cs", F.lit(0))
    rule = F.when(F.size("cs") == 1, "unanimous").when(top == F.get("cs", F.lit(1)), "tie").when(2 * top > F.col("n"), "majority").otherwise("plurality")
    return g.groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))


@query("h39_weight_budget", "SELECT model, weight_bits * 110000000::BIGINT // 8 AS bytes, weight_bits * 110000000::BIGINT // 8 < 100000000 AS within FROM models")
def h39(spark, d):
    """Bytes of a model's weights, of a parameter count given by the caller, strictly below a budget."""
    size = F.floor(F.col("weight_bits").cast("bigint") * 110_000_000 / 8).cast("bigint")
    return table(spark, d, "models").select("model", size.alias("bytes"), (size < 100_000_000).alias("within"))


SIZED = 60  # units of validation and of test


@query(
    "i2_sized_split",
    f"""WITH {S}, g AS (SELECT coalesce(source_id, id) AS unit, min(kind || '|' || coalesce(entry_class, '')) AS stratum FROM s GROUP BY 1), n AS (SELECT stratum, count(*) AS n, (SELECT count(*) FROM g) AS everyone FROM g GROUP BY 1), r AS (SELECT g.*, row_number() OVER (PARTITION BY g.stratum ORDER BY sha256('17:' || unit), unit) AS k FROM g)
SELECT unit, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'validation' ELSE 'test' END AS side FROM r JOIN {quota_sql("stratum", "n", (f"1 - 2.0 * least({SIZED}, everyone / 3) / everyone", f"1.0 * least({SIZED}, everyone / 3) / everyone", f"1.0 * least({SIZED}, everyone / 3) / everyone"))} q USING (stratum)""",
)
def i2(spark, d):
    """Validation and test of SIZED units each (a third at most), dealt to the (kind, class) strata by largest remainder; the rest is train."""
    g = entries(spark, d).groupBy(F.coalesce("source_id", "id").alias("unit")).agg(F.min(F.concat("kind", F.lit("|"), F.coalesce("entry_class", F.lit("")))).alias("stratum"))
    every = g.agg(F.count("*").alias("everyone"))  # one row
    part = F.lit(1.0) * F.least(F.lit(float(SIZED)), F.col("everyone") / 3) / F.col("everyone")
    whole = F.lit(1) - F.lit(2.0) * F.least(F.lit(float(SIZED)), F.col("everyone") / 3) / F.col("everyone")
    n = g.groupBy("stratum").agg(F.count("*").alias("n")).join(F.broadcast(every)).withColumn("q", quota(F.col("n"), [whole, part, part]))
    return rank_by_hash(g.withColumn("h", F.sha2(F.concat(F.lit("17:"), "unit"), 256)), ["stratum"], "h", "unit").join(n, "stratum").select("unit", sided().alias("side"))


@query("i5_dataset_build", f"WITH {SW}, k AS (SELECT *, ('0x' || left(sha256('3:' || coalesce(source_id, id)), 15))::BIGINT % 1000 AS h FROM w WHERE split IS NOT NULL AND coalesce(n, '') != '' AND len(words) <= 60) SELECT source, CASE WHEN h < 100 THEN 'held_out' WHEN h < 676 THEN 'fit' WHEN h < 820 THEN 'selection' ELSE 'test' END AS side, count(*) AS n FROM k GROUP BY ALL")
def i5(spark, d):
    h = T.seeded_hash("3", F.coalesce("source_id", "id"), 15).cast("bigint") % 1000
    k = worded(spark, d).filter("split IS NOT NULL AND coalesce(n, '') != '' AND size(words) <= 60").withColumn("h", h)
    return k.groupBy("source", F.when(F.col("h") < 100, "held_out").when(F.col("h") < 676, "fit").when(F.col("h") < 820, "selection").otherwise("test").alias("side")).agg(F.count("*").alias("n"))


UNITS = f"""{AL}, u0 AS (SELECT id, qid, count(*) AS k, max(q) AS top, arg_max(opt, q + (1000 - i) * 1e-9) AS pred, list_sort(list(q))[-2] AS second, -sum(CASE WHEN q > 0 THEN q * ln(q) ELSE 0 END) / ln(count(*)) AS ent FROM al GROUP BY ALL), u AS (SELECT u0.*, tg.kind, coalesce(u0.pred = tg.label, false) AS ok FROM u0 JOIN tg USING (id, qid))"""


def units(spark, d):
    q = F.col("q")
    x = aligned(spark, d).withColumn("pred", F.get("names", L.first_argmax(q))).withColumn("top", F.array_max("q")).withColumn("second", F.get(F.sort_array("q", asc=False), F.lit(1)))
    ent = -L.total(F.transform("q", lambda v: F.when(v > 0, v * F.ln(v)).otherwise(0.0))) / F.ln(F.size("q").cast("double"))
    return x.select("id", "qid", "kind", "top", "second", ent.alias("ent"), F.coalesce(F.col("pred") == F.col("label"), F.lit(False)).alias("ok"))


@query("j5_typed_gate", f"WITH {UNITS} SELECT id, qid, CASE WHEN top < 0.55 THEN 'floor' WHEN top - second < 0.25 THEN 'margin' WHEN ent > 0.93 THEN 'entropy' END AS why FROM u")
def j5(spark, d):
    why = F.when(F.col("top") < 0.55, "floor").when(F.col("top") - F.col("second") < 0.25, "margin").when(F.col("ent") > 0.93, "entropy")
    return units(spark, d).select("id", "qid", why.alias("why"))


J8_GRID = [(f, m, e) for f in (None, 0.45, 0.55, 0.7, 0.85) for m in (None, 0.2) for e in (None, 0.9)]
J8_ROWS = ", ".join(f"({i}, " + ", ".join("NULL::DOUBLE" if x is None else f"{x}::DOUBLE" for x in point) + ")" for i, point in enumerate(J8_GRID))


@query(
    "j8_typed_gate_fit",
    f"""WITH {UNITS}, g(grid, f, m, e) AS (VALUES {J8_ROWS}),
a AS (SELECT u.kind, g.grid, CASE WHEN md5(id) < '8' THEN 'fit' ELSE 'selection' END AS fold, ok, coalesce(top >= f, true) AND coalesce(top - second >= m, true) AND coalesce(ent <= e, true) AS answered FROM u, g),
s AS (SELECT kind, fold, grid, avg(answered::INT) AS cov, avg(ok::INT) FILTER (WHERE answered) AS acc FROM a GROUP BY ALL),
b AS (SELECT kind, grid FROM s WHERE fold = 'fit' AND acc IS NOT NULL AND cov + 1e-9 >= 0.5 QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(acc, 9) DESC, round(cov, 9) DESC, grid) = 1)
SELECT kind, grid::INT AS grid, fold, round(cov, 6) AS coverage, round(acc, 6) AS accuracy FROM s JOIN b USING (kind, grid)""",
)
def j8(spark, d):
    """Per kind the feasible point of best selective accuracy on the fit fold, then coverage, then first in the grid; the selection fold is reported, never looked at."""
    grid = spark.createDataFrame([(i, *point) for i, point in enumerate(J8_GRID)], "grid int, f double, m double, e double")
    yes = lambda c: F.coalesce(c, F.lit(True))
    x = units(spark, d).withColumn("fold", F.when(F.md5("id") < "8", "fit").otherwise("selection")).crossJoin(F.broadcast(grid))  # 20 points
    x = x.withColumn("answered", yes(F.col("top") >= F.col("f")) & yes(F.col("top") - F.col("second") >= F.col("m")) & yes(F.col("ent") <= F.col("e")))
    s = x.groupBy("kind", "fold", "grid").agg(F.avg(F.col("answered").cast("double")).alias("cov"), F.avg(F.when(F.col("answered"), F.col("ok").cast("double"))).alias("acc"))
    can = s.filter("fold = 'fit' AND acc IS NOT NULL AND cov + 1e-9 >= 0.5")
    best = can.groupBy("kind").agg(F.min(F.struct((-F.round("acc", 9)).alias("a"), (-F.round("cov", 9)).alias("c"), "grid"))["grid"].alias("grid"))
    return s.join(best, ["kind", "grid"]).select("kind", "grid", "fold", r6(F.col("cov")).alias("coverage"), r6(F.col("acc")).alias("accuracy"))


FORMATS = f"""{JUDGED}, f AS (SELECT m.weight_bits, count(*) FILTER (WHERE wrong_operation OR wrong_arguments)::DOUBLE / count(*) AS wrong, avg("right"::INT) FILTER (WHERE kind = 'operation') AS rate, quantile_disc(latency_ms, 0.5) FILTER (WHERE latency_ms >= 0 AND NOT isnan(latency_ms)) AS ms FROM j JOIN models m USING (model) GROUP BY 1)"""


def formats(spark, d):
    j = slim(spark, d, "model", "kind", "right", "wrong_operation", "wrong_arguments", "latency_ms").join(table(spark, d, "models").select("model", "weight_bits"), "model")
    ms = values_at(j.filter(GOOD), ["weight_bits"], "latency_ms", {"ms": discrete(0.5)}).select("weight_bits", "ms")
    a = j.groupBy("weight_bits").agg((F.count_if(F.col("wrong_operation") | F.col("wrong_arguments")) / F.count("*")).alias("wrong"), F.avg(F.when(F.col("kind") == "operation", F.col("right").cast("double"))).alias("rate"))
    return a.join(ms, "weight_bits", "left")


@query("j11_choose_format", f"WITH {FORMATS}, b AS (SELECT rate FROM f WHERE weight_bits = 16), d AS (SELECT f.*, 100 * (b.rate - f.rate) AS drop_points FROM f, b WHERE wrong <= 0.5) SELECT weight_bits, drop_points > 3 AS heal FROM d ORDER BY drop_points > 3, CASE WHEN drop_points > 3 THEN drop_points ELSE 0 END, weight_bits, ms LIMIT 1")
def j11(spark, d):
    """Safe formats; within three points of the widest the smallest, else the least drop, to be healed. One row a format."""
    f = formats(spark, d)
    base = f.filter("weight_bits = 16").select(F.col("rate").alias("base"))
    x = f.filter("wrong <= 0.5").crossJoin(F.broadcast(base)).withColumn("drop_points", 100 * (F.col("base") - F.col("rate"))).withColumn("heal", F.col("drop_points") > 3)
    return x.orderBy("heal", F.when(F.col("heal"), F.col("drop_points")).otherwise(0.0), "weight_bits", "ms").limit(1).select("weight_bits", "heal")


@query("j13_report_bars", f"WITH {FORMATS}, b(bar, goal) AS (VALUES ('rate', 0.005), ('wrong', 0.6), ('latency', 400.0)) SELECT f.weight_bits, b.bar, CASE b.bar WHEN 'rate' THEN rate >= goal WHEN 'wrong' THEN wrong <= goal ELSE ms <= goal END AS met FROM f, b")
def j13(spark, d):
    bars = spark.createDataFrame([("rate", 0.005), ("wrong", 0.6), ("latency", 400.0)], "bar string, goal double")
    met = F.when(F.col("bar") == "rate", F.col("rate") >= F.col("goal")).when(F.col("bar") == "wrong", F.col("wrong") <= F.col("goal")).otherwise(F.col("ms") <= F.col("goal"))
    return formats(spark, d).crossJoin(F.broadcast(bars)).select("weight_bits", "bar", met.alias("met"))


@query("k6_running_peak", f"WITH {P}, h AS (SELECT model, (recorded_at AT TIME ZONE 'UTC')::DATE AS day, max(tokens) AS peak FROM p GROUP BY ALL) SELECT model, day, max(peak) OVER (PARTITION BY model ORDER BY day ROWS UNBOUNDED PRECEDING) AS peak FROM h")
def k6(spark, d):
    """The peak so far per model and day: days are added up first, so the window sees days, not rows."""
    h = preds(spark, d).groupBy("model", F.to_date("recorded_at").alias("day")).agg(F.max("tokens").alias("peak"))
    return h.select("model", "day", F.max("peak").over(Window.partitionBy("model").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("peak"))
