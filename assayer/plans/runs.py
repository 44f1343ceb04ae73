"""Queries of sinks, manifests, guards, caches, budgets, injected models and report lines."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import text as T
from assayer.operators import rules, seams
from assayer.operators.ranking import running
from assayer.plans.base import JUDGED, P, S, entries, judged, preds, query, r6, slim
from assayer.plans.text import SIDE, side
from assayer.runtime import cut_lineage, shared_dir, table
from assayer.sources import sinks


def _place(spark) -> str:
    return f"{shared_dir(spark)}/assayer-sink-{uuid.uuid4().hex}"


@query("a3_predictions_sink", f"WITH {P} SELECT model, count(*) AS n, count(operation) AS operations, count(invalid_reason) AS reasons FROM p GROUP BY model")
def a3(spark, d):
    """Written as JSON lines, null optional fields left out, and read again."""
    out = preds(spark, d).select("pos", "id", "model", "outcome", "operation", "invalid_reason")
    path = _place(spark)
    sinks.write_json_lines(out, path, ["pos", "id", "model", "outcome"])
    return sinks.read_json_lines(spark, path, out.schema, "pos").groupBy("model").agg(F.count("*").alias("n"), F.count("operation").alias("operations"), F.count("invalid_reason").alias("reasons"))


@query("a8_sides_sink", f"WITH {S} SELECT coalesce({SIDE}, 'none') AS side, count(*) AS n, sum(length(text))::BIGINT AS characters FROM s GROUP BY 1")
def a8(spark, d):
    path = _place(spark)
    sinks.write_sides(entries(spark, d).select("id", "text", F.coalesce(side(), F.lit("none")).alias("side")), path)
    return spark.read.parquet(path).groupBy("side").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("characters"))


@query("a9_parquet_scan", "SELECT id, source, primitive FROM bench_rows WHERE split = 'train'")
def a9(spark, d):
    return table(spark, d, "bench_rows").filter("split = 'train'").select("id", "source", "primitive")


@query("a19_trace_round_trip", f"WITH {P} SELECT pos, outcome, coalesce(len(map_keys(raw_scores)), 0)::INT AS scores, coalesce(len(map_keys(arguments)), 0)::INT AS arguments FROM p")
def a19(spark, d):
    """A trace holds the raw output and what the policy made of it, nested; it is written as one JSON text and read by its schema."""
    t = preds(spark, d).select("pos", F.struct(F.struct("raw_scores", "tokens").alias("raw"), F.struct("outcome", "arguments").alias("policy")).alias("t"))
    back = t.select("pos", F.from_json(F.to_json("t"), t.schema["t"].dataType).alias("t"))
    size = lambda m: F.coalesce(F.size(F.map_keys(m)), F.lit(0))
    return back.select("pos", "t.policy.outcome", size("t.raw.raw_scores").alias("scores"), size("t.policy.arguments").alias("arguments"))


@query("a23_domain_dims", "SELECT name AS op, unnest(CASE WHEN pos >= 8 THEN ['unit', 'level'] ELSE ['unit'] END) AS arg, read_only FROM operations")
def a23(spark, d):
    from assayer.operators.decisions import op_args

    ops = table(spark, d, "operations")
    return ops.join(op_args(ops).withColumnRenamed("op", "name"), "name").select(F.col("name").alias("op"), F.explode("declared").alias("arg"), "read_only")


DIGEST = "('0x' || left(md5(coalesce(id, '') || ':' || coalesce(text, '')), 12))::BIGINT"


@query("a24_freeze_manifest", f"WITH {S} SELECT coalesce({SIDE}, 'none') AS role, count(*) AS n, sum({DIGEST})::DECIMAL(38,0) AS digest FROM s GROUP BY 1")
def a24(spark, d):
    """Per role: rows and a digest of their content that doesn't depend on order, so it is one aggregate."""
    return entries(spark, d).groupBy(F.coalesce(side(), F.lit("none")).alias("role")).agg(F.count("*").alias("n"), F.sum(T.row_digest("id", "text")).cast("decimal(38,0)").alias("digest"))


@query("a33_train_set", f"WITH {S}, pr AS (SELECT DISTINCT lower(trim(text)) AS t FROM s WHERE {SIDE} IN ('validation', 'test') AND text IS NOT NULL) SELECT id, kind FROM s WHERE ({SIDE} = 'train' OR train_only) AND text IS NOT NULL AND trim(text) != '' AND lower(trim(text)) NOT IN (SELECT t FROM pr)")
def a33(spark, d):
    """Train entries and train-only additions without any text that a protected side also has."""
    e = entries(spark, d).withColumn("split", side()).withColumn("t", F.lower(F.trim("text")))
    protected = e.filter("split IN ('validation', 'test') AND t IS NOT NULL").select("t").distinct()
    return e.filter("(split = 'train' OR train_only) AND t != ''").join(protected, "t", "left_anti").select("id", "kind")


@query("a34_lookup_by_hash", f"WITH {S} SELECT md5(text) AS hash, min(id) AS id, count(*) AS copies FROM s WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def a34(spark, d):
    return entries(spark, d).filter("text IS NOT NULL").groupBy(F.md5("text").alias("hash")).agg(F.min("id").alias("id"), F.count("*").alias("copies")).filter("copies > 1")


@query("b17_sealed_rows", f"WITH {S} SELECT {SIDE} AS side, count(*) AS n, {SIDE} IN ('test') AS sealed FROM s WHERE {SIDE} IS NOT NULL GROUP BY 1")
def b17(spark, d):
    e = entries(spark, d).select(side().alias("side")).filter("side IS NOT NULL")
    rules.refuse_sealed(e.filter("side != 'test'"), "side", "side")  # the guard lets open sides pass
    return e.groupBy("side").agg(F.count("*").alias("n")).withColumn("sealed", F.col("side") == "test")


@query(
    "b23_domain_problems",
    """SELECT 'operations' AS dim, name, unnest(list_filter([CASE WHEN trim(name) = '' THEN 'blank_name' END, CASE WHEN trim(coalesce(description, '')) = '' THEN 'no_description' END, CASE WHEN contains(name, ' ') THEN 'name_with_blank' END, CASE WHEN ends_with(description, '.') THEN NULL ELSE 'no_full_stop' END, CASE WHEN NOT read_only AND pos < 8 THEN 'early_mutation' END], lambda x: x IS NOT NULL)) AS problem FROM operations
 UNION ALL SELECT 'models', model, unnest(list_filter([CASE WHEN backbone IS NULL THEN 'no_backbone' END, CASE WHEN weight_bits NOT IN (4, 8, 16) THEN 'odd_bits' END], lambda x: x IS NOT NULL)) FROM models""",
)
def b23(spark, d):
    """Every way in which a dimension breaks its declaration, all reported."""
    rule = lambda hit, name: F.when(hit, F.lit(name))
    o = table(spark, d, "operations").select(
        F.lit("operations").alias("dim"), "name",
        F.explode(F.array_compact(F.array(rule(F.trim("name") == "", "blank_name"), rule(F.trim(F.coalesce("description", F.lit(""))) == "", "no_description"), rule(F.contains("name", F.lit(" ")), "name_with_blank"), rule(~F.coalesce(F.col("description").endswith("."), F.lit(False)), "no_full_stop"), rule(~F.col("read_only") & (F.col("pos") < 8), "early_mutation")))).alias("problem"),
    )
    m = table(spark, d, "models").select(F.lit("models").alias("dim"), F.col("model").alias("name"), F.explode(F.array_compact(F.array(rule(F.col("backbone").isNull(), "no_backbone"), rule(~F.col("weight_bits").isin(4, 8, 16), "odd_bits")))).alias("problem"))
    return o.unionByName(m)


@query("h23_tree_hash", f"WITH {S} SELECT source, sha256(string_agg(h, '' ORDER BY h)) AS tree FROM (SELECT source, left(md5(id), 2) AS b, sum(('0x' || left(md5(id || ':' || coalesce(text, '')), 12))::BIGINT)::DECIMAL(38,0)::VARCHAR || left(md5(id), 2) AS h FROM s WHERE source IS NOT NULL GROUP BY source, left(md5(id), 2)) GROUP BY source")
def h23(spark, d):
    """Digest of a tree of 256 leaves per source: a leaf adds up the digests of its rows, so no group is gathered."""
    e = entries(spark, d).filter("source IS NOT NULL").withColumn("leaf", F.substring(F.md5("id"), 1, 2))
    leaf = e.groupBy("source", "leaf").agg(F.concat(F.sum(T.row_digest("id", "text")).cast("decimal(38,0)").cast("string"), "leaf").alias("h"))
    return leaf.groupBy("source").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("tree"))


@query("h35_fake_quantisation", "SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN m = 0 THEN 0.0 ELSE round(round_even(x::DOUBLE / (m / 7), 0) * (m / 7), 6) END) AS q FROM (SELECT vec_id, embedding, list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS m FROM embeddings)")
def h35(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return e.select("vec_id", L.fake_quantised(F.col("e"), 4).alias("q"))


# ---------------------------------------------------------------------------------------------- caches and budgets


@query("k2_ledger_reconcile", "WITH a AS (SELECT pos, count(*) AS deliveries, bool_or(outcome IS NOT NULL AND outcome != 'invalid') AS answered, bool_or(outcome = 'invalid') AS invalid, max(CASE WHEN tokens >= 0 THEN tokens END) AS tokens FROM predictions GROUP BY pos) SELECT CASE WHEN answered THEN 'done' WHEN invalid THEN 'invalid' ELSE 'uncertain' END AS state, count(*) AS attempts, sum(deliveries - 1)::BIGINT AS again, coalesce(sum(tokens), 0)::BIGINT AS billed FROM a GROUP BY 1")
def k2(spark, d):
    """An attempt is billed once however often it was delivered; one without an answer stays uncertain, but is billed."""
    valid = F.when(F.col("tokens") >= 0, F.col("tokens"))
    a = table(spark, d, "predictions").groupBy("pos").agg(F.count("*").alias("deliveries"), F.bool_or(F.col("outcome").isNotNull() & (F.col("outcome") != "invalid")).alias("answered"), F.bool_or(F.col("outcome") == "invalid").alias("invalid"), F.max(valid).alias("tokens"))
    state = F.when(F.col("answered"), "done").when(F.col("invalid"), "invalid").otherwise("uncertain")
    return a.groupBy(state.alias("state")).agg(F.count("*").alias("attempts"), F.sum(F.col("deliveries") - 1).alias("again"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("billed"))


@query("k3_resumed_ids", f"WITH {S}, {P} SELECT id FROM s WHERE id NOT IN (SELECT id FROM p WHERE outcome != 'invalid' AND id IS NOT NULL)")
def k3(spark, d):
    return rules.resumed(entries(spark, d).select("id"), preds(spark, d).filter("outcome != 'invalid'"), "id")


@query("k4_teacher_cache", f"WITH {P}, q AS (SELECT pos, md5(id || ':' || model) AS key, outcome FROM p), c AS (SELECT key, min(pos) AS pos FROM q WHERE outcome != 'invalid' GROUP BY key) SELECT CASE WHEN c.key IS NULL THEN 'miss' WHEN q.pos <= c.pos THEN 'filled' ELSE 'hit' END AS state, count(*) AS n FROM q LEFT JOIN c USING (key) GROUP BY 1")
def k4(spark, d):
    """Answers by content hash; only valid ones are kept, and the first of them answers all later calls."""
    q = preds(spark, d).select("pos", F.md5(F.concat("id", F.lit(":"), "model")).alias("key"), "outcome")
    c = q.filter("outcome != 'invalid'").groupBy("key").agg(F.min("pos").alias("first"))
    state = F.when(F.col("first").isNull(), "miss").when(F.col("pos") <= F.col("first"), "filled").otherwise("hit")
    return q.join(c, "key", "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("k5_rate_limit", f"WITH {P}, m AS (SELECT model, date_trunc('hour', recorded_at) AS slot, count(*) AS n, sum(CASE WHEN tokens > 0 THEN tokens ELSE 0 END) AS t FROM p GROUP BY ALL) SELECT model, slot, n, greatest(n - 3, 0) AS held_back, (sum(t) OVER (PARTITION BY model ORDER BY slot ROWS UNBOUNDED PRECEDING))::BIGINT AS reserved FROM m WHERE slot IS NOT NULL")
def k5(spark, d):
    """Calls per model and hour, those above the limit, and the running reservation; slots are summed before any order is asked for."""
    positive = F.when(F.col("tokens") > 0, F.col("tokens")).otherwise(0)
    m = preds(spark, d).groupBy("model", F.date_trunc("hour", "recorded_at").alias("slot")).agg(F.count("*").alias("n"), F.sum(positive).alias("t")).filter("slot IS NOT NULL")
    ran = running(m, ["model"], F.date_trunc("month", F.col("slot")), ["slot"], F.col("t"), "reserved")
    return ran.select("model", "slot", "n", F.greatest(F.col("n") - 3, F.lit(0)).alias("held_back"), "reserved")


# -------------------------------------------------------------------------------------------------- injected models


@query("l2_scored", f"WITH {P}, x AS (SELECT pos, unnest(offered) AS label FROM p WHERE offered IS NOT NULL) SELECT pos, arg_min(label, (md5(label || ':' || pos), label)) AS choice FROM x GROUP BY pos")
def l2(spark, d):
    """A deterministic stand-in for a model, loaded once a task."""
    import hashlib

    def make():
        def score(b: pd.DataFrame) -> pd.DataFrame:
            pick = [min(o, key=lambda c, p=p: (hashlib.md5(f"{c}:{p}".encode()).hexdigest(), c)) for p, o in zip(b["pos"], b["offered"], strict=True)]
            return pd.DataFrame({"pos": b["pos"], "choice": pick})

        return score

    return rules.scored(preds(spark, d).filter("size(offered) > 0").select("pos", "offered"), make, "pos long, choice string")


@query("l3_statistic", f"WITH {JUDGED} SELECT model, count(*) AS n, round(quantile_disc(tokens, 0.5), 6)::DOUBLE AS statistic FROM j WHERE tokens >= 0 GROUP BY model")
def l3(spark, d):
    """Any statistic of a histogram: the callback sees (value, weight), never a group's rows; here the lower median."""
    j = judged(spark, d).filter("tokens >= 0")
    return seams.statistic_of(j, ["model"], "tokens", seams.lower_median)


@query("l5_token_counts", "SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x != ''))::BIGINT AS n FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^[ -~\\n\\r\\t]*$')")
def l5(spark, d):
    """An injected counter, called with batches."""
    docs = table(spark, d, "documents").filter(F.col("text").isNotNull() & F.col("text").rlike(r"^[ -~\n\r\t]*$"))
    return docs.select("doc_id", seams.token_counter(lambda texts: [len(t.split()) for t in texts])("text").alias("n"))


@query("l6_drafted_rows", f"WITH {S} SELECT id, generate_subscripts(string_split(trim(text), '. '), 1)::INT AS part, unnest(string_split(trim(text), '. ')) AS draft FROM s WHERE text IS NOT NULL AND trim(text) != ''")
def l6(spark, d):
    """A drafter makes several rows of one record."""

    def draft(record):
        return [(k, x) for k, x in enumerate(record["text"].strip(" ").split(". "), 1)]

    return seams.drafted(entries(spark, d).filter("trim(text) != ''").select("id", "text"), "id", draft, "part int, draft string")


# ------------------------------------------------------------------------------------------------------- report lines


@query("m2_metric_lines", f"WITH {JUDGED} SELECT model, '| ' || model || ' | ' || count(*) || ' | ' || count(*) FILTER (WHERE \"right\") || ' | ' || count(*) FILTER (WHERE mutating AND NOT \"right\") || ' |' AS line FROM j WHERE model IS NOT NULL GROUP BY model")
def m2(spark, d):
    g = judged(spark, d).filter("model IS NOT NULL").groupBy("model").agg(F.count("*").alias("n"), F.count_if("right").alias("ok"), F.count_if(F.col("mutating") & ~F.col("right")).alias("bad"))
    return g.select("model", T.table_line("model", "n", "ok", "bad").alias("line"))


@query("m4_statuses", f"WITH {P} SELECT model, count(*) AS calls, count(*) FILTER (WHERE outcome = 'invalid') AS failed, max(recorded_at) AS last, CASE WHEN count(*) FILTER (WHERE outcome = 'invalid') * 20 > count(*) THEN 'failing' ELSE 'running' END AS status FROM p GROUP BY model")
def m4(spark, d):
    bad = F.count_if(F.col("outcome") == "invalid")
    return preds(spark, d).groupBy("model").agg(F.count("*").alias("calls"), bad.alias("failed"), F.max("recorded_at").alias("last"), F.when(bad * 20 > F.count("*"), "failing").otherwise("running").alias("status"))


@query("m5_card_counts", f"WITH {S} SELECT coalesce(source, 'none') AS source, '| ' || coalesce(source, 'none') || ' | ' || count(*) || ' | ' || count(DISTINCT kind) || ' | ' || coalesce(sum(length(text)), 0) || ' |' AS line FROM s GROUP BY 1")
def m5(spark, d):
    g = entries(spark, d).groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count("*").alias("n"), F.countDistinct("kind").alias("kinds"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    return g.select("source", T.table_line("source", "n", "kinds", "chars").alias("line"))


TEMPERATURES = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
J16 = f"""{JUDGED}, f AS (SELECT *, CASE WHEN md5(id) < '8' THEN 'fit' ELSE 'selection' END AS fold FROM j WHERE candidates IS NOT NULL AND id IS NOT NULL),
t AS (SELECT unnest([{", ".join(map(str, TEMPERATURES))}]::DOUBLE[]) AS temperature),
c AS (SELECT pos, fold, gold, e.key AS label, greatest(e.value, 1e-9) AS v FROM (SELECT *, unnest(map_entries(candidates)) AS e FROM f)),
z AS (SELECT pos, fold, gold, temperature, sum(pow(v, 1 / temperature)) AS total, sum(CASE WHEN {{canon}} = {{gold}} THEN pow(v, 1 / temperature) ELSE 0 END) AS own, bool_or({{canon}} = {{gold}}) AS there, max(pow(v, 1 / temperature)) AS top, arg_min(label, (-v, label)) AS choice FROM c, t GROUP BY ALL),
n AS (SELECT temperature, sum(-ln(greatest(own / total, 1e-12))) AS nll FROM z WHERE fold = 'fit' AND there GROUP BY 1),
b AS (SELECT arg_min(temperature, (round(nll, 6), temperature)) AS best FROM n)
SELECT temperature, gate, count(*) AS n, count(*) FILTER (WHERE top / total >= gate) AS decided, count(*) FILTER (WHERE top / total >= gate AND {{choice}} = {{gold}}) AS ok FROM z, b, (SELECT unnest([0.3, 0.5, 0.7, 0.9]::DOUBLE[]) AS gate) WHERE fold = 'selection' AND temperature = best GROUP BY 1, 2"""
_canon = lambda x: f"(CASE WHEN {x} = 'escalate' OR starts_with({x}, 'escalate:') THEN 'escalate' ELSE {x} END)"


@query("j16_calibrate_and_gate", "WITH " + J16.replace("{canon}", _canon("label")).replace("{gold}", _canon("gold")).replace("{choice}", _canon("choice")))
def j16(spark, d):
    """The temperature of least loss on the fit fold, then what each gate decides on the selection fold: both are one pass of added-up grids."""
    fold = F.when(F.md5("id") < "8", "fit").otherwise("selection")
    f = judged(spark, d).filter("candidates IS NOT NULL AND id IS NOT NULL").select("pos", fold.alias("fold"), L.canonical(F.col("gold")).alias("gold"), "candidates")
    entry = F.map_entries(F.transform_values("candidates", lambda _, v: F.greatest(v, F.lit(1e-9))))
    g = f.withColumn("e", entry).withColumn("temperature", F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])))
    powered = F.transform("e", lambda x: F.struct((-x["value"]).alias("m"), x["key"].alias("label"), F.pow(x["value"], 1 / F.col("temperature")).alias("p")))
    g = g.withColumn("e", powered)
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["p"])
    mine = F.filter("e", lambda x: L.canonical(x["label"]) == F.col("gold"))
    z = g.select("pos", "fold", "gold", "temperature", add("e").alias("total"), add(mine).alias("own"), (F.size(mine) > 0).alias("there"), F.array_min("e").alias("top"))
    nll = z.filter("fold = 'fit' AND there").groupBy("temperature").agg(F.round(F.sum(-F.log(F.greatest(F.col("own") / F.col("total"), F.lit(1e-12)))), 6).alias("nll"))
    best = nll.agg(F.min_by("temperature", F.struct("nll", "temperature")).alias("temperature"))  # one row
    s = z.filter("fold = 'selection'").join(F.broadcast(best), "temperature").withColumn("gate", F.explode(F.array(*[F.lit(x) for x in (0.3, 0.5, 0.7, 0.9)])))
    decided = F.col("top.p") / F.col("total") >= F.col("gate")
    return s.groupBy("temperature", "gate").agg(F.count("*").alias("n"), F.count_if(decided).alias("decided"), F.count_if(decided & (L.canonical(F.col("top.label")) == F.col("gold"))).alias("ok"))


@query("j10_verdicts", f"""WITH {JUDGED}, m AS (SELECT model, count(*) AS n, count(*) FILTER (WHERE wrong_operation OR wrong_arguments) AS wrong, count(*) FILTER (WHERE outcome = 'invalid') AS invalid, count(*) FILTER (WHERE "right") AS ok FROM j WHERE model IS NOT NULL GROUP BY model)
SELECT model, CASE WHEN wrong * 4 > n THEN 'stop' WHEN invalid * 10 > n THEN 'fix_grader' WHEN ok * 3 < n THEN 'diagnose' ELSE 'ship' END AS verdict FROM m""")
def j10(spark, d):
    m = judged(spark, d).filter("model IS NOT NULL").groupBy("model").agg(F.count("*").alias("n"), F.count_if(F.col("wrong_operation") | F.col("wrong_arguments")).alias("wrong"), F.count_if(F.col("outcome") == "invalid").alias("invalid"), F.count_if("right").alias("ok"))
    return m.select("model", F.when(F.col("wrong") * 4 > F.col("n"), "stop").when(F.col("invalid") * 10 > F.col("n"), "fix_grader").when(F.col("ok") * 3 < F.col("n"), "diagnose").otherwise("ship").alias("verdict"))


@query("j15_replay", f"WITH {JUDGED}, g AS (SELECT pos, id, model, row_number() OVER (PARTITION BY id, model ORDER BY pos) AS k, operation FROM j WHERE id IS NOT NULL AND model IS NOT NULL) SELECT a.model, count(*) AS replayed, count(*) FILTER (WHERE a.operation IS NOT DISTINCT FROM b.operation) AS same FROM g a JOIN g b ON a.id = b.id AND a.model = b.model AND a.k = 1 AND b.k = 2 GROUP BY a.model")
def j15(spark, d):
    """Frozen answers against a second run over the same entry by the same model."""
    g = judged(spark, d).filter("id IS NOT NULL AND model IS NOT NULL").select("pos", "id", "model", "operation")
    k = F.row_number().over(Window.partitionBy("id", "model").orderBy("pos"))  # a model has a few answers an entry
    two = g.withColumn("k", k).filter("k <= 2").groupBy("id", "model").agg(F.count("*").alias("n"), F.min(F.struct("k", "operation")).alias("a"), F.max(F.struct("k", "operation")).alias("b")).filter("n = 2")
    return two.groupBy("model").agg(F.count("*").alias("replayed"), F.count_if(F.col("a.operation").eqNullSafe(F.col("b.operation"))).alias("same"))


# ----------------------------------------------------------------------------------- backbones, endpoints, live worlds


class _Stub:
    """A backbone without a model: it prefers the label whose digest with the prompt is least."""

    name = "stub"

    def render(self, record):
        return f"{record['kind']}: {record['text']}"

    def predict(self, prompts):
        import hashlib

        return [min(("call", "explain", "hand over"), key=lambda c, p=p: hashlib.md5(f"{p}|{c}".encode()).hexdigest()) for p in prompts]


STUB = "list_sort([{'h': md5(kind || ': ' || text || '|call'), 'c': 'call'}, {'h': md5(kind || ': ' || text || '|explain'), 'c': 'explain'}, {'h': md5(kind || ': ' || text || '|hand over'), 'c': 'hand over'}])[1].c"


@query("l1_backbone", f"WITH {S} SELECT id, length(kind || ': ' || text)::BIGINT AS prompt, {STUB} AS choice FROM s WHERE text IS NOT NULL AND kind IS NOT NULL")
def l1(spark, d):
    """Records rendered and predicted batch by batch by whatever fits the Backbone protocol, made once a task."""

    def make():
        model = _Stub()

        def run(b: pd.DataFrame) -> pd.DataFrame:
            prompts = [model.render(r) for r in b.to_dict("records")]
            return pd.DataFrame({"id": b["id"], "prompt": [len(p) for p in prompts], "choice": model.predict(prompts)})

        return run

    return rules.scored(entries(spark, d).filter("text IS NOT NULL AND kind IS NOT NULL").select("id", "kind", "text"), make, "id string, prompt long, choice string")


@query("a30_endpoint_answers", f"WITH {S} SELECT answer, count(*) AS n FROM (SELECT CASE WHEN text IS NULL OR trim(text) = '' THEN 'refused' WHEN length(text) > 200 THEN 'too_long' ELSE 'answered' END AS answer FROM s) GROUP BY answer")
def a30(spark, d):
    """Rows from an endpoint, here a local stand-in: what it refuses is a row too, never a failed task."""

    def make():
        service = seams.Services(ask=lambda r: "refused" if not (r["text"] or "").strip(" ") else "too_long" if len(r["text"]) > 200 else "answered")
        return lambda b: pd.DataFrame({"answer": [service.call("ask", r) for r in b.to_dict("records")]})

    return rules.scored(entries(spark, d).select("text"), make, "answer string").groupBy("answer").agg(F.count("*").alias("n"))


WORLD = ("pump", "kiln", "winch", "weighbridge", "freezer", "conveyor")


@query("l7_live_lookup", f"WITH {S}, a AS (SELECT id, lower(e.value) AS v FROM (SELECT id, unnest(map_entries(expect.args)) AS e FROM s WHERE expect.args IS NOT NULL) WHERE e.key = 'unit') SELECT v AS unit, v IN {WORLD} AS known, count(*) AS n FROM a GROUP BY ALL")
def l7(spark, d):
    """Values of a ground kind, asked of the world once on the driver and sent along as a literal: a world is a few dozen names by contract."""
    world = seams.Services(world=lambda kind: WORLD if kind == "unit" else ()).call("world", "unit")
    a = entries(spark, d).filter("expect.args IS NOT NULL").select(F.explode("expect.args").alias("key", "v")).filter("key = 'unit'").select(F.lower("v").alias("unit"))
    return a.groupBy("unit", F.col("unit").isin(*world).alias("known")).agg(F.count("*").alias("n"))


@query("m3_sides_pools_models", f"WITH {JUDGED}, {S}, x AS (SELECT coalesce({SIDE}, 'none') AS side, s.kind AS pool, j.model, \"right\", escalated FROM j JOIN s USING (id)) SELECT side, pool, model, count(*) AS n, count(*) FILTER (WHERE \"right\") AS ok, count(*) FILTER (WHERE escalated) AS escalated FROM x GROUP BY ALL")
def m3(spark, d):
    e = entries(spark, d).select("id", F.coalesce(side(), F.lit("none")).alias("side"), F.col("kind").alias("pool"))
    x = slim(spark, d, "id", "model", "right", "escalated").join(e, "id")
    return x.groupBy("side", "pool", "model").agg(F.count("*").alias("n"), F.count_if("right").alias("ok"), F.count_if("escalated").alias("escalated"))


@query("m1_gate_report", f"WITH {JUDGED}, m AS (SELECT model, count(*) AS n, count(*) FILTER (WHERE wrong_operation OR wrong_arguments) AS wrong, count(*) FILTER (WHERE kind = 'escalate') AS asked, count(*) FILTER (WHERE kind = 'escalate' AND escalated) AS caught FROM j WHERE model IS NOT NULL GROUP BY model) SELECT model, n, wrong, round(caught::DOUBLE / nullif(asked, 0), 6) AS recall, CASE WHEN asked = 0 THEN 'not_applicable' WHEN wrong = 0 AND caught * 2 >= asked THEN 'pass' WHEN wrong = 0 THEN 'reported' ELSE 'fail' END AS gate FROM m")
def m1(spark, d):
    a = slim(spark, d, "model", "kind", "escalated", (F.col("wrong_operation") | F.col("wrong_arguments")).alias("bad"), where="model IS NOT NULL").groupBy("model").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("wrong"), F.count_if(F.col("kind") == "escalate").alias("asked"), F.count_if((F.col("kind") == "escalate") & F.col("escalated")).alias("caught")
    )
    gate = F.when(F.col("asked") == 0, "not_applicable").when((F.col("wrong") == 0) & (F.col("caught") * 2 >= F.col("asked")), "pass").when(F.col("wrong") == 0, "reported").otherwise("fail")
    return a.select("model", "n", "wrong", r6(F.try_divide("caught", "asked")).alias("recall"), gate.alias("gate"))


TRAIL = f"""{JUDGED}, m AS (SELECT model, round(avg((wrong_operation OR wrong_arguments)::INT), 9) AS w, round(coalesce(avg("right"::INT) FILTER (WHERE kind = 'operation'), 0), 9) AS r, round(coalesce(avg(escalated::INT) FILTER (WHERE kind = 'escalate'), 0), 9) AS c, round(coalesce(avg(tokens) FILTER (WHERE tokens >= 0), 1e9), 6) AS t FROM j WHERE model IS NOT NULL GROUP BY model),
s1 AS (SELECT * FROM m WHERE w <= (SELECT min(w) FROM m) + 0.05), s2 AS (SELECT * FROM s1 WHERE r >= 0.01), s3 AS (SELECT * FROM s2 WHERE r >= (SELECT max(r) FROM s2) - 0.05),
s4 AS (SELECT * FROM s3 WHERE c >= (SELECT max(c) FROM s3) - 0.1), s5 AS (SELECT * FROM s4 WHERE t <= (SELECT min(t) FROM s4) * 1.25), s6 AS (SELECT * FROM s5 WHERE model = (SELECT min(model) FROM s5))"""


@query("j9_survivor_trail", f"WITH {TRAIL} SELECT * FROM (" + " UNION ALL ".join(f"SELECT {k} AS step, count(*) AS survivors, min(model) AS first FROM s{k}" for k in range(1, 7)) + ")")
def j9_trail(spark, d):
    """Safety, floor, rate, recall and cost within a tolerance of the best survivor, then the name: who is left after each step. One row a model."""
    nine = lambda c, n=9: F.round(c, n)
    of = lambda kind, c: F.coalesce(F.avg(F.when(F.col("kind") == kind, F.col(c).cast("double"))), F.lit(0.0))
    m = slim(spark, d, "model", "kind", "right", "escalated", "tokens", (F.col("wrong_operation") | F.col("wrong_arguments")).alias("bad"), where="model IS NOT NULL").groupBy("model").agg(
        nine(F.avg(F.col("bad").cast("double"))).alias("w"), nine(of("operation", "right")).alias("r"), nine(of("escalate", "escalated")).alias("c"), nine(F.coalesce(F.avg(F.when(F.col("tokens") >= 0, F.col("tokens"))), F.lit(1e9)), 6).alias("t")
    )
    m = cut_lineage(m)  # every step reads it
    best = lambda s, c: s.crossJoin(F.broadcast(s.agg(c.alias("_b"))))  # noqa: E731  # one row
    steps = [
        lambda s: best(s, F.min("w")).filter("w <= _b + 0.05"), lambda s: s.filter("r >= 0.01"), lambda s: best(s, F.max("r")).filter("r >= _b - 0.05"),
        lambda s: best(s, F.max("c")).filter("c >= _b - 0.1"), lambda s: best(s, F.min("t")).filter("t <= _b * 1.25"), lambda s: best(s, F.min("model")).filter("model = _b"),
    ]
    s, trail = m, []
    for k, step in enumerate(steps, 1):
        s = step(s).select("model", "w", "r", "c", "t")
        trail.append(s.agg(F.lit(k).alias("step"), F.count("*").alias("survivors"), F.min("model").alias("first")))
    out = trail[0]
    for x in trail[1:]:
        out = out.unionByName(x)
    return out
