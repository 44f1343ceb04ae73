"""Queries of review logs, corrections, training rows, stripped arguments, perturbation trials and drafted pools."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import text as T
from assayer.operators import ledger
from assayer.operators.ranking import rank_by_hash
from assayer.plans.base import JUDGED, P, S, entries, judged, preds, query, r6
from assayer.plans.text import SIDE, side
from assayer.plans.typed import T as TBL, TG, TQ, typed
from assayer.runtime import table
from assayer.sources import records as R

VOTE = ["item_id", "question_id", "rater_id"]
VN = """vd AS (SELECT DISTINCT item_id, question_id, rater_id, lower(trim(label)) AS label, voted_at FROM rater_votes WHERE rater_id IS NOT NULL),
vn AS (SELECT *, row_number() OVER w AS seq, lag(label) OVER w AS before FROM vd WINDOW w AS (PARTITION BY item_id, question_id, rater_id ORDER BY voted_at NULLS FIRST, label NULLS FIRST))"""
TRAINABLE = f"""{VN}, cur AS (SELECT * FROM vn WHERE seq = 1),
dec AS (SELECT item_id, question_id, rater_id, seq, CASE WHEN coalesce(label, '') = '' THEN 'reject' WHEN label = before THEN 'keep' ELSE 'edit' END AS action, md5(coalesce(before, '')) AS cites, label AS payload FROM vn WHERE seq > 1),
ld AS (SELECT * FROM dec QUALIFY row_number() OVER (PARTITION BY item_id, question_id, rater_id ORDER BY seq DESC) = 1),
trainable AS (SELECT item_id, question_id, rater_id, CASE WHEN action = 'edit' THEN payload ELSE label END AS target FROM cur JOIN ld USING (item_id, question_id, rater_id) WHERE action != 'reject' AND cites = md5(coalesce(label, '')))"""


def vote_log(spark, d):
    """Votes as an append-only log: seq within (item, question, rater) and the label before. A rater's votes on one question are few."""
    v = table(spark, d, "rater_votes").filter("rater_id IS NOT NULL").select(*VOTE, F.lower(F.trim("label")).alias("label"), "voted_at").distinct()
    w = Window.partitionBy(*VOTE).orderBy(F.col("voted_at").asc_nulls_first(), F.col("label").asc_nulls_first())
    return v.withColumn("seq", F.row_number().over(w)).withColumn("before", F.lag("label").over(w))


def trainable(spark, d):
    log = vote_log(spark, d)
    action = F.when(F.coalesce("label", F.lit("")) == "", "reject").when(F.col("label") == F.col("before"), "keep").otherwise("edit")
    decisions = log.filter("seq > 1").select(*VOTE, "seq", action.alias("action"), ledger.label_hash(F.col("before")).alias("cites"), F.col("label").alias("payload"))
    return ledger.trainable(log.filter("seq = 1"), decisions, VOTE)


@query("a12_review_log", f"WITH {VN} SELECT item_id, question_id, rater_id, max(seq)::INT AS records, max_by(coalesce(label, ''), seq) AS last FROM vn GROUP BY ALL HAVING count(*) > 1")
def a12(spark, d):
    log = vote_log(spark, d)
    return ledger.latest(log.select(*VOTE, "seq", F.coalesce("label", F.lit("")).alias("last")), VOTE, ["seq"]).filter("seq > 1").select(*VOTE, F.col("seq").alias("records"), "last")


@query(
    "a13_corrections",
    f"""WITH {VN}, m AS (SELECT item_id, question_id, rater_id, max(seq) AS n FROM vn GROUP BY ALL)
SELECT CASE WHEN coalesce(label, '') = '' THEN 'blank' WHEN seq = 1 THEN 'first' WHEN label = before THEN 'confirmed' ELSE 'changed' END AS reason, CASE WHEN seq = n THEN 'current' ELSE 'superseded' END AS status, count(*) AS n
FROM vn JOIN m USING (item_id, question_id, rater_id) GROUP BY 1, 2""",
)
def a13(spark, d):
    log = vote_log(spark, d)
    last = log.groupBy(*VOTE).agg(F.max("seq").alias("n"))
    reason = F.when(F.coalesce("label", F.lit("")) == "", "blank").when(F.col("seq") == 1, "first").when(F.col("label") == F.col("before"), "confirmed").otherwise("changed")
    return log.join(last, VOTE).groupBy(reason.alias("reason"), F.when(F.col("seq") == F.col("n"), "current").otherwise("superseded").alias("status")).agg(F.count("*").alias("n"))


@query("c23_trainable_corrections", f"WITH {TRAINABLE} SELECT * FROM trainable")
def c23(spark, d):
    return trainable(spark, d)


@query(
    "a27_trainer_rows",
    f"WITH {TQ}, {TG} SELECT tq.id, tq.qid, tq.kind, tg.label, list_transform(options, lambda o: round(coalesce(json_extract_string(probs, '$.\"' || o || '\"')::DOUBLE, 0), 6)) AS targets FROM tq JOIN tg USING (id, qid) WHERE len(options) > 0",
)
def a27(spark, d):
    rows = typed(spark, d)
    g = R.typed_gold(rows).select("id", "qid", "label", "probabilities")
    q = R.typed_questions(rows).filter(F.size("options") > 0).join(g, ["id", "qid"])
    return q.select("id", "qid", "kind", "label", F.transform("options", lambda o: r6(F.coalesce(F.element_at("probabilities", o), F.lit(0.0)))).alias("targets"))


@query(
    "a29_review_seed",
    f"WITH {TBL}, {TG}, {TRAINABLE}, one AS (SELECT item_id AS id, question_id AS qid, min(target) AS target FROM trainable GROUP BY ALL) SELECT id, qid, coalesce(target, label) AS label, CASE WHEN target IS NULL THEN 'base' ELSE 'decision' END AS origin FROM tg LEFT JOIN one USING (id, qid)",
)
def a29(spark, d):
    one = trainable(spark, d).groupBy(F.col("item_id").alias("id"), F.col("question_id").alias("qid")).agg(F.min("target").alias("target"))
    base = R.typed_gold(typed(spark, d)).select("id", "qid", "label").join(one, ["id", "qid"], "left")
    return base.select("id", "qid", F.coalesce("target", "label").alias("label"), F.when(F.col("target").isNull(), "base").otherwise("decision").alias("origin"))


@query(
    "c9_correction_tier",
    f"""WITH {TBL}, {TG}, {TRAINABLE}, co AS (SELECT item_id AS id, question_id AS qid, min(target) AS target FROM trainable GROUP BY ALL)
SELECT CASE WHEN co.target IS NOT NULL THEN 'correction' WHEN coalesce(confidence, 0) < 0.5 THEN 'gold_only' ELSE 'gold_and_teacher' END AS tier, count(*) AS n FROM tg LEFT JOIN co USING (id, qid) GROUP BY 1""",
)
def c9b(spark, d):
    co = trainable(spark, d).groupBy(F.col("item_id").alias("id"), F.col("question_id").alias("qid")).agg(F.min("target").alias("target"))
    tier = F.when(F.col("target").isNotNull(), "correction").when(F.coalesce("confidence", F.lit(0.0)) < 0.5, "gold_only").otherwise("gold_and_teacher")
    return R.typed_gold(typed(spark, d)).join(co, ["id", "qid"], "left").groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


@query("a15_once_states", f"WITH {S}, o AS (SELECT {SIDE} AS side, entry_class AS part, source_id, row_number() OVER (PARTITION BY {SIDE}, entry_class, source ORDER BY written_at NULLS FIRST, id) AS n FROM s) SELECT side, part, CASE WHEN n = 1 THEN 'first' WHEN source_id IS NOT NULL THEN 'deviation' ELSE 'refused' END AS state, count(*) AS n FROM o GROUP BY 1, 2, 3")
def a15(spark, d):
    log = entries(spark, d).select(side().alias("side"), F.col("entry_class").alias("part"), "source", "source_id", "written_at", "id")
    ranked = first_of_keys(log)
    state = F.when(ranked["k"] == 1, "first").when(F.col("source_id").isNotNull(), "deviation").otherwise("refused")
    return ranked.groupBy("side", "part", state.alias("state")).agg(F.count("*").alias("n"))


def first_of_keys(log):
    """k is 1 for the first record of (side, part, source) and 2 for all others: the least (written_at, id) is an aggregate, so a hot key is no window."""
    keys = ["side", "part", "source"]
    at = F.struct(F.coalesce(F.col("written_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")).alias("at"), F.col("id"))
    first = log.groupBy(*keys).agg(F.min(at)["id"].alias("id")).select("id", F.lit(1).alias("k"))
    return log.join(first, "id", "left").withColumn("k", F.coalesce("k", F.lit(2)))


# ------------------------------------------------------------------------------------------------- row generation

STRIP = f"""{S}, a AS (SELECT id, text, expect.operation AS operation, e.key AS arg, e.value AS value FROM (SELECT *, unnest(map_entries(expect.args)) AS e FROM s WHERE expect.args IS NOT NULL AND text IS NOT NULL)),
z AS (SELECT *, regexp_matches(text, '(?i)(^|[^A-Za-z0-9])' || regexp_replace(trim(value), '([^A-Za-z0-9 ])', '\\\\\\1', 'g') || '([^A-Za-z0-9]|$)') AND trim(value) != '' AS named,
 regexp_replace(text, '(?i)(^|[^A-Za-z0-9])' || regexp_replace(trim(value), '([^A-Za-z0-9 ])', '\\\\\\1', 'g') || '([^A-Za-z0-9]|$)', '\\1that one\\2', 'g') AS stripped FROM a WHERE value IS NOT NULL),
st AS (SELECT id, operation, arg, stripped, CASE WHEN NOT named THEN 'no_argument_span' WHEN len(regexp_extract_all(stripped, '[A-Za-z0-9]+')) < 5 THEN 'too_short' WHEN contains(regexp_replace(lower(stripped), '[^a-z0-9]', '', 'g'), regexp_replace(lower(value), '[^a-z0-9]', '', 'g')) THEN 'value_remains' ELSE 'ok' END AS state FROM z)"""


def stripped(spark, d):
    """(id, operation, arg, stripped, state): the text with the value of one argument replaced by a vague reference, or why that was refused."""
    a = entries(spark, d).filter("expect.args IS NOT NULL AND text IS NOT NULL").select("id", "text", F.col("expect.operation").alias("operation"), F.explode("expect.args").alias("arg", "value")).filter("value IS NOT NULL")
    out, named = T.strip_value(F.col("text"), F.col("value"))
    z = a.withColumn("named", named).withColumn("stripped", out)
    state = (
        F.when(~F.col("named"), "no_argument_span")
        .when(F.size(F.regexp_extract_all("stripped", F.lit("[A-Za-z0-9]+"), F.lit(0))) < 5, "too_short")
        .when(F.contains(T.alnum_fold(F.col("stripped")), T.alnum_fold(F.col("value"))), "value_remains")
        .otherwise("ok")
    )
    return z.select("id", "operation", "arg", "stripped", state.alias("state"))


@query("h7_strip_argument", f"WITH {STRIP} SELECT id, arg, state, CASE WHEN state = 'ok' THEN stripped END AS stripped FROM st")
def h7(spark, d):
    return stripped(spark, d).select("id", "arg", "state", F.when(F.col("state") == "ok", F.col("stripped")).alias("stripped"))


@query("i9_stripped_rows", f"WITH {STRIP} SELECT id || '-' || arg AS id, id AS pair, operation, stripped AS text, true AS escalate FROM st WHERE state = 'ok' QUALIFY row_number() OVER (PARTITION BY operation ORDER BY sha256(id || '-' || arg), id) <= 5")
def i9(spark, d):
    s = stripped(spark, d).filter("state = 'ok'").withColumn("pair", F.col("id")).withColumn("id", F.concat("id", F.lit("-"), "arg"))
    return rank_by_hash(s.withColumn("h", F.sha2("id", 256)), ["operation"], "h", "pair").filter("k <= 5").select("id", "pair", "operation", F.col("stripped").alias("text"), F.lit(True).alias("escalate"))


TRIALS = f"""{P}, lab AS (SELECT pos, id, unnest(coalesce(offered, list_sort(map_keys(candidates)))) AS label, candidates FROM p WHERE candidates IS NOT NULL),
sc AS (SELECT pos, id, label, list_position(list, label) AS place, coalesce(candidates[label], 0) AS v FROM (SELECT lab.*, l.list FROM lab JOIN (SELECT pos, coalesce(offered, list_sort(map_keys(candidates))) AS list FROM p WHERE candidates IS NOT NULL) l USING (pos))),
tr AS (SELECT pos, id, kind, idx, label, v, place, md5(kind || ':' || idx || ':' || pos || ':' || label) AS h FROM sc, (SELECT kind, i AS idx FROM (SELECT unnest(['order', 'subset', 'both']) AS kind), (SELECT unnest([0, 1]) AS i))),
base AS (SELECT pos, arg_min(label, (-v, place)) AS choice FROM sc GROUP BY pos),
kept AS (SELECT tr.*, choice FROM tr JOIN base USING (pos) WHERE kind = 'order' OR h < '8' OR label = choice),
ch AS (SELECT pos, id, kind, idx, choice, count(*) AS n, CASE WHEN kind = 'subset' THEN arg_min(label, (-v, place)) ELSE arg_min(label, (-v, h)) END AS again FROM kept GROUP BY pos, id, kind, idx, choice)"""


def trials(spark, d):
    """(pos, id, kind, index, choice, n, again): each prediction under changed order, a random subset that keeps its choice, and both."""
    list_ = L.offered_labels(F.col("offered"), F.col("candidates"))
    p = preds(spark, d).filter("candidates IS NOT NULL").select("pos", "id", "candidates", list_.alias("labels"))
    value = lambda c: F.coalesce(F.element_at("candidates", c), F.lit(0.0))
    p = p.filter(F.size("labels") > 0).withColumn("scored", F.transform("labels", lambda c, i: F.struct((-value(c)).alias("v"), (i + 1).alias("at"), c.alias("label"))))
    p = p.select("pos", "id", "scored", F.array_min("scored")["label"].alias("choice"))
    grid = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("index")) for k in ("order", "subset", "both") for i in (0, 1)])
    g = p.withColumn("g", F.explode(grid)).select("pos", "id", "scored", "choice", "g.kind", "g.index")
    seed = F.concat_ws(":", "kind", "index", "pos")
    hashed = F.transform("scored", lambda s: F.struct(s["v"].alias("v"), F.md5(F.concat_ws(":", F.col("seed"), s["label"])).alias("h"), s["at"].alias("at"), s["label"].alias("label")))
    g = g.withColumn("seed", seed).withColumn("scored", hashed)
    g = g.withColumn("kept", F.when(F.col("kind") == "order", F.col("scored")).otherwise(F.filter("scored", lambda s: (s["h"] < "8") | (s["label"] == F.col("choice")))))
    placed = F.array_min(F.transform("kept", lambda s: F.struct(s["v"], s["at"], s["label"].alias("label"))))["label"]
    return g.select("pos", "id", "kind", "index", "choice", F.size("kept").alias("n"), F.when(F.col("kind") == "subset", placed).otherwise(F.array_min("kept")["label"]).alias("again"))


@query("i8_trials", f"WITH {TRIALS} SELECT pos, kind, idx::INT AS index, choice, n::INT AS n, again FROM ch")
def i8(spark, d):
    return trials(spark, d).select("pos", "kind", "index", "choice", "n", "again")


@query("d22_trial_changes", f"WITH {TRIALS} SELECT kind, count(*) AS trials, count(DISTINCT id) AS entries, count(*) FILTER (WHERE choice != again) AS changes, round(count(*) FILTER (WHERE choice != again) / count(*), 6) AS rate, count(*) FILTER (WHERE n < 2) AS incomplete FROM ch GROUP BY kind")
def d22(spark, d):
    changed = F.col("choice") != F.col("again")
    return trials(spark, d).groupBy("kind").agg(F.count("*").alias("trials"), F.countDistinct("id").alias("entries"), F.count_if(changed).alias("changes"), r6(F.count_if(changed) / F.count("*")).alias("rate"), F.count_if(F.col("n") < 2).alias("incomplete"))


@query("i10_augment_plan", f"WITH {S} SELECT source_id, count(*) AS have, 4 - count(*) AS wanted FROM s WHERE source_id IS NOT NULL AND {SIDE} = 'train' GROUP BY 1 HAVING count(*) < 4")
def i10(spark, d):
    n = F.count("*")
    return entries(spark, d).filter(F.col("source_id").isNotNull() & (side() == "train")).groupBy("source_id").agg(n.alias("have")).filter("have < 4").withColumn("wanted", 4 - F.col("have"))


@query("i11_draft_pool", f"WITH {JUDGED}, o AS (SELECT expected.operation AS operation, id, count(*) AS n, bool_and(coalesce(\"right\", false)) AS agreed, bool_or(coalesce(\"right\", false)) AS once FROM j WHERE expected.operation IS NOT NULL GROUP BY ALL) SELECT operation, count(*) AS drafted, count(*) FILTER (WHERE n >= 2 AND agreed) AS accepted, count(*) FILTER (WHERE once AND NOT agreed) AS split FROM o GROUP BY operation")
def i11(spark, d):
    right = F.coalesce("right", F.lit(False))
    o = judged(spark, d).filter("expected.operation IS NOT NULL").groupBy(F.col("expected.operation").alias("operation"), "id").agg(F.count("*").alias("n"), F.bool_and(right).alias("agreed"), F.bool_or(right).alias("once"))
    return o.groupBy("operation").agg(F.count("*").alias("drafted"), F.count_if((F.col("n") >= 2) & F.col("agreed")).alias("accepted"), F.count_if(F.col("once") & ~F.col("agreed")).alias("split"))


RECIPE = "CASE WHEN expect.explain THEN 'hard_negative' WHEN expect.escalate THEN 'disambiguation' WHEN o.read_only THEN 'check' WHEN NOT o.read_only AND len(map_keys(expect.args)) > 1 THEN 'choice' WHEN NOT o.read_only THEN 'change' ELSE 'none' END"


@query("i12_recipes", f"WITH {S}, r AS (SELECT s.id, {RECIPE} AS recipe FROM s LEFT JOIN operations o ON o.name = expect.operation) SELECT recipe, id FROM r WHERE recipe != 'none' QUALIFY row_number() OVER (PARTITION BY recipe ORDER BY sha256('recipe:' || id), id) <= 20")
def i12(spark, d):
    ops = table(spark, d, "operations").select(F.col("name").alias("_op"), "read_only")  # the domain's operations, a few dozen rows by contract
    e = entries(spark, d).join(ops, F.col("expect.operation") == F.col("_op"), "left")
    recipe = (
        F.when(F.col("expect.explain"), "hard_negative")
        .when(F.col("expect.escalate"), "disambiguation")
        .when(F.col("read_only"), "check")
        .when(~F.col("read_only") & (F.size(F.map_keys("expect.args")) > 1), "choice")
        .when(~F.col("read_only"), "change")
    )
    r = e.select("id", recipe.alias("recipe"), F.sha2(F.concat(F.lit("recipe:"), "id"), 256).alias("h")).filter("recipe IS NOT NULL")
    return rank_by_hash(r, ["recipe"], "h", "id").filter("k <= 20").select("recipe", "id")


@query(
    "i15_re_review",
    f"""WITH {TQ}, {VN}, m AS (SELECT item_id, question_id, rater_id, min_by(label, seq) AS old, max_by(label, seq) AS new FROM vn WHERE label IS NOT NULL GROUP BY ALL)
SELECT list_contains(list_transform(options, lambda o: lower(trim(o))), old) AS before, list_contains(list_transform(options, lambda o: lower(trim(o))), new) AS after, count(*) AS n FROM m JOIN tq ON tq.id = m.item_id AND tq.qid = m.question_id GROUP BY 1, 2""",
)
def i15(spark, d):
    log = vote_log(spark, d).filter("label IS NOT NULL").groupBy(*VOTE).agg(F.min_by("label", "seq").alias("old"), F.max_by("label", "seq").alias("new"))
    q = R.typed_questions(typed(spark, d)).select(F.col("id").alias("item_id"), F.col("qid").alias("question_id"), F.transform("options", lambda o: F.lower(F.trim(o))).alias("options"))
    return log.join(q, ["item_id", "question_id"]).groupBy(F.array_contains("options", F.col("old")).alias("before"), F.array_contains("options", F.col("new")).alias("after")).agg(F.count("*").alias("n"))


@query("h8_verdict_object", f"WITH {TBL} SELECT id, md5(trim(gold)) AS object FROM t WHERE json_valid(gold) AND json_type(gold::JSON) = 'OBJECT'")
def h8(spark, d):
    """Gold as a model would say it, fenced and with words around; the first whole object is the gold text again."""
    said = F.concat(F.lit("Sure, {as asked.\n```json\n"), "gold", F.lit("\n```\nAnything {else}?"))
    rows = typed(spark, d).filter(F.col("gold").isNotNull()).select("id", "gold", T.first_object(said).alias("o"))
    whole = F.try_parse_json(F.col("gold")).isNotNull() & F.ltrim("gold").startswith("{")
    return rows.filter(whole).select("id", F.md5("o").alias("object"))
