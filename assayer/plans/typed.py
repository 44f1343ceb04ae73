"""Queries over typed-decision records: loaders, gold and teacher joins, agreement, assessments, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.plans.base import query, r6
from assayer.sources import records as R
from assayer.runtime import table

T = "t AS (SELECT DISTINCT ON (id) * FROM typed_rows), bn AS (SELECT DISTINCT ON (id) * FROM bench_rows)"
TQ = f"""{T}, tq0 AS (SELECT id, k AS qid, json_extract(questions::JSON, '$."' || k || '"') AS body FROM (SELECT id, questions, unnest(json_keys(questions::JSON)) AS k FROM t WHERE json_valid(questions))),
tq AS (SELECT id, qid, body->>'type' AS kind, body->'criteria' AS criteria, CASE WHEN json_type(body->'criteria') = 'OBJECT' THEN json_keys(body->'criteria') ELSE list_transform(range(0, json_array_length(body->'criteria')::BIGINT), lambda i: i::VARCHAR) END AS options FROM tq0)"""
TG = """tg0 AS (SELECT id, k AS qid, json_extract(gold::JSON, '$."' || k || '"') AS body FROM (SELECT id, gold, unnest(json_keys(gold::JSON)) AS k FROM t WHERE json_valid(gold))),
tg AS (SELECT id, qid, body->>'type' AS kind, body->>'label' AS label, (body->>'confidence')::DOUBLE AS confidence, body->'probabilities' AS probs FROM tg0),
gp AS (SELECT id, qid, k AS opt, json_extract_string(probs, '$."' || k || '"')::DOUBLE AS v FROM (SELECT *, unnest(json_keys(probs)) AS k FROM tg))"""
VT = """vt AS (SELECT item_id AS id, question_id AS qid, label, count(*) AS c FROM (SELECT DISTINCT item_id, question_id, rater_id, lower(trim(label)) AS label FROM rater_votes WHERE label IS NOT NULL AND trim(label) != '') GROUP BY ALL),
vs AS (SELECT *, c::DOUBLE / sum(c) OVER (PARTITION BY id, qid) AS share, row_number() OVER (PARTITION BY id, qid ORDER BY c DESC, label) AS n FROM vt)"""


def typed(spark, d):
    return R.first_arrival(table(spark, d, "typed_rows"), "id", "received_at")


def bench(spark, d):
    return R.first_arrival(table(spark, d, "bench_rows"), "id", "arrived_at")


def vote_shares(spark, d):
    """(id, qid, shares, teacher): distinct labels of raters as a distribution, its top label; ties to the smaller label."""
    v = table(spark, d, "rater_votes").filter("label IS NOT NULL AND trim(label) != ''").select(F.col("item_id").alias("id"), F.col("question_id").alias("qid"), "rater_id", F.lower(F.trim("label")).alias("label")).distinct()
    c = v.groupBy("id", "qid", "label").agg(F.count("*").alias("c"))
    g = c.groupBy("id", "qid").agg(F.sum("c").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "c")))).alias("m"), F.min(F.struct((-F.col("c")).alias("k"), "label")).alias("b"))
    return g.select("id", "qid", F.transform_values("m", lambda _, x: x / F.col("n")).alias("shares"), F.col("b.label").alias("teacher"))


@query("a10_typed_questions", f"WITH {TQ} SELECT id, qid, kind, len(options)::INT AS n_options, list_sort(options) AS options FROM tq")
def a10(spark, d):
    return R.typed_questions(typed(spark, d)).select("id", "qid", "kind", F.size("options").alias("n_options"), F.array_sort("options").alias("options"))


@query("a10_typed_gold", f"WITH {T}, {TG} SELECT id, qid, kind, label, round(confidence, 6) AS confidence FROM tg")
def a10b(spark, d):
    return R.typed_gold(typed(spark, d)).select("id", "qid", "kind", "label", r6(F.col("confidence")).alias("confidence"))


@query("a10_bench_rows", f"WITH {T} SELECT id, question->>'type' AS kind, lower(trim(label)) AS gold, CASE WHEN json_valid(soft_label) THEN len(json_keys(soft_label::JSON))::INT END AS n_soft FROM bn")
def a10c(spark, d):
    return R.bench_questions(bench(spark, d)).select("id", "kind", "gold", F.when(F.col("soft").isNotNull(), F.size("soft")).alias("n_soft"))


@query("a11_vote_scan", "SELECT item_id, question_id, rater_id, count(*) AS copies FROM rater_votes GROUP BY ALL HAVING count(*) > 1")
def a11(spark, d):
    return table(spark, d, "rater_votes").groupBy("item_id", "question_id", "rater_id").agg(F.count("*").alias("copies")).filter("copies > 1")


LICENCES = ("apache-2.0", " MIT ", "cc-by-4.0", "cc-by-nc-4.0", "mit or gpl")  # a registry's answers, by source


@query("b13_admission", f"WITH {T}, l AS (SELECT source, id, lower(trim({list(LICENCES)}[('0x' || left(md5(source), 2))::INT % 5 + 1])) AS licence, CASE WHEN ends_with(id, '0') THEN ' ' ELSE json_extract_string(CASE WHEN json_valid(meta) THEN meta::JSON END, '$.domain') END AS attribution FROM bn) SELECT source, licence, count(*) AS n, count(*) FILTER (WHERE licence IN ('apache-2.0', 'mit') OR (licence = 'cc-by-4.0' AND trim(coalesce(attribution, '')) != '')) AS admitted FROM l GROUP BY source, licence")
def b13(spark, d):
    """Rows whose licence is one of three, exactly, so a compound one is refused; the attributed one also needs an attribution that isn't blank."""
    of = F.element_at(F.array(*[F.lit(x) for x in LICENCES]), (F.conv(F.substring(F.md5("source"), 1, 2), 16, 10).cast("int") % 5) + 1)
    meta = F.when(F.try_parse_json("meta").isNotNull(), F.col("meta"))
    rows = bench(spark, d).select("source", F.lower(F.trim(of)).alias("licence"), F.when(F.col("id").endswith("0"), F.lit(" ")).otherwise(F.get_json_object(meta, "$.domain")).alias("attribution"))
    return rows.groupBy("source", "licence").agg(F.count("*").alias("n"), F.count_if(admitted(F.col("licence"), F.col("attribution"))).alias("admitted"))


def admitted(licence, attribution):
    return F.coalesce(licence.isin("apache-2.0", "mit") | ((licence == "cc-by-4.0") & (F.trim(F.coalesce(attribution, F.lit(""))) != "")), F.lit(False))


@query("b14_option_count", f"WITH {TQ} SELECT id, max(len(options))::INT AS widest, count(*) AS questions FROM tq GROUP BY id")
def b14(spark, d):
    return R.typed_questions(typed(spark, d)).groupBy("id").agg(F.max(F.size("options")).alias("widest"), F.count("*").alias("questions"))


@query(
    "b25_question_validity",
    f"WITH {TQ}, {TG} SELECT tq.id, tq.qid, CASE WHEN tq.kind NOT IN ('choice', 'noul', 'score') THEN 'kind' WHEN len(options) < 2 THEN 'options' WHEN tg.label IS NULL THEN 'no_label' WHEN NOT list_contains(options, tg.label) THEN 'label_not_offered' ELSE 'valid' END AS state FROM tq LEFT JOIN tg USING (id, qid)",
)
def b25(spark, d):
    t = typed(spark, d)
    q, g = R.typed_questions(t), R.typed_gold(t).select("id", "qid", "label")
    state = F.when(~F.col("kind").isin("choice", "noul", "score"), "kind").when(F.size("options") < 2, "options").when(F.col("label").isNull(), "no_label").when(~F.array_contains("options", F.col("label")), "label_not_offered").otherwise("valid")
    return q.join(g, ["id", "qid"], "left").select("id", "qid", state.alias("state"))


def gold_and_teacher(spark, d):
    return R.typed_gold(typed(spark, d)).join(vote_shares(spark, d), ["id", "qid"], "left")


GT = f"{T}, {TG}, {VT}, gt AS (SELECT tg.*, vs.label AS teacher FROM tg LEFT JOIN vs ON vs.id = tg.id AND vs.qid = tg.qid AND vs.n = 1)"


@query("c8_gold_teacher", f"WITH {GT} SELECT id, qid, label, teacher, CASE WHEN teacher IS NULL THEN 'unlabelled' WHEN label IS NULL THEN 'no_gold' WHEN label = teacher THEN 'same' ELSE 'other' END AS state FROM gt")
def c8(spark, d):
    state = F.when(F.col("teacher").isNull(), "unlabelled").when(F.col("label").isNull(), "no_gold").when(F.col("label") == F.col("teacher"), "same").otherwise("other")
    return gold_and_teacher(spark, d).select("id", "qid", "label", "teacher", state.alias("state"))


@query("c9_target_precedence", f"WITH {GT} SELECT kind, CASE WHEN confidence >= 0.99 THEN 'gold' WHEN teacher IS NOT NULL AND teacher = label THEN 'gold_and_teacher' WHEN teacher IS NOT NULL THEN 'teacher' ELSE 'gold_only' END AS target, count(*) AS n FROM gt GROUP BY ALL")
def c9(spark, d):
    t = F.when(F.col("confidence") >= 0.99, "gold").when(F.col("teacher").isNotNull() & (F.col("teacher") == F.col("label")), "gold_and_teacher").when(F.col("teacher").isNotNull(), "teacher").otherwise("gold_only")
    return gold_and_teacher(spark, d).groupBy("kind", t.alias("target")).agg(F.count("*").alias("n"))


@query("c10_answers_to_questions", f"WITH {TQ}, {VT} SELECT tq.id, tq.qid, list_transform(list_sort(options), lambda o: 1)::INT[] IS NOT NULL AS has_options, count(vs.label) AS answers, round(coalesce(sum(vs.share) FILTER (WHERE list_contains(options, vs.label)), 0), 6) AS mapped FROM tq LEFT JOIN vs ON vs.id = tq.id AND vs.qid = tq.qid GROUP BY tq.id, tq.qid, options")
def c10(spark, d):
    """Answers mapped to options by name, never by place."""
    q = R.typed_questions(typed(spark, d)).select("id", "qid", "options").join(vote_shares(spark, d), ["id", "qid"], "left")
    mapped = L.total(F.transform("options", lambda o: F.coalesce(F.element_at("shares", o), F.lit(0.0))))
    return q.select("id", "qid", F.col("options").isNotNull().alias("has_options"), F.coalesce(F.when(F.col("shares").isNotNull(), F.size("shares")), F.lit(0)).cast("bigint").alias("answers"), F.coalesce(r6(mapped), F.lit(0.0)).alias("mapped"))


@query("c11_agreement_left", f"WITH {GT} SELECT kind, count(*) AS n, round(avg(coalesce(teacher = label, false)::INT), 6) AS agreement FROM gt WHERE label IS NOT NULL GROUP BY kind")
def c11(spark, d):
    """A missing answer counts against."""
    g = gold_and_teacher(spark, d).filter("label IS NOT NULL")
    return g.groupBy("kind").agg(F.count("*").alias("n"), r6(F.avg(F.coalesce(F.col("teacher") == F.col("label"), F.lit(False)).cast("double"))).alias("agreement"))


@query("c12_agreement_inner", f"WITH {GT} SELECT kind, count(*) AS n, round(avg((teacher = label)::INT), 6) AS agreement FROM gt WHERE label IS NOT NULL AND teacher IS NOT NULL GROUP BY kind")
def c12(spark, d):
    """Only where both answered."""
    g = gold_and_teacher(spark, d).filter("label IS NOT NULL AND teacher IS NOT NULL")
    return g.groupBy("kind").agg(F.count("*").alias("n"), r6(F.avg((F.col("teacher") == F.col("label")).cast("double"))).alias("agreement"))


@query("c14_alias_join", f"WITH {T}, m AS (SELECT DISTINCT regexp_replace(lower(workflow), '[^a-z0-9]', '', 'g') AS k FROM t WHERE workflow IS NOT NULL), s AS (SELECT regexp_replace(lower(source), '[^a-z0-9]', '', 'g') AS k, count(*) AS n FROM bn GROUP BY 1) SELECT s.k, s.n, m.k IS NOT NULL AS listed FROM s LEFT JOIN m USING (k)")
def c14(spark, d):
    from assayer.functions.text import alnum_fold

    m = typed(spark, d).filter("workflow IS NOT NULL").select(alnum_fold(F.col("workflow")).alias("k")).distinct().withColumn("listed", F.lit(True))
    s = bench(spark, d).groupBy(alnum_fold(F.col("source")).alias("k")).agg(F.count("*").alias("n"))
    return s.join(m, "k", "left").select("k", "n", F.coalesce("listed", F.lit(False)).alias("listed"))


SETS = "CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind"


@query(
    "d14_typed_assessment",
    f"""WITH {GT}, x AS (SELECT gt.kind, (gt.label = gt.teacher)::INT AS ok, -ln(greatest(coalesce(vs.share, 0), 1e-12)) AS loss FROM gt LEFT JOIN vs ON vs.id = gt.id AND vs.qid = gt.qid AND vs.label = gt.label WHERE gt.label IS NOT NULL AND gt.teacher IS NOT NULL)
SELECT {SETS}, count(*) AS n, round(avg(ok), 6) AS accuracy, round(avg(loss), 6) AS log_loss FROM x GROUP BY GROUPING SETS ((kind), ())""",
)
def d14(spark, d):
    x = gold_and_teacher(spark, d).filter("label IS NOT NULL AND teacher IS NOT NULL")
    x = x.withColumn("ok", (F.col("label") == F.col("teacher")).cast("double")).withColumn("loss", L.log_loss(F.coalesce(F.element_at("shares", F.col("label")), F.lit(0.0))))
    g = x.groupingSets([[F.col("kind")], []], "kind").agg(F.grouping("kind").alias("g"), F.count("*").alias("n"), r6(F.avg("ok")).alias("accuracy"), r6(F.avg("loss")).alias("log_loss"))
    return g.select(F.when(F.col("g") == 1, "all").otherwise(F.col("kind")).alias("kind"), "n", "accuracy", "log_loss")


def aligned(spark, d):
    """Gold and teacher as arrays over the sorted options that gold names."""
    x = gold_and_teacher(spark, d).filter("probabilities IS NOT NULL AND size(probabilities) > 1 AND shares IS NOT NULL")
    names = F.array_sort(F.map_keys("probabilities"))
    x = x.withColumn("names", names).withColumn("p", F.transform("names", lambda k: F.element_at("probabilities", k))).withColumn("q", F.transform("names", lambda k: F.coalesce(F.element_at("shares", k), F.lit(0.0))))
    return x.filter(L.total(F.col("q")) > 0).withColumn("q", L.normalised(F.col("q"))).withColumn("p", F.transform("p", lambda v: F.coalesce(v, F.lit(0.0)))).filter(L.total(F.col("p")) > 0).withColumn("p", L.normalised(F.col("p")))


AL = f"""{T}, {TG}, {VT}, al0 AS (SELECT gp.id, gp.qid, gp.opt, coalesce(gp.v, 0) AS p, coalesce(vs.share, 0) AS q, count(*) OVER (PARTITION BY gp.id, gp.qid) AS k FROM gp LEFT JOIN vs ON vs.id = gp.id AND vs.qid = gp.qid AND vs.label = gp.opt),
al1 AS (SELECT *, sum(p) OVER w AS sp, sum(q) OVER w AS sq FROM al0 WHERE k > 1 WINDOW w AS (PARTITION BY id, qid)), al AS (SELECT id, qid, opt, p / sp AS p, q / sq AS q, row_number() OVER (PARTITION BY id, qid ORDER BY opt) - 1 AS i FROM al1 WHERE sp > 0 AND sq > 0)"""


@query("d16_jensen_shannon", f"WITH {AL} SELECT id, qid, round(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS jsd FROM al GROUP BY ALL")
def d16(spark, d):
    return aligned(spark, d).select("id", "qid", r6(L.jensen_shannon(F.col("p"), F.col("q"))).alias("jsd"))


@query("h15_log_softmax", f"WITH {AL} SELECT id, qid, opt, round(q - ln(sum(exp(q)) OVER (PARTITION BY id, qid)), 6) AS v FROM al")
def h15(spark, d):
    x = aligned(spark, d).withColumn("z", L.log_softmax(F.col("q")))
    return x.select("id", "qid", F.explode(F.arrays_zip("names", "z")).alias("e")).select("id", "qid", F.col("e.names").alias("opt"), r6(F.col("e.z")).alias("v"))


@query("h15_soften", f"WITH {AL}, w AS (SELECT *, CASE WHEN q > 0 THEN q ** 0.5 ELSE 0 END AS x FROM al) SELECT id, qid, opt, round(x / sum(x) OVER (PARTITION BY id, qid), 6) AS v FROM w")
def h15b(spark, d):
    x = aligned(spark, d).withColumn("z", L.soften(F.col("q"), 2.0))
    return x.select("id", "qid", F.explode(F.arrays_zip("names", "z")).alias("e")).select("id", "qid", F.col("e.names").alias("opt"), r6(F.col("e.z")).alias("v"))


@query(
    "h17_ordinal_target",
    f"WITH {TQ}, {TG}, x AS (SELECT tq.id, tq.qid, len(options) AS n, tg.label::INT AS g FROM tq JOIN tg USING (id, qid) WHERE tq.kind = 'score' AND regexp_full_match(tg.label, '\\d+') AND len(options) >= 2), y AS (SELECT *, unnest(range(0, n)) AS i FROM x WHERE g < n) SELECT id, qid, i::INT AS i, round(CASE WHEN i = g THEN 0.9 WHEN abs(i - g) = 1 THEN 0.1 / ((g > 0)::INT + (g < n - 1)::INT) ELSE 0 END, 6)::DOUBLE AS v FROM y",
)
def h17(spark, d):
    t = typed(spark, d)
    x = R.typed_questions(t).filter("kind = 'score'").join(R.typed_gold(t).select("id", "qid", "label"), ["id", "qid"]).filter(F.col("label").rlike(r"^\d+$") & (F.size("options") >= 2))
    x = x.withColumn("g", F.col("label").cast("int")).withColumn("n", F.size("options")).filter("g < n")
    return x.select("id", "qid", F.posexplode(L.ordinal_target(F.col("n"), F.col("g"), 0.1)).alias("i", "v")).select("id", "qid", "i", r6(F.col("v")).alias("v"))


@query("h18_permute", f"WITH {AL} SELECT id, qid, (max(i) OVER (PARTITION BY id, qid) - i)::INT AS i, round(q, 6) AS v FROM al")
def h18(spark, d):
    x = aligned(spark, d).withColumn("order", F.reverse(F.sequence(F.lit(0), F.size("q") - 1)))
    return x.select("id", "qid", F.posexplode(L.permuted(F.col("q"), F.col("order"))).alias("i", "v")).select("id", "qid", "i", r6(F.col("v")).alias("v"))


@query("h18_unpermute", f"WITH {AL} SELECT id, qid, i::INT AS i, round(q, 6) AS v FROM al")
def h18b(spark, d):
    x = aligned(spark, d).withColumn("order", F.reverse(F.sequence(F.lit(0), F.size("q") - 1)))
    return x.select("id", "qid", F.posexplode(L.unpermuted(L.permuted(F.col("q"), F.col("order")), F.col("order"))).alias("i", "v")).select("id", "qid", "i", r6(F.col("v")).alias("v"))


@query("h19_mix_targets", f"WITH {AL} SELECT id, qid, opt, round((0.7 * p + 0.3 * q) / sum(0.7 * p + 0.3 * q) OVER (PARTITION BY id, qid), 6) AS v FROM al")
def h19(spark, d):
    x = aligned(spark, d).withColumn("z", L.mixed(F.col("p"), F.col("q"), 0.3))
    return x.select("id", "qid", F.explode(F.arrays_zip("names", "z")).alias("e")).select("id", "qid", F.col("e.names").alias("opt"), r6(F.col("e.z")).alias("v"))


@query("h20_normalised_violations", f"WITH {T}, {TG}, n AS (SELECT id, qid, sum(v) AS s, min(v) AS low FROM gp GROUP BY ALL) SELECT id, qid, CASE WHEN low < 0 THEN 'negative' WHEN abs(s - 1) > 0.011 THEN 'sum' ELSE 'rounded' END AS state FROM n WHERE low < 0 OR abs(s - 1) > 1e-9")
def h20(spark, d):
    g = R.typed_gold(typed(spark, d)).filter("size(probabilities) > 0").select("id", "qid", L.total(F.map_values("probabilities")).alias("s"), F.array_min(F.map_values("probabilities")).alias("low"))
    return g.filter("low < 0 OR abs(s - 1) > 1e-9").select("id", "qid", F.when(F.col("low") < 0, "negative").when(F.abs(F.col("s") - 1) > 0.011, "sum").otherwise("rounded").alias("state"))


@query("d17_teacher_audit", f"WITH {GT}, x AS (SELECT gt.*, t.workflow FROM gt JOIN t USING (id)) SELECT regexp_replace(lower(workflow), '[^a-z0-9]', '', 'g') AS source, count(*) AS n, count(*) FILTER (WHERE teacher IS NULL) AS unlabelled, round(avg((teacher = label)::INT), 6) AS accuracy, avg((teacher = label)::INT) < 0.8 AS weak FROM x WHERE label IS NOT NULL GROUP BY 1")
def d17(spark, d):
    from assayer.functions.text import alnum_fold

    w = typed(spark, d).select("id", alnum_fold(F.col("workflow")).alias("source"))
    x = gold_and_teacher(spark, d).filter("label IS NOT NULL").join(w, "id")
    ok = F.avg((F.col("teacher") == F.col("label")).cast("double"))
    return x.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("teacher").isNull()).alias("unlabelled"), r6(ok).alias("accuracy"), (ok < 0.8).alias("weak"))


@query("d34_distillation_loss", f"WITH {AL}, z AS (SELECT *, first_value(0.0) OVER (), CASE WHEN p > 0 THEN p * (ln(p) - ln(greatest(q, 1e-12))) ELSE 0 END AS kl FROM al), r AS (SELECT id, qid, sum(kl) AS kl, -ln(greatest(max_by(q, p + (100 - i) * 1e-9), 1e-12)) AS ce FROM z GROUP BY ALL) SELECT count(*) AS n, round(0.5 * avg(kl) + 0.5 * avg(ce), 6) AS loss FROM r")
def d34(spark, d):
    """Half the divergence of the teacher from gold, half the cross entropy of gold's first maximum."""
    x = aligned(spark, d)
    kl = L.total(F.zip_with("p", "q", lambda a, b: F.when(a > 0, a * (F.ln(a) - F.ln(F.greatest(b, F.lit(1e-12))))).otherwise(0.0)))
    ce = -F.ln(F.greatest(F.get("q", L.first_argmax(F.col("p"))), F.lit(1e-12)))
    return x.agg(F.count("*").alias("n"), r6(0.5 * F.avg(kl) + 0.5 * F.avg(ce)).alias("loss"))


@query("d31_review_counts", f"WITH {T}, {VT}, n AS (SELECT id, count(DISTINCT qid) AS q FROM vt GROUP BY id) SELECT CASE WHEN n.q IS NULL THEN 'open' WHEN n.q < TRY_CAST(t.n_questions AS INT) THEN 'partial' ELSE 'done' END AS status, count(*) AS n FROM t LEFT JOIN n USING (id) GROUP BY 1")
def d31(spark, d):
    n = table(spark, d, "rater_votes").filter("label IS NOT NULL AND trim(label) != ''").groupBy(F.col("item_id").alias("id")).agg(F.countDistinct("question_id").alias("q"))
    state = F.when(F.col("q").isNull(), "open").when(F.col("q") < F.expr("try_cast(n_questions AS int)"), "partial").otherwise("done")
    return typed(spark, d).join(n, "id", "left").groupBy(state.alias("status")).agg(F.count("*").alias("n"))


@query("c21_orphan_votes", f"WITH {TQ} SELECT v.item_id, v.question_id, count(*) AS votes FROM rater_votes v LEFT JOIN (SELECT id, qid FROM tq WHERE len(options) > 2 UNION ALL SELECT id, 'question' FROM bn) k ON k.id = v.item_id AND k.qid = v.question_id WHERE k.id IS NULL GROUP BY ALL")
def c21(spark, d):
    """Votes that no question of more than two options, nor a bench row, asked for."""
    asked = R.typed_questions(typed(spark, d)).filter(F.size("options") > 2).select(F.col("id").alias("item_id"), F.col("qid").alias("question_id"))
    known = asked.union(bench(spark, d).select("id", F.lit("question")))
    votes = table(spark, d, "rater_votes").groupBy("item_id", "question_id").agg(F.count("*").alias("votes"))
    return votes.join(known, ["item_id", "question_id"], "left_anti")


@query("k7_rates", "SELECT rater_id, count(*) AS n, round(count(*)::DOUBLE / greatest((epoch_us(max(arrived_at)) - epoch_us(min(arrived_at))) / 86400e6, 1e-9), 6) AS per_day FROM rater_votes GROUP BY rater_id HAVING count(*) > 1 AND max(arrived_at) > min(arrived_at)")
def k7(spark, d):
    span = (F.unix_micros(F.max("arrived_at")) - F.unix_micros(F.min("arrived_at"))) / 86400e6
    g = table(spark, d, "rater_votes").groupBy("rater_id").agg(F.count("*").alias("n"), span.alias("days"))
    return g.filter("n > 1 AND days > 0").select("rater_id", "n", r6(F.col("n") / F.greatest("days", F.lit(1e-9))).alias("per_day"))
