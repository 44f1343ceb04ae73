"""Queries of text functions, similarity, curation, sets and windows over seed_entries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.functions import secrets as X
from assayer.functions import text as T
from assayer.operators.ranking import quota, rank_by_hash, rank_by_range
from assayer.operators.similarity import leakage_pairs
from assayer.plans.base import CANON, KIND, P, S, entries, preds, query, quota_sql, r6
from assayer.runtime import cut_lineage, table

NORM = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"
N = NORM.format("text")
FOLD = "trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
WORDS = f"CASE WHEN {N} = '' OR text IS NULL THEN [] ELSE string_split({N}, ' ') END"
SIDE = "CASE WHEN lower(trim(side)) IN ('train', 'training') THEN 'train' WHEN lower(trim(side)) IN ('validation', 'val', 'dev') THEN 'validation' WHEN lower(trim(side)) = 'test' THEN 'test' END"
SW = f"{S}, w AS (SELECT *, {N} AS n, {WORDS} AS words, {SIDE} AS split FROM s)"


def side():
    v = F.lower(F.trim("side"))
    return F.when(v.isin("train", "training"), "train").when(v.isin("validation", "val", "dev"), "validation").when(v == "test", "test")


def worded(spark, d):
    e = entries(spark, d)
    return e.withColumn("n", T.normalize_text(F.col("text"))).withColumn("words", T.tokens(F.col("text"))).withColumn("split", side())


@query("h1_normalize_text", f"WITH {S} SELECT id, {N} AS normal FROM s")
def h1(spark, d):
    return entries(spark, d).select("id", T.normalize_text(F.col("text")).alias("normal"))


@query("h1_normalize_documents", f"SELECT doc_id, md5({N}) AS normal FROM documents")
def h1b(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.normalize_text(F.col("text"))).alias("normal"))


@query(
    "h2_shingles",
    f"WITH {SW}, h AS (SELECT id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END AS x FROM w) SELECT id, len(x)::INT AS n, md5(array_to_string(list_sort(x), '|')) AS digest FROM h",
)
def h2(spark, d):
    return worded(spark, d).withColumn("x", T.shingles_of(F.col("words"))).select("id", F.size("x").alias("n"), F.md5(F.array_join(F.array_sort("x"), "|")).alias("digest"))


@query("h3_unicode_fold", f"SELECT doc_id, md5({FOLD.format('text')}) AS folded FROM documents")
def h3(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.unicode_fold(F.col("text"))).alias("folded"))


@query("h4_alnum_fold", f"WITH {S} SELECT regexp_replace(lower(source), '[^a-z0-9]', '', 'g') AS name, count(*) AS n, count(DISTINCT source) AS spellings FROM s GROUP BY 1")
def h4(spark, d):
    return entries(spark, d).groupBy(T.alnum_fold(F.col("source")).alias("name")).agg(F.count("*").alias("n"), F.countDistinct("source").alias("spellings"))


@query("h22_seeded_hash", f"WITH {S} SELECT id, ('0x' || left(sha256('13:' || id), 15))::BIGINT AS h FROM s")
def h22(spark, d):
    return entries(spark, d).select("id", T.seeded_hash("13", F.col("id"), 15).cast("bigint").alias("h"))


RED = "text"
FIRED = []
for _name, _pattern, _marker in T.REDACTIONS:
    FIRED.append(f"CASE WHEN regexp_matches({RED}, '{_pattern.replace(chr(39), chr(39) * 2)}') THEN '{_name}' END")
    RED = f"regexp_replace({RED}, '{_pattern.replace(chr(39), chr(39) * 2)}', '{_marker}', 'g')"


@query("h25_redact", f"WITH {S} SELECT id, {RED} AS clean FROM s")
def h25(spark, d):
    return entries(spark, d).select("id", T.redact(F.col("text")).alias("clean"))


@query("h25_redactions_fired", f"WITH {S}, f AS (SELECT id, unnest([{', '.join(FIRED)}]) AS rule FROM s) SELECT rule, count(*) AS n FROM f WHERE rule IS NOT NULL GROUP BY rule")
def h25b(spark, d):
    return entries(spark, d).select(F.explode(T.redactions_fired(F.col("text"))).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


# Texts with a line of every shape a scan must find or leave alone, derived from the id.
PLANTED = f"""{S}, pl AS (SELECT id, coalesce(text, '') || chr(10) || CASE left(h, 1) WHEN '0' THEN 'AKIA' || upper(substr(h, 2, 16)) WHEN '1' THEN 'ghp_' || substr(h, 1, 40) WHEN '2' THEN 'xoxb-' || substr(h, 1, 24) WHEN '3' THEN 'sk-' || substr(h, 1, 32)
 WHEN '4' THEN 'hf_' || substr(h, 1, 34) WHEN '5' THEN '-----BEGIN RSA PRIVATE KEY-----' || h || '-----END RSA PRIVATE KEY-----' WHEN '6' THEN 'api_key = "' || substr(h, 1, 24) || '"' WHEN '7' THEN 'password: changeme-example-password' WHEN '8' THEN 'Authorization: Bearer ' || substr(h, 1, 20)
 WHEN '9' THEN 'https://user:' || substr(h, 1, 8) || '@host.example/x' WHEN 'a' THEN 'see 10.1.2.3 and 127.0.0.1' WHEN 'b' THEN 'ping nas.local or 100.64.0.9' WHEN 'c' THEN '192.0.2.10 then 192.168.1.77' WHEN 'd' THEN '{{"base_url": "http://gpu7:8000/v1", "token": "' || h || '"}}' WHEN 'e' THEN '{{"endpoint": "http://localhost:1"}} --api-key ' || h ELSE 'nothing' END AS t FROM (SELECT *, sha256(id) AS h FROM s))"""


def planted(spark, d):
    h = F.sha2("id", 256)
    part = lambda a, n: F.substring(h, a, n)
    say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    lines = {
        "0": say("AKIA", F.upper(part(2, 16))), "1": say("ghp_", part(1, 40)), "2": say("xoxb-", part(1, 24)), "3": say("sk-", part(1, 32)), "4": say("hf_", part(1, 34)),
        "5": say("-----BEGIN RSA PRIVATE KEY-----", h, "-----END RSA PRIVATE KEY-----"), "6": say('api_key = "', part(1, 24), '"'), "7": F.lit("password: changeme-example-password"), "8": say("Authorization: Bearer ", part(1, 20)),
        "9": say("https://user:", part(1, 8), "@host.example/x"), "a": F.lit("see 10.1.2.3 and 127.0.0.1"), "b": F.lit("ping nas.local or 100.64.0.9"), "c": F.lit("192.0.2.10 then 192.168.1.77"),
        "d": say('{"base_url": "http://gpu7:8000/v1", "token": "', h, '"}'), "e": say('{"endpoint": "http://localhost:1"} --api-key ', h),
    }
    line = F.lit("nothing")
    for k, v in lines.items():
        line = F.when(part(1, 1) == k, v).otherwise(line)
    return entries(spark, d).select("id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), line).alias("t"))


Q1 = lambda p: "'" + p.replace("'", "''") + "'"
ASSIGNED = f"len(list_filter(regexp_extract_all(t, {Q1(X.ASSIGNED)}, 1), lambda v: NOT regexp_matches(v, {Q1(X.NO_VALUE)}))) > 0"
REDACT_SECRETS = "t"
for _name, _pattern in X.REDACTED:
    REDACT_SECRETS = f"regexp_replace({REDACT_SECRETS}, {Q1(_pattern)}, '<{_name}>', 'g')"


@query("h24_credentials", f"WITH {PLANTED} SELECT id, unnest(list_filter([{', '.join(f'CASE WHEN regexp_matches(t, {Q1(p)}) THEN {Q1(n)} END' for n, p in X.TOKENS)}, CASE WHEN {ASSIGNED} THEN 'assignment' END], lambda x: x IS NOT NULL)) AS shape FROM pl")
def h24(spark, d):
    return planted(spark, d).select("id", F.explode(X.credentials(F.col("t"))).alias("shape"))


@query("h25_redact_secrets", f"WITH {PLANTED} SELECT id, {REDACT_SECRETS} AS clean FROM pl")
def h25c(spark, d):
    return planted(spark, d).select("id", X.redact_secrets(F.col("t")).alias("clean"))


@query("h26_private_hosts", f"WITH {PLANTED} SELECT id, unnest(list_concat(regexp_extract_all(t, {Q1(X.ADDRESS)}), regexp_extract_all(t, {Q1(X.NAME)}))) AS host FROM pl")
def h26(spark, d):
    return planted(spark, d).select("id", F.explode(X.private_hosts(F.col("t"))).alias("host"))


@query("h26_endpoints", f"WITH {PLANTED} SELECT id, unnest(list_filter(regexp_extract_all(t, {Q1(X.ENDPOINT)}, 1), lambda h: h NOT IN ({', '.join(map(Q1, X.OPEN_HOSTS))}))) AS host FROM pl")
def h26b(spark, d):
    return planted(spark, d).select("id", F.explode(X.endpoints(F.col("t"))).alias("host"))


@query("h30_header_parts", f"WITH {S} SELECT id, regexp_extract(id, '^([a-z]+)-(\\d+)-(\\d+)$', 1) AS prefix, nullif(regexp_extract(id, '^([a-z]+)-(\\d+)-(\\d+)$', 3), '')::BIGINT AS number FROM s")
def h30(spark, d):
    part = lambda i: F.regexp_extract("id", r"^([a-z]+)-(\d+)-(\d+)$", i)
    return entries(spark, d).select("id", part(1).alias("prefix"), F.nullif(part(3), F.lit("")).cast("bigint").alias("number"))


@query("h31_expectation_in_words", f"WITH {S} SELECT id, CASE WHEN expect.escalate THEN 'hand over' WHEN expect.explain THEN 'explain: ' || coalesce(expect.answer, '') ELSE coalesce(expect.operation, '') || '(' || array_to_string(list_transform(list_sort(map_entries(expect.args)), lambda e: e.key || '=' || e.value), ', ') || ')' END AS said FROM s WHERE expect.escalate OR expect.explain OR expect.args IS NOT NULL")
def h31(spark, d):
    args = F.array_join(F.transform(F.array_sort(F.map_entries("expect.args")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    said = F.when(F.col("expect.escalate"), "hand over").when(F.col("expect.explain"), F.concat(F.lit("explain: "), F.coalesce("expect.answer", F.lit("")))).otherwise(F.concat(F.coalesce("expect.operation", F.lit("")), F.lit("("), args, F.lit(")")))
    return entries(spark, d).filter("expect.escalate OR expect.explain OR expect.args IS NOT NULL").select("id", said.alias("said"))


@query("h34_verb_tree", "SELECT DISTINCT array_to_string(w[:k], '.') AS node, CASE WHEN k > 1 THEN array_to_string(w[:k-1], '.') END AS parent FROM (SELECT string_split(name, '_') AS w, unnest(range(1, len(string_split(name, '_')) + 1)) AS k FROM operations)")
def h34(spark, d):
    w = table(spark, d, "operations").withColumn("w", F.split("name", "_"))
    k = w.select("w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("k"))
    join = lambda n: F.array_join(F.slice("w", F.lit(1), n), ".")
    return k.select(join(F.col("k")).alias("node"), F.when(F.col("k") > 1, join(F.greatest(F.col("k") - 1, F.lit(1)))).alias("parent")).distinct()


@query("h37_id_digest", f"WITH {S} SELECT id, sha256(id) AS digest FROM s")
def h37(spark, d):
    return entries(spark, d).select("id", F.sha2("id", 256).alias("digest"))


@query("g5_jaccard", f"WITH {SW}, x AS (SELECT id AS l, list_distinct(words) AS a, lead(id) OVER v AS r, list_distinct(lead(words) OVER v) AS b FROM w WHERE source_id IS NOT NULL OR source IS NOT NULL WINDOW v AS (PARTITION BY source, author ORDER BY id)) SELECT l, r, round(CASE WHEN len(a) + len(b) = 0 THEN 1 ELSE len(list_intersect(a, b))::DOUBLE / greatest(len(list_distinct(a || b)), 1) END, 6) AS similarity FROM x WHERE r IS NOT NULL")
def g5(spark, d):
    """Similarity of each entry to the next one of its source and author, as sets of words."""
    w = worded(spark, d).filter("source_id IS NOT NULL OR source IS NOT NULL").select("id", "source", "author", F.array_distinct("words").alias("a"))
    v = Window.partitionBy("source", "author").orderBy("id")
    x = w.withColumn("r", F.lead("id").over(v)).withColumn("b", F.lead("a").over(v)).filter("r IS NOT NULL")
    return x.select(F.col("id").alias("l"), "r", r6(T.jaccard(F.col("a"), F.col("b"))).alias("similarity"))


LEAK = f"""{SW}, v AS (SELECT *, list_distinct(words) AS ws, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END AS sh FROM w),
m AS (SELECT a.id AS l_key, b.id AS r_key, CASE WHEN a.n = b.n THEN 'exact'
  WHEN 5 * len(list_intersect(a.sh, b.sh)) >= 4 * len(list_distinct(a.sh || b.sh)) THEN 'shingle'
  WHEN len(a.ws) >= 4 AND len(b.ws) >= 4 AND 5 * len(list_intersect(a.ws, b.ws)) >= 4 * len(list_distinct(a.ws || b.ws)) THEN 'words' END AS how
 FROM v a JOIN v b ON a.split = 'train' AND b.split IN ('validation', 'test') AND a.n != '' AND b.n != '' AND a.n IS NOT NULL AND b.n IS NOT NULL AND 4 * len(a.ws) <= 5 * len(b.ws) + 20 AND 4 * len(b.ws) <= 5 * len(a.ws) + 20)"""


def leaks(spark, d):
    w = worded(spark, d).filter("n != '' AND split IS NOT NULL").select("id", "n", "words", "split")
    w = cut_lineage(w.select("id", "n", "split", F.array_distinct("words").alias("ws"), T.shingles_of(F.col("words")).alias("sh")))  # both sides read it often
    return leakage_pairs(w.filter("split = 'train'"), w.filter("split IN ('validation', 'test')"), "id", "n", "ws", "sh")


@query("c2_similarity_join", f"WITH {LEAK} SELECT l_key, r_key, how FROM m WHERE how IS NOT NULL")
def c2(spark, d):
    return leaks(spark, d)


@query("c1_first_match", f"WITH {LEAK} SELECT l_key, min(r_key) AS r_key FROM m WHERE how IS NOT NULL GROUP BY l_key")
def c1(spark, d):
    """The first protected entry, by id, that a train entry matches."""
    return leaks(spark, d).groupBy("l_key").agg(F.min("r_key").alias("r_key"))


@query("c4_excluded_text", f"WITH {S}, f AS (SELECT id, {SIDE} AS split, {FOLD.format('text')} AS n FROM s) SELECT id, n IN (SELECT n FROM f WHERE split IN ('validation', 'test') AND n != '') AS leaked FROM f WHERE split = 'train' AND n IS NOT NULL")
def c4(spark, d):
    f = entries(spark, d).select("id", side().alias("split"), T.unicode_fold(F.col("text")).alias("n"))
    held = f.filter("split IN ('validation', 'test') AND n != ''").select("n").distinct().withColumn("leaked", F.lit(True))
    return f.filter("split = 'train' AND n IS NOT NULL").join(held, "n", "left").select("id", F.coalesce("leaked", F.lit(False)).alias("leaked"))


@query("c6_train_only_guard", f"WITH {SW} SELECT coalesce(train_only, false) AS train_only, coalesce(split, 'none') AS split, count(*) AS n, coalesce(train_only, false) AND coalesce(split, 'none') != 'train' AS refused FROM w GROUP BY 1, 2")
def c6(spark, d):
    """Rows by mark and side; marked ones off the train side are refused."""
    mark, at = F.coalesce("train_only", F.lit(False)), F.coalesce("split", F.lit("none"))
    return worded(spark, d).groupBy(mark.alias("train_only"), at.alias("split")).agg(F.count("*").alias("n")).withColumn("refused", F.col("train_only") & (F.col("split") != "train"))


@query("c17_training_overlap", f"WITH {P}, {SW} SELECT DISTINCT p.id FROM p JOIN w USING (id) WHERE w.split = 'train'")
def c17(spark, d):
    train = worded(spark, d).filter("split = 'train'").select("id")
    return preds(spark, d).select("id").distinct().join(train, "id", "left_semi")


@query("c18_protected_ids", f"WITH {P}, {SW} SELECT p.pos FROM p WHERE sha256(p.id) IN (SELECT sha256(id) FROM w WHERE split = 'test')")
def c18(spark, d):
    held = worded(spark, d).filter("split = 'test'").select(F.sha2("id", 256).alias("h"))
    return preds(spark, d).select("pos", F.sha2("id", 256).alias("h")).join(held, "h", "left_semi").select("pos")


@query("c22_resume_anti_join", f"WITH {P}, {S} SELECT s.id FROM s WHERE s.id NOT IN (SELECT id FROM p WHERE model = 'scorer-main' AND id IS NOT NULL)")
def c22(spark, d):
    done = table(spark, d, "predictions").filter("model = 'scorer-main'").select("id")  # a repeated row excludes no more than its first
    return entries(spark, d).select("id").join(done, "id", "left_anti")


@query("c26_held_apart", f"WITH {SW} SELECT DISTINCT source FROM w WHERE split = 'train' AND source IN (SELECT source FROM w WHERE split IN ('validation', 'test'))")
def c26(spark, d):
    """Sources that stand on both sides."""
    w = worded(spark, d).filter("source IS NOT NULL").select("source", "split")
    return w.filter("split = 'train'").select("source").distinct().join(w.filter("split IN ('validation', 'test')").select("source").distinct(), "source", "left_semi")


@query("c27_failure_classes", f"WITH {P}, {S} SELECT coalesce(s.entry_class, s.kind) AS class, p.outcome, count(*) AS n FROM p JOIN s USING (id) GROUP BY ALL")
def c27(spark, d):
    e = entries(spark, d).select("id", F.coalesce("entry_class", "kind").alias("class"))
    return preds(spark, d).select("id", "outcome").join(e, "id").groupBy("class", "outcome").agg(F.count("*").alias("n"))


@query("c29_inventory_compare", f"WITH {P}, {S}, a AS (SELECT id, count(*) AS predictions FROM p GROUP BY id), b AS (SELECT id FROM s) SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'missing' WHEN b.id IS NULL THEN 'extra' ELSE 'both' END AS state, predictions FROM a FULL JOIN b ON a.id = b.id")
def c29(spark, d):
    a = preds(spark, d).groupBy("id").agg(F.count("*").alias("predictions"))
    b = entries(spark, d).select("id", F.lit(True).alias("here"))
    state = F.when(F.col("predictions").isNull(), "missing").when(F.col("here").isNull(), "extra").otherwise("both")
    return a.join(b, "id", "full_outer").select("id", state.alias("state"), "predictions")


# ------------------------------------------------------------------------------------------------ scans and curation


@query("a5_first_id_wins", f"WITH f AS (SELECT 0 AS file, id, source, arrived_at FROM seed_entries WHERE kind = 'explicit' UNION ALL SELECT 1, id, source, arrived_at FROM seed_entries) SELECT id, file, source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, arrived_at) AS n FROM f) WHERE n = 1")
def a5(spark, d):
    t = table(spark, d, "seed_entries").select("id", "source", "arrived_at", "kind")
    f = t.filter("kind = 'explicit'").withColumn("file", F.lit(0)).unionByName(t.withColumn("file", F.lit(1)))
    return f.groupBy("id").agg(F.min_by(F.struct("file", "source"), F.struct("file", "arrived_at")).alias("r")).select("id", "r.file", "r.source")


@query("a6_sealed_view", f"WITH {SW} SELECT kind, count(*) AS n, count(DISTINCT source) AS sources FROM w WHERE split = 'test' GROUP BY kind")
def a6(spark, d):
    """Counts of the sealed side; text is never read."""
    return entries(spark, d).select("kind", "source", side().alias("split")).filter("split = 'test'").groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))


@query("a7_wordless_rows", f"WITH {SW} SELECT id FROM w WHERE coalesce(n, '') = ''")
def a7(spark, d):
    return worded(spark, d).filter("coalesce(n, '') = ''").select("id")


@query("a21_case_set", f"WITH {SW} SELECT id, CASE WHEN split = 'test' THEN NULL ELSE text END AS text, list_filter([kind, entry_class, source], lambda x: x IS NOT NULL) AS tags FROM w WHERE split IS NOT NULL")
def a21(spark, d):
    w = worded(spark, d).filter("split IS NOT NULL")
    return w.select("id", F.when(F.col("split") != "test", F.col("text")).alias("text"), F.array_compact(F.array("kind", "entry_class", "source")).alias("tags"))


@query("a22_grounding_snapshot", f"WITH {S}, a AS (SELECT e.key AS k, lower(trim(e.value)) AS v FROM (SELECT unnest(map_entries(expect.args)) AS e FROM s)) SELECT k, v, count(*) AS n FROM a WHERE v != '' GROUP BY ALL")
def a22(spark, d):
    a = entries(spark, d).select(F.explode("expect.args").alias("k", "v")).select("k", F.lower(F.trim("v")).alias("v"))
    return a.filter("v != ''").groupBy("k", "v").agg(F.count("*").alias("n"))


@query("a25_dataset_bundle", f"WITH {SW} SELECT id, split, kind, {KIND.replace('expected', 'expect')} AS answer, {RED} AS clean, coalesce(source_id, id) AS origin FROM w WHERE split IS NOT NULL")
def a25(spark, d):
    w = worded(spark, d).filter("split IS NOT NULL")
    return w.select("id", "split", "kind", L.kind_of(F.col("expect")).alias("answer"), T.redact(F.col("text")).alias("clean"), F.coalesce("source_id", "id").alias("origin"))


@query("a26_calibration_text", f"WITH {SW} SELECT id, replace(text, chr(10), ' ') AS flat FROM w WHERE split = 'train' AND text IS NOT NULL AND (source_id IS NULL OR source_id NOT IN (SELECT source_id FROM w WHERE split IN ('validation', 'test') AND source_id IS NOT NULL))")
def a26(spark, d):
    w = worded(spark, d).select("id", "text", "split", "source_id")
    held = w.filter("split IN ('validation', 'test') AND source_id IS NOT NULL").select("source_id")
    return w.filter("split = 'train' AND text IS NOT NULL").join(held, "source_id", "left_anti").select("id", F.regexp_replace("text", "\n", " ").alias("flat"))


@query("a28_heal_set", f"WITH {SW} SELECT id, r::INT AS copy FROM w, LATERAL (SELECT unnest(range(1, CASE WHEN kind = 'explicit' THEN 4 WHEN kind = 'typo' THEN 2 ELSE 3 END)) AS r) WHERE split = 'train'")
def a28(spark, d):
    times = F.when(F.col("kind") == "explicit", 3).when(F.col("kind") == "typo", 1).otherwise(2)
    return worded(spark, d).filter("split = 'train'").select("id", F.explode(F.sequence(F.lit(1), times)).alias("copy"))


@query("b16_side_markers", f"WITH {SW} SELECT DISTINCT side, split FROM w")
def b16(spark, d):
    return worded(spark, d).select("side", "split").distinct()


GUARD = r"(^|[^a-z_])(?:open_valve|close_valve|start_line|stop_line|set_level)([^a-z_]|$)"


@query("b18_text_guards", f"WITH {S} SELECT id, CASE WHEN regexp_matches(lower(text), '{GUARD}') THEN 'names_operation' WHEN regexp_matches(lower(text), '\\b(?:hand (?:it )?over|ask a human)\\b') THEN 'asks_handoff' WHEN length(trim(text)) < 12 THEN 'too_short' END AS guard FROM s WHERE text IS NOT NULL")
def b18(spark, d):
    low = F.lower("text")
    g = F.when(low.rlike(GUARD), "names_operation").when(low.rlike(r"\b(?:hand (?:it )?over|ask a human)\b"), "asks_handoff").when(F.length(F.trim("text")) < 12, "too_short")
    return entries(spark, d).filter("text IS NOT NULL").select("id", g.alias("guard"))


@query("b21_gold_candidate", f"WITH {S} SELECT id, CASE WHEN expect.escalate THEN 'escalate:' || coalesce(nullif(replace(entry_class, 'decline:', ''), 'escalate'), 'beyond_menu') WHEN expect.explain THEN 'explain' ELSE expect.operation END AS gold FROM s")
def b21(spark, d):
    reason = F.coalesce(F.nullif(F.replace("entry_class", F.lit("decline:"), F.lit("")), F.lit("escalate")), F.lit("beyond_menu"))
    return entries(spark, d).select("id", F.when(F.col("expect.escalate"), F.concat(F.lit("escalate:"), reason)).when(F.col("expect.explain"), "explain").otherwise(F.col("expect.operation")).alias("gold"))


@query("b24_training_seeds", f"WITH {SW} SELECT w.id, CASE WHEN expect.operation IS NULL THEN true ELSE coalesce(o.read_only, false) END AS needs_check FROM w LEFT JOIN operations o ON o.name = w.expect.operation WHERE split = 'train'")
def b24(spark, d):
    ops = table(spark, d, "operations").select(F.col("name").alias("op"), "read_only")
    w = worded(spark, d).filter("split = 'train'").select("id", F.col("expect.operation").alias("op"))
    return w.join(ops, "op", "left").select("id", F.when(F.col("op").isNull(), True).otherwise(F.coalesce("read_only", F.lit(False))).alias("needs_check"))


@query("d18_source_table", f"WITH {SW} SELECT source, count(*) AS n, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split IS NULL) AS unsplit, list_sort(list(DISTINCT kind)) AS kinds FROM w GROUP BY source")
def d18(spark, d):
    return worded(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.expr("split = 'train'")).alias("train"), F.count_if(F.col("split").isNull()).alias("unsplit"), F.array_sort(F.collect_set("kind")).alias("kinds"))


@query("d19_refusals", f"WITH {SW} SELECT CASE WHEN split IS NULL THEN 'no_split' WHEN coalesce(n, '') = '' THEN 'no_text' WHEN len(words) > 60 THEN 'too_long' ELSE 'kept' END AS reason, count(*) AS n FROM w GROUP BY 1")
def d19(spark, d):
    reason = F.when(F.col("split").isNull(), "no_split").when(F.coalesce("n", F.lit("")) == "", "no_text").when(F.size("words") > 60, "too_long").otherwise("kept")
    return worded(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("d20_absent_from_sides", f"WITH {SW}, k AS (SELECT DISTINCT entry_class FROM w), t AS (SELECT unnest(['train', 'validation', 'test']) AS split), h AS (SELECT entry_class, split, count(*) AS n FROM w GROUP BY ALL) SELECT k.entry_class, t.split, coalesce(h.n, 0) AS n FROM k, t LEFT JOIN h ON h.entry_class = k.entry_class AND h.split = t.split")
def d20(spark, d):
    w = worded(spark, d).groupBy("entry_class", "split").agg(F.count("*").alias("n"))
    sides = w.select("entry_class").distinct().select("entry_class", F.explode(F.array(*[F.lit(x) for x in ("train", "validation", "test")])).alias("split"))
    return sides.join(w, ["entry_class", "split"], "left").na.fill(0, ["n"])


@query("d21_yields", f"WITH {P}, x AS (SELECT regexp_extract(model, '^([a-z]+)-', 1) AS tag, regexp_extract(model, '-([a-z])[0-9]*', 1) AS size, grounded FROM p) SELECT tag, size, count(*) AS n, count(*) FILTER (WHERE grounded) AS grounded, round(avg(grounded::INT), 6) AS rate FROM x GROUP BY ALL")
def d21(spark, d):
    p = preds(spark, d).select(F.regexp_extract("model", "^([a-z]+)-", 1).alias("tag"), F.regexp_extract("model", "-([a-z])[0-9]*", 1).alias("size"), "grounded")
    return p.groupBy("tag", "size").agg(F.count("*").alias("n"), F.count_if("grounded").alias("g"), r6(F.avg(F.col("grounded").cast("double"))).alias("rate")).withColumnRenamed("g", "grounded")


@query("d32_merge_counts", f"WITH {SW}, r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY written_at, id) AS k FROM w) SELECT CASE WHEN split IS NULL THEN 'off_split' WHEN coalesce(n, '') = '' THEN 'empty' WHEN k > 1 THEN 'duplicate' ELSE 'kept' END AS reason, count(*) AS n FROM r GROUP BY 1")
def d32(spark, d):
    w = worded(spark, d)
    first = w.groupBy("n").agg(F.min_by("id", F.struct(F.coalesce("written_at", F.lit("9999-12-31").cast("timestamp")), "id")).alias("first"))
    r = w.join(first, w["n"].eqNullSafe(first["n"])).drop(first["n"])
    reason = F.when(F.col("split").isNull(), "off_split").when(F.coalesce("n", F.lit("")) == "", "empty").when(F.col("id") != F.col("first"), "duplicate").otherwise("kept")
    return r.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------------------------------------ windows, order, sets

V = "v AS (SELECT item_id, question_id, rater_id, lower(trim(label)) AS label, voted_at, arrived_at FROM rater_votes)"


@query("e6_latest_vote", f"WITH {V} SELECT item_id, question_id, rater_id, max(voted_at) AS voted_at, count(*) AS votes FROM v GROUP BY ALL")
def e6(spark, d):
    return table(spark, d, "rater_votes").groupBy("item_id", "question_id", "rater_id").agg(F.max("voted_at").alias("voted_at"), F.count("*").alias("votes"))


@query("e6_latest_label", f"WITH {V} SELECT item_id, question_id, rater_id, label FROM (SELECT *, row_number() OVER (PARTITION BY item_id, question_id, rater_id ORDER BY voted_at DESC, arrived_at DESC, label) AS n FROM v WHERE label IS NOT NULL AND label != '') WHERE n = 1")
def e6b(spark, d):
    """The latest record per key as an aggregate: no window sort, partial before the shuffle."""
    v = table(spark, d, "rater_votes").withColumn("label", F.lower(F.trim("label"))).filter("label IS NOT NULL AND label != ''")
    age = F.struct((-F.unix_micros("voted_at")).alias("a"), (-F.unix_micros("arrived_at")).alias("b"), "label")
    return v.groupBy("item_id", "question_id", "rater_id").agg(F.min(age).alias("r")).select("item_id", "question_id", "rater_id", "r.label")


@query("e7_keep_first_exact", f"WITH {SW} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY n ORDER BY written_at, id) AS k FROM w WHERE n != '') WHERE k = 1")
def e7(spark, d):
    return worded(spark, d).filter("n != ''").groupBy("n").agg(F.min(F.struct("written_at", "id")).alias("r")).select("r.id")


@query("e8_round_robin_plan", f"WITH {SW}, q AS (SELECT id, row_number() OVER (PARTITION BY kind ORDER BY id) AS seed FROM w WHERE split = 'train') SELECT id, n::INT AS variation, (n - 1) * 1000000 + seed AS place FROM q, range(1, 4) t(n)")
def e8(spark, d):
    q = rank_by_range(worded(spark, d).filter("split = 'train'").select("kind", "id"), ["kind"], ["id"], "seed")
    return q.select("id", "seed", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("variation")).select("id", "variation", ((F.col("variation") - 1) * 1000000 + F.col("seed")).cast("bigint").alias("place"))


E10 = ("0.7", "0.15", "0.15")


@query(
    "e10_quota_assignment",
    f"""WITH {S}, g AS (SELECT kind, coalesce(source_id, id) AS unit, min(sha256('7:' || coalesce(source_id, id))) AS h FROM s GROUP BY ALL), n AS (SELECT kind, count(*) AS n FROM g GROUP BY kind), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY h, unit) AS k FROM g)
SELECT kind, unit, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'validation' ELSE 'test' END AS side FROM r JOIN {quota_sql("kind", "n", E10)} q USING (kind)""",
)
def e10(spark, d):
    """Stratified split in hash order: units of a kind by rank, cut at quotas by largest remainder."""
    e = entries(spark, d).select("kind", F.coalesce("source_id", "id").alias("unit")).distinct().withColumn("h", F.sha2(F.concat(F.lit("7:"), "unit"), 256))
    n = e.groupBy("kind").agg(F.count("*").alias("n")).withColumn("q", quota(F.col("n"), [F.lit(float(x)) for x in E10]))
    return rank_by_hash(e, ["kind"], "h", "unit").join(n, "kind").select("kind", "unit", sided().alias("side"))


def sided():
    return F.when(F.col("k") <= F.col("q.a"), "train").when(F.col("k") <= F.col("q.a") + F.col("q.b"), "validation").otherwise("test")


@query("e13_id_numbering", f"WITH {S} SELECT id, kind || '-' || lpad(row_number() OVER (PARTITION BY kind ORDER BY id)::VARCHAR, 6, '0') AS new_id FROM s")
def e13(spark, d):
    r = rank_by_range(entries(spark, d).select("kind", "id"), ["kind"], ["id"])
    return r.select("id", F.concat("kind", F.lit("-"), F.lpad(F.col("k").cast("string"), 6, "0")).alias("new_id"))


@query("e15_next_free_id", f"WITH {S}, x AS (SELECT kind, regexp_extract(id, '^(.*?)(\\d+)$', 1) AS prefix, regexp_extract(id, '^(.*?)(\\d+)$', 2) AS num FROM s), g AS (SELECT kind, prefix, length(num) AS width, count(*) AS n, max(num::BIGINT) AS top FROM x GROUP BY ALL) SELECT kind, prefix || lpad((top + 1)::VARCHAR, width::INT, '0') AS next_id FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, prefix, width) AS k FROM g) WHERE k = 1")
def e15(spark, d):
    num = F.regexp_extract("id", r"^(.*?)(\d+)$", 2)
    g = entries(spark, d).groupBy("kind", F.regexp_extract("id", r"^(.*?)(\d+)$", 1).alias("prefix"), F.length(num).alias("width")).agg(F.count("*").alias("n"), F.max(num.cast("bigint")).alias("top"))
    best = g.groupBy("kind").agg(F.min(F.struct((-F.col("n")).alias("n"), "prefix", "width", "top")).alias("r"))
    return best.select("kind", F.concat("r.prefix", F.expr("lpad(cast(r.top + 1 as string), r.width, '0')")).alias("next_id"))


@query("f1_stable_order", f"WITH {SW} SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY id) AS place FROM w WHERE split IS NOT NULL")
def f1(spark, d):
    return rank_by_range(worded(spark, d).filter("split IS NOT NULL").select("split", "id"), ["split"], ["id"], "place")


@query("f2_top_class", f"WITH {P}, {S} SELECT class, n FROM (SELECT s.entry_class AS class, count(*) AS n FROM p JOIN s USING (id) WHERE p.outcome = 'invalid' GROUP BY 1) ORDER BY n DESC, class LIMIT 1")
def f2(spark, d):
    e = entries(spark, d).select("id", F.col("entry_class").alias("class"))
    return preds(spark, d).filter("outcome = 'invalid'").select("id").join(e, "id").groupBy("class").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "class").limit(1)


@query("f4_footprint_order", "SELECT model, row_number() OVER (ORDER BY weight_bits, backbone NULLS LAST, model) AS place FROM models")
def f4(spark, d):
    order = Window.orderBy("weight_bits", F.asc_nulls_last("backbone"), "model")  # the registry, a few dozen models by contract
    return table(spark, d, "models").select("model", F.row_number().over(order).alias("place"))


@query("f6_batch_sizes", f"WITH {S}, c AS (SELECT kind, count(*) AS n FROM s GROUP BY kind) SELECT kind, b::INT AS batch, least(64, n - 64 * b)::INT AS size FROM c, LATERAL (SELECT unnest(range(0, (n + 63) // 64)) AS b)")
def f6(spark, d):
    c = entries(spark, d).groupBy("kind").agg(F.count("*").alias("n"))
    b = c.select("kind", "n", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / 64) - 1).cast("int"))).alias("batch"))
    return b.select("kind", "batch", F.least(F.lit(64), F.col("n") - 64 * F.col("batch")).cast("int").alias("size"))


@query("g1_union_all", f"WITH {S} SELECT 'seed' AS relation, count(*) AS n FROM (SELECT id FROM s UNION ALL SELECT id FROM typed_rows UNION ALL SELECT id FROM bench_rows)")
def g1(spark, d):
    u = entries(spark, d).select("id").union(table(spark, d, "typed_rows").select("id")).union(table(spark, d, "bench_rows").select("id"))
    return u.agg(F.count("*").alias("n")).select(F.lit("seed").alias("relation"), "n")


@query("g2_distinct", f"WITH {S} SELECT DISTINCT kind, entry_class FROM s")
def g2(spark, d):
    return entries(spark, d).select("kind", "entry_class").distinct()


@query("g3_difference", f"WITH {P} SELECT id FROM p WHERE model = 'scorer-main' EXCEPT SELECT id FROM p WHERE model != 'scorer-main' AND outcome = 'propose'")
def g3(spark, d):
    p = preds(spark, d)
    return p.filter("model = 'scorer-main'").select("id").subtract(p.filter("model != 'scorer-main' AND outcome = 'propose'").select("id"))


@query("g4_intersection", f"WITH {SW} SELECT source FROM w WHERE split = 'train' INTERSECT SELECT source FROM w WHERE split = 'test'")
def g4(spark, d):
    w = worded(spark, d)
    return w.filter("split = 'train'").select("source").intersect(w.filter("split = 'test'").select("source"))


@query("g6_kept_vocabulary", f"WITH {SW}, t AS (SELECT DISTINCT unnest(words) AS word FROM w WHERE split = 'train'), e AS (SELECT id, unnest(words) AS word FROM w WHERE split = 'test') SELECT e.id, count(DISTINCT e.word) AS unseen FROM e LEFT JOIN t USING (word) WHERE t.word IS NULL GROUP BY e.id")
def g6(spark, d):
    """Words of test entries that no train entry has."""
    w = worded(spark, d)
    seen = w.filter("split = 'train'").select(F.explode("words").alias("word")).distinct()
    return w.filter("split = 'test'").select("id", F.explode("words").alias("word")).join(seen, "word", "left_anti").groupBy("id").agg(F.countDistinct("word").alias("unseen"))


@query("h5_spellings", "SELECT name, list_sort(list_distinct([name, replace(name, '_', ' '), upper(name), replace(name, '_', '-')])) AS spellings FROM operations")
def h5(spark, d):
    n = F.col("name")
    return table(spark, d, "operations").select("name", F.array_sort(F.array_distinct(F.array(n, F.replace(n, F.lit("_"), F.lit(" ")), F.upper(n), F.replace(n, F.lit("_"), F.lit("-"))))).alias("spellings"))


@query(
    "h6_ground_operation",
    f"""WITH {SW}, v AS (SELECT list(DISTINCT string_split(name, '_')[1]) AS verbs FROM operations), h AS (SELECT id, list_sort(list_intersect(words, verbs)) AS hits FROM w, v) SELECT id, CASE WHEN len(hits) = 1 THEN hits[1] END AS verb, CASE WHEN len(hits) = 0 THEN 'none' WHEN len(hits) > 1 THEN 'ambiguous' ELSE 'one' END AS state FROM h""",
)
def h6(spark, d):
    """The one verb of the domain that a text names; none and several are told apart. The dimension joins by word."""
    w = worded(spark, d).select("id", "words")
    verbs = table(spark, d, "operations").select(F.get(F.split("name", "_"), F.lit(0)).alias("verb")).distinct()
    hit = w.select("id", F.explode(F.array_distinct("words")).alias("verb")).join(verbs, "verb").groupBy("id").agg(F.count("*").alias("n"), F.min("verb").alias("verb"))
    return w.select("id").join(hit, "id", "left").select("id", F.when(F.col("n") == 1, F.col("verb")).alias("verb"), F.when(F.col("n").isNull(), "none").when(F.col("n") > 1, "ambiguous").otherwise("one").alias("state"))


# ---------------------------------------------------------------------------------------- maps of probabilities (H10-H14)

ROLL = f"cand AS (SELECT pos, unnest(map_keys(candidates)) AS raw, unnest(map_values(candidates)) AS v FROM p)"


@query("h10_rollup", f"WITH {P}, {ROLL} SELECT pos, {CANON.format('raw')} AS label, round(sum(v), 9) AS v FROM cand GROUP BY ALL")
def h10(spark, d):
    return preds(spark, d).filter("candidates IS NOT NULL").select("pos", F.explode(L.rollup(F.col("candidates"))).alias("e")).select("pos", F.col("e.key").alias("label"), F.round("e.value", 9).alias("v"))


@query("h11_temperature_scale", f"WITH {P}, {ROLL}, w AS (SELECT pos, raw, greatest(v, 1e-9) ** (1 / 2.0) AS w FROM cand) SELECT pos, raw AS label, round(w / sum(w) OVER (PARTITION BY pos), 6) AS v FROM w")
def h11(spark, d):
    return preds(spark, d).filter("candidates IS NOT NULL").select("pos", F.explode(L.temperature_scale(F.col("candidates"), 2.0)).alias("label", "v")).select("pos", "label", r6(F.col("v")).alias("v"))


@query("h12_vector_scale", f"WITH {P}, {ROLL}, w AS (SELECT pos, raw, greatest(v, 1e-9) * CASE raw WHEN 'explain' THEN 0.5 WHEN 'escalate' THEN 2 ELSE 1 END AS w FROM cand) SELECT pos, raw AS label, round(w / sum(w) OVER (PARTITION BY pos), 6) AS v FROM w")
def h12(spark, d):
    return preds(spark, d).filter("candidates IS NOT NULL").select("pos", F.explode(L.vector_scale(F.col("candidates"), {"explain": 0.5, "escalate": 2.0})).alias("label", "v")).select("pos", "label", r6(F.col("v")).alias("v"))


@query(
    "h14_row_nll",
    f"""WITH {P}, g AS (SELECT pos, CASE WHEN expected.escalate THEN 'escalate' WHEN expected.explain THEN 'explain' ELSE expected.operation END AS gold FROM p), {ROLL},
x AS (SELECT c.pos, greatest(v, 1e-9) ** (1 / 1.5) AS w, {CANON.format('c.raw')} = {CANON.format('g.gold')} AS own FROM cand c JOIN g USING (pos)) SELECT pos, round(ln(sum(w)) - ln(sum(w) FILTER (WHERE own)), 6) AS nll FROM x GROUP BY pos HAVING bool_or(own)""",
)
def h14(spark, d):
    nll = L.row_nll(F.col("candidates"), L.expected_label(F.col("expected")), 1.5)
    return preds(spark, d).filter("candidates IS NOT NULL").select("pos", r6(nll).alias("nll")).filter("nll IS NOT NULL")
