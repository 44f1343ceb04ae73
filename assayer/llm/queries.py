"""The pN_ queries of the subpackage, and SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayer.llm import bpe, consensus, contraction, neardup, overlap, packing, quality, quantiles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": neardup.p1_found,
        "p1_groups": neardup.p1_groups,
        "p2_percentiles": quantiles.p2_percentiles,
        "p2_months": quantiles.p2_months,
        "p2_whole": quantiles.p2_whole,
        "p3_found": contraction.p3_found,
        "p3_splits": contraction.p3_splits,
        "p3_shares": contraction.p3_shares,
        "p4_found": overlap.p4_found,
        "p4_report": overlap.p4_report,
        "p4_spans": overlap.p4_spans,
        "p5_found": consensus.p5_found,
        "p5_raters": consensus.p5_raters,
        "p5_consensus": consensus.p5_consensus,
        "p5_agreement": consensus.p5_agreement,
        "p5_dual": consensus.p5_dual,
        "p6_ids": bpe.p6_ids,
        "p6_lengths": bpe.p6_lengths,
        "p7_packing": packing.p7_packing,
        "p7_fill": packing.p7_fill,
        "p8_found": quality.p8_found,
        "p8_judged": quality.p8_judged,
        "p8_stats": quality.p8_stats,
    }


NAME = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
SPLIT = """CASE WHEN lower(trim({0}, chr(32)||chr(9)||chr(10)||chr(13))) IN ('train', 'training') THEN 'train'
 WHEN lower(trim({0}, chr(32)||chr(9)||chr(10)||chr(13))) IN ('validation', 'val', 'dev') THEN 'validation'
 WHEN lower(trim({0}, chr(32)||chr(9)||chr(10)||chr(13))) = 'test' THEN 'test' END"""

P3 = f"""
WITH RECURSIVE r AS (
 SELECT DISTINCT ON (id) 'seed_entries' AS relation, id, {SPLIT.format("side")} AS split, {NAME.format("source")} AS s, {NAME.format("author")} AS o FROM seed_entries
 UNION ALL
 SELECT DISTINCT ON (id) 'typed_rows', id, {SPLIT.format("split")}, {NAME.format("workflow")}, {NAME.format("contributor")} FROM typed_rows),
n AS (SELECT relation, id, split, relation || '|s|' || s AS v FROM r WHERE s NOT IN ('', 'unknown', 'na')
      UNION ALL SELECT relation, id, split, relation || '|o|' || o FROM r WHERE o NOT IN ('', 'unknown', 'na')),
e AS (SELECT DISTINCT a.v AS a, b.v AS b FROM n a JOIN n b USING (relation, id) WHERE a.v != b.v),
c(root, v) AS (SELECT DISTINCT v, v FROM n UNION SELECT c.root, e.b FROM c JOIN e ON c.v = e.a),
u AS (SELECT v, min(root) AS unit FROM c GROUP BY v),
m AS (SELECT u.unit FROM n JOIN u USING (v) GROUP BY u.unit HAVING count(DISTINCT n.split) > 1)
SELECT DISTINCT n.relation, n.id FROM n JOIN u USING (v) JOIN m USING (unit)"""


WORDS = f"""r AS (
 SELECT DISTINCT ON (id) 'seed_entries' AS relation, id, text, {SPLIT.format("side")} AS split FROM seed_entries
 UNION ALL
 SELECT 'typed_rows', id, array_to_string(list_transform(json_keys(q), lambda k: k || ' ' || coalesce(json_extract_string(q, '$."' || k || '".instructions'), '') || ' ' ||
   CASE json_type(json_extract(q, '$."' || k || '".criteria'))
    WHEN 'OBJECT' THEN array_to_string(list_transform(json_keys(json_extract(q, '$."' || k || '".criteria')), lambda o: o || ' ' || coalesce(json_extract_string(q, '$."' || k || '".criteria."' || o || '"'), '')), ' ')
    WHEN 'ARRAY' THEN array_to_string(json_extract_string(json_extract(q, '$."' || k || '".criteria'), '$[*]'), ' ') ELSE '' END), ' '), split
 FROM (SELECT DISTINCT ON (id) id, CASE WHEN json_valid(questions) THEN questions::JSON END AS q, {SPLIT.format("split")} AS split FROM typed_rows) WHERE json_type(q) = 'OBJECT'),
w AS (SELECT relation, id, split, seq, list_distinct(seq) AS s, len(list_distinct(seq)) AS n FROM (SELECT relation, id, split, regexp_extract_all(lower(text), '[a-z0-9]+') AS seq FROM r WHERE text IS NOT NULL) WHERE len(seq) > 0)"""
NEAR = "(a.seq = b.seq OR (a.n >= 6 AND b.n >= 6 AND 10 * a.n >= 7 * b.n AND 10 * b.n >= 7 * a.n AND 17 * len(list_intersect(a.s, b.s)) >= 7 * (a.n + b.n)))"
GROUPS = f"""{WORDS},
e AS (SELECT a.relation, a.id AS a, b.id AS b FROM w a JOIN w b ON a.relation = b.relation AND a.id != b.id AND {NEAR}),
c(relation, root, id) AS (SELECT relation, id, id FROM w UNION SELECT c.relation, c.root, e.b FROM c JOIN e ON c.relation = e.relation AND c.id = e.a),
g AS (SELECT relation, id, min(root) AS group_id FROM c GROUP BY ALL)"""
P1 = f"WITH RECURSIVE {GROUPS} SELECT a.relation, a.id AS left_id, b.id AS right_id FROM g a JOIN g b ON a.relation = b.relation AND a.group_id = b.group_id AND a.id < b.id"
P1_GROUPS = f"""WITH RECURSIVE {GROUPS} SELECT relation, id, group_id, count(*) OVER (PARTITION BY relation, group_id) AS group_size, coalesce(n, 0)::BIGINT AS n_links
 FROM g LEFT JOIN (SELECT relation, a AS id, count(*) AS n FROM e GROUP BY ALL) USING (relation, id)"""
PAIRS = f"""{WORDS},
o AS (SELECT a.relation, a.id AS train_id, b.id AS eval_id FROM w a JOIN w b ON a.relation = b.relation AND a.split = 'train' AND b.split IN ('validation', 'test') AND
 ({NEAR} OR (a.relation = 'seed_entries' AND len(b.seq) >= 8 AND contains(' ' || array_to_string(a.seq, ' ') || ' ', ' ' || array_to_string(b.seq, ' ') || ' '))))"""
P4 = f"WITH {PAIRS} SELECT relation, least(train_id, eval_id) AS left_id, greatest(train_id, eval_id) AS right_id FROM o"
P4_REPORT = f"""WITH {PAIRS}, h AS (SELECT relation, eval_id AS id, count(*) AS n FROM o GROUP BY ALL),
x AS (SELECT DISTINCT ON (id) 'seed_entries' AS relation, id, {SPLIT.format("side")} AS split, {NAME.format("source")} AS k FROM seed_entries
 UNION ALL SELECT DISTINCT ON (id) 'typed_rows', id, {SPLIT.format("split")}, {NAME.format("workflow")} FROM typed_rows)
SELECT relation, split, CASE WHEN k NOT IN ('', 'unknown', 'na') THEN k END AS origin, count(*) AS records, count(h.n) AS found, coalesce(sum(h.n), 0)::BIGINT AS pairs
FROM x LEFT JOIN h USING (relation, id) WHERE split IN ('validation', 'test') GROUP BY ALL"""
P5_AGREEMENT = """WITH qs AS (
 SELECT item_id, qid, any_value(kind) AS kind, any_value(options) AS options FROM (
  SELECT item_id, qid, lower(body->>'type') AS kind, CASE WHEN lower(body->>'type') = 'noul' THEN ['false', 'true'] WHEN json_type(body->'criteria') = 'OBJECT' THEN list_transform(json_keys(body->'criteria'), lambda o: lower(trim(o)))
   WHEN json_type(body->'criteria') = 'ARRAY' THEN list_transform(range(0, json_array_length(body->'criteria')::BIGINT), lambda i: i::VARCHAR) END AS options FROM (
   SELECT id AS item_id, k AS qid, json_extract(questions::JSON, '$."' || k || '"') AS body FROM (SELECT id, questions, unnest(json_keys(questions::JSON)) AS k FROM typed_rows WHERE json_valid(questions))
   UNION ALL SELECT id, 'question', question::JSON FROM bench_rows WHERE json_valid(question))) WHERE len(options) >= 2 GROUP BY ALL),
v AS (SELECT DISTINCT ON (item_id, question_id, rater_id) item_id, question_id, kind, label FROM (
 SELECT item_id, question_id, rater_id, lower(trim(label, chr(32)||chr(9)||chr(10)||chr(13))) AS label, voted_at FROM rater_votes) r JOIN qs USING (item_id) WHERE question_id = qid AND rater_id IS NOT NULL AND list_contains(options, label)
 ORDER BY item_id, question_id, rater_id, voted_at DESC NULLS LAST, label),
c AS (SELECT kind, item_id, question_id, label, count(*) AS c FROM v GROUP BY ALL),
u AS (SELECT kind, item_id, question_id, sum(c) AS m, sum(c * (c - 1)) AS same FROM c GROUP BY ALL HAVING sum(c) > 1),
s AS (SELECT kind, count(*) AS questions, sum(m) AS votes, sum(m - same / (m - 1)) AS d FROM u GROUP BY kind),
l AS (SELECT kind, sum(n * (n - 1)) AS pairs FROM (SELECT kind, label, sum(c) AS n FROM c JOIN u USING (kind, item_id, question_id) GROUP BY ALL) GROUP BY kind)
SELECT kind, questions, votes::BIGINT AS votes, round(1 - d / (votes - pairs / (votes - 1)), 6) AS alpha FROM s JOIN l USING (kind)"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1, "p1_groups": P1_GROUPS, "p3_found": P3, "p4_found": P4, "p4_report": P4_REPORT, "p5_agreement": P5_AGREEMENT, "p8_stats": quality.p8_stats_sql()}
