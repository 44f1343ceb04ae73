"""Registration of queries with their SQL, and the relations that both sides start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators import decisions as D
from assayer.runtime import table
from assayer.sources.records import first_arrival

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def preds(spark: SparkSession, d: str) -> DataFrame:
    return D.once(table(spark, d, "predictions"))


def judged(spark: SparkSession, d: str) -> DataFrame:
    return D.judged(preds(spark, d), table(spark, d, "operations"))


def slim(spark: SparkSession, d: str, *columns, where=None) -> DataFrame:
    """``columns`` of judged predictions, once per pos.

    A redelivered row repeats its content, so filters and row predicates commute with the removal of copies: they run on the scan, and only the
    few columns that come out are shuffled, by a hash aggregate that sorts nothing.
    """
    j = D.judged(table(spark, d, "predictions"), table(spark, d, "operations"))
    return (j if where is None else j.filter(where)).select("pos", *columns).distinct()


def slim_preds(spark: SparkSession, d: str, *columns, where=None) -> DataFrame:
    """The same of predictions as they are."""
    p = table(spark, d, "predictions")
    return (p if where is None else p.filter(where)).select("pos", *columns).distinct()


def entries(spark: SparkSession, d: str) -> DataFrame:
    """seed_entries, one row per id."""
    return first_arrival(table(spark, d, "seed_entries"), "id", "arrived_at")


def r6(c):
    return F.round(c, 6)


P = "p AS (SELECT DISTINCT ON (pos) * FROM predictions)"
S = "s AS (SELECT DISTINCT ON (id) * FROM seed_entries)"
KIND = "CASE WHEN expected.escalate THEN 'escalate' WHEN expected.explain THEN 'explain' ELSE 'operation' END"
GOLD = "CASE WHEN expected.escalate THEN 'escalate' WHEN expected.explain THEN 'explain' ELSE expected.operation END"
CANON = "CASE WHEN {0} = 'escalate' OR starts_with({0}, 'escalate:') THEN 'escalate' ELSE {0} END"
CAND = f"""cand AS (SELECT pos, unnest(map_keys(candidates)) AS raw, unnest(map_values(candidates)) AS v FROM p),
roll AS (SELECT pos, {CANON.format("raw")} AS label, round(sum(v), 12) AS v FROM cand GROUP BY ALL),
top AS (SELECT pos, label AS top, v AS top_p FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY v DESC, label) AS n FROM roll) WHERE n = 1)"""
CA = "CASE WHEN {k} = 'unit' THEN CASE WHEN ends_with(lower({v}), '.zone') THEN left(lower({v}), length({v}) - 5) WHEN ends_with(lower({v}), ' unit') THEN left(lower({v}), length({v}) - 5) ELSE lower({v}) END ELSE {v} END"
ARGS = lambda m: "list_sort(list_transform(map_entries({0}), lambda e: {{'k': e.key, 'v': {1}}}))".format(m, CA.format(k="e.key", v="e.value"))
JUDGED = f"""{P},
dim AS (SELECT name, read_only, CASE WHEN pos >= 8 THEN ['unit', 'level'] ELSE ['unit'] END AS declared FROM operations),
j0 AS (SELECT p.*, {KIND} AS kind, {GOLD} AS gold, dim.name IS NOT NULL AS known, dim.read_only AS op_read_only, dim.declared FROM p LEFT JOIN dim ON p.operation = dim.name),
j1 AS (SELECT *, CASE WHEN outcome = 'invalid' THEN coalesce(invalid_reason, 'unparseable')
   WHEN outcome = 'propose' THEN CASE
     WHEN operation IS NULL OR NOT known THEN 'unknown_operation'
     WHEN arguments IS NULL THEN 'wrong_type'
     WHEN NOT list_has_all(map_keys(arguments), declared) THEN 'missing_argument'
     WHEN NOT list_has_all(declared, map_keys(arguments)) THEN 'unexpected_argument'
     WHEN len(list_filter(map_values(arguments), lambda v: v IS NULL OR trim(v) = '')) > 0 THEN 'wrong_type' END END AS reason FROM j0),
j2 AS (SELECT *, outcome = 'propose' AND reason IS NULL AS proposed, outcome IN ('escalate', 'abstain_uncertain') AS escalated,
   coalesce(operation = expected.operation, false) AS same_op,
   coalesce({ARGS("arguments")} = {ARGS("coalesce(expected.args, MAP {}::MAP(VARCHAR, VARCHAR))")}, false) AS same_args FROM j1),
j AS (SELECT *, proposed AND same_op AND same_args AS "right", proposed AND NOT coalesce(op_read_only, false) AS mutating,
   proposed AND NOT coalesce(op_read_only, false) AND NOT same_op AS wrong_operation,
   proposed AND NOT coalesce(op_read_only, false) AND same_op AND NOT same_args AS wrong_arguments,
   coalesce(offered, list_sort(map_keys(candidates))) AS offer,
   ends_with(id, '-nocand') OR (candidates IS NOT NULL AND NOT list_contains(list_transform(coalesce(offered, list_sort(map_keys(candidates))), lambda x: {CANON.format("x")}), {CANON.format("gold")})) AS missing FROM j2)"""


def quota_sql(key: str, source: str, fractions: tuple[str, str, str]) -> str:
    """(key, n, a, b, c): items of n per side by largest remainder, each side at least one where n has three."""
    f = fractions
    return f"""(SELECT {key}, n, CASE WHEN n >= 3 THEN a3 ELSE a1 END AS a, CASE WHEN n >= 3 THEN b3 ELSE b1 END AS b, CASE WHEN n >= 3 THEN c3 ELSE c1 END AS c FROM (
 SELECT *, CASE WHEN c2 = 0 AND a2b >= b2 THEN a2b - 1 ELSE a2b END AS a3, CASE WHEN c2 = 0 AND a2b < b2 THEN b2 - 1 ELSE b2 END AS b3, greatest(c2, 1) AS c3 FROM (
 SELECT *, CASE WHEN b1a = 0 AND a2 >= c1a THEN a2 - 1 ELSE a2 END AS a2b, greatest(b1a, 1) AS b2, CASE WHEN b1a = 0 AND a2 < c1a THEN c1a - 1 ELSE c1a END AS c2 FROM (
 SELECT *, greatest(a1, 1) AS a2, CASE WHEN a1 = 0 AND b1 >= c1 THEN b1 - 1 ELSE b1 END AS b1a, CASE WHEN a1 = 0 AND b1 < c1 THEN c1 - 1 ELSE c1 END AS c1a FROM (
 SELECT *, a0 + (1 + (fb > fa)::INT + (fc > fa)::INT <= r)::INT AS a1, b0 + (1 + (fa >= fb)::INT + (fc > fb)::INT <= r)::INT AS b1, c0 + (1 + (fa >= fc)::INT + (fb >= fc)::INT <= r)::INT AS c1 FROM (
 SELECT *, n - a0 - b0 - c0 AS r, n * x - a0 AS fa, n * y - b0 AS fb, n * z - c0 AS fc FROM (
 SELECT *, floor(n * x)::BIGINT AS a0, floor(n * y)::BIGINT AS b0, floor(n * z)::BIGINT AS c0 FROM (SELECT *, ({f[0]})::DOUBLE AS x, ({f[1]})::DOUBLE AS y, ({f[2]})::DOUBLE AS z FROM {source}))))))))"""
