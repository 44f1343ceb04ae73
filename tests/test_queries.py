"""Spark results against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from assayer.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


MAY_BE_EMPTY = {"a7_wordless_rows", "c1_first_match", "c2_similarity_join", "c3_duplicate_lookup", "k3_resumed_ids"}  # on the smallest tables; the larger ones have rows


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if hasattr(v, "tzinfo"):
        return str(v.replace(tzinfo=None))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert got == want
    assert got or name in MAY_BE_EMPTY, "an empty result proves nothing"


def test_every_query_but_fits_has_sql():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"d2_bootstrap_interval", "d3_stratified_bootstrap", "d4_paired_bootstrap", "j3_calibration"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_filters_and_columns_reach_the_scan(spark):
    plan = registry.queries()["a6_sealed_view"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_vote_is_validated(spark, duck):
    got = {r["state"]: r["n"] for r in registry.queries()["b27_vote_validation"](spark, SF).collect()}
    assert sum(got.values()) == duck.execute("select count(*) from rater_votes").fetchone()[0]


def test_votes_of_both_tables_and_unknown_items(spark, tmp_path):
    at = "cast(null as timestamp)"
    q = """'{"type": "choice", "criteria": {"Yes": null, "no": null}}'"""
    spark.sql(f"SELECT 'x1' AS id, concat('{{\"a\": ', {q}, '}}') AS questions, {at} AS received_at").write.parquet(f"{tmp_path}/typed_rows.parquet")
    spark.sql(f"SELECT 'b1' AS id, 's' AS source, {q} AS question, 'yes' AS label, '{{}}' AS soft_label, {at} AS arrived_at UNION ALL SELECT 'b2', 's', '{{torn', 'yes', '{{}}', {at}").write.parquet(f"{tmp_path}/bench_rows.parquet")
    votes = [("x1", "a", " YES"), ("x1", "question", "yes"), ("b1", "question", "no "), ("b1", "question", "maybe"), ("b2", "question", "yes"), ("zz", "question", "yes"), ("b1", "question", " "), ("b1", "question", None)]
    spark.createDataFrame(votes, "item_id string, question_id string, label string").write.parquet(f"{tmp_path}/rater_votes.parquet")
    got = {r["state"]: r["n"] for r in registry.queries()["b27_vote_validation"](spark, str(tmp_path)).collect()}
    assert got == {"valid": 2, "unknown_label": 1, "unknown_question": 3, "blank": 2}
