import importlib

from assayer.llm import queries


def test_names_and_sql():
    q = queries.queries()
    assert all(k[0] == "p" and k[1].isdigit() for k in q) and set(queries.oracle_sql()) <= set(q)
    assert {f"p{n}_found" for n in (1, 3, 4, 5, 8)} | {"p6_ids"} <= set(q)


def test_entry_adds_them():
    entry = importlib.import_module("__spark_entry__")
    assert set(queries.queries()) <= set(entry.queries())


def test_found_columns(spark):
    want = {"p1_found": ["relation", "left_id", "right_id"], "p3_found": ["relation", "id"], "p4_found": ["relation", "left_id", "right_id"], "p5_found": ["rater_id"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"]}
    for name, cols in want.items():
        df = queries.queries()[name](spark, "/root/testdata/sf0.001")
        assert df.columns == cols
        if name in ("p1_found", "p4_found"):
            assert df.filter("left_id >= right_id").count() == 0 and df.count() == df.distinct().count()
