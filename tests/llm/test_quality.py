import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import quality, shape, voters
from assayer.llm.holdout import DRAWN, WRITTEN

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
WHO, WHAT, WHEN = ["We", "They", "The crew", "Nobody", "She"], ["looked at the pump", "went back to the yard", "closed the old valve", "read the report again"], ["in the morning", "after the visit", "before it was dark"]
SAID = [f"{a} {b} {c}" for a in WHO for b in WHAT for c in WHEN]
PROSE = [f"{SAID[i % 60]}, and that was all. {SAID[(7 * i + 3) % 60]} because the part had not come." for i in range(200)]
LISTS = ["\n".join(f"- pump {i}\n- valve {k}" for i in range(9)) for k in range(200)]
# Judged by hand; the voters say nothing or something wrong of them.
UNSEEN = [
    ("Насос утром был в порядке, но отчёт ещё не пришёл. Мы проверим его завтра.", 0),
    ("насос опять стоит и никто не знает почему\nмы ждали час а потом ушли домой", 0),
    ("كانت المضخة بخير هذا الصباح، لكن التقرير لم يصل بعد. سنتحقق من ذلك غدا.", 0),
    ("Pompa bu sabah iyiydi ama rapor henüz gelmedi. Yarın tekrar kontrol edeceğiz.", 0),
    ("मशीन आज सुबह ठीक थी, लेकिन रिपोर्ट अभी तक नहीं आई है। हम कल जाँच करेंगे।", 0),
    ("昨日の試験では、17件の答えが合っていました。炉を開ける前に、必ず担当者に確認してください。", 0),
    ("温度が下がるまで、弁は閉めたままにします。", 0),
    ("page 3 of 9 " * 30, 1),
    ("What we saw was fine.\n" + "page 3 of 9\n" * 12 + "filter bed filter bed filter bed filter bed\n" * 4, 1),
    ("It took an hour.\n" + "".join(f"насос{i}\tкотёл\t{i * 37}\t0.{i}31\n" for i in range(20)), 1),
    ("\n".join(f"{i}) Насос, двор" if i % 2 else f"{i}. Котёл" for i in range(1, 25)), 1),
]


def p_of(fitted, texts):
    return quality.probability(fitted, shape.shapes(texts))


@pytest.fixture(scope="module")
def fitted(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return quality.fit_quality(*quality.fitting_sample(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text", quality.SAMPLE))


def test_holdout(fitted):
    assert np.mean([(p >= 0.5) == bool(k) for p, (_, k) in zip(p_of(fitted, [t for t, _ in DRAWN]), DRAWN, strict=True)]) > 0.97
    assert np.mean([(p >= 0.5) == bool(k) for p, (_, k) in zip(p_of(fitted, [t for t, _ in WRITTEN]), WRITTEN, strict=True)]) >= 0.9


def test_trees_judge_what_the_voters_do_not(fitted):
    votes = [voters.weak_label(t) for t, _ in UNSEEN]
    trees = p_of(fitted, [t for t, _ in UNSEEN]) >= 0.5
    assert [bool(k) for _, k in UNSEEN] == trees.tolist()
    assert sum(v == k for v, (_, k) in zip(votes, UNSEEN, strict=True)) <= 0.7 * len(UNSEEN)


def test_no_voter_is_an_input():
    assert not {f.__name__ for f in voters.VOTERS} & set(shape.NAMES)


def test_hard_texts(spark):
    rows = [(i, t) for i, t in enumerate(PROSE[:60] + LISTS[:60])] + [(900, None), (901, ""), (902, " \n"), (903, "We went to the yard and it was closed. " * 2000), (904, "ab1x" * 20000), (0, PROSE[0]), (None, PROSE[1]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("p", F.lit("x")).withColumn("h", F.lit(1))
    got = [(r["doc_id"], r["p"]) for r in quality.judged(df).collect()]
    by = dict(got)
    assert not {900, 901, 902} & set(by) and by[904] > 0.5 and len(got) == 60 + 60 + 2 + 2
    assert [by[i] >= 0.5 for i in range(120)] == [False] * 60 + [True] * 60
    assert len({p for k, p in got if k == 0}) == 1
    assert quality.judged(df.limit(0)).count() == 0


@pytest.mark.parametrize(("prose", "junk"), [(200, 0), (200, 3), (0, 100)])
def test_tables_with_hardly_any_text_of_a_class(spark, prose, junk):
    df = spark.createDataFrame(list(enumerate(PROSE[:prose] + LISTS[:junk])), "doc_id bigint, text string")
    assert {r["doc_id"] for r in quality.judged(df).filter("p >= 0.5").collect()} == set(range(prose, prose + junk))


def test_sample_is_the_smallest_hashes_of_keys(spark):
    same = "- pump\n- valve\n- hoist"
    df = spark.createDataFrame([(i, same if i % 2 else PROSE[i % 200]) for i in range(500)] + [(1, same)] * 50, "doc_id bigint, text string")
    x, y = quality.fitting_sample(df, "doc_id", "text", 100)
    least = {r["doc_id"] for r in df.orderBy(F.xxhash64("doc_id", F.lit(8))).limit(100).collect()}
    assert len(x) == len(y) == len(least) and y.sum() == sum(i % 2 for i in least)
    again = quality.fitting_sample(df.repartition(7), "doc_id", "text", 100)
    assert (again[0] == x).all() and (again[1] == y).all()


def test_shapes_read_the_whole_text(monkeypatch):
    at = {n: i for i, n in enumerate(shape.NAMES)}
    text = "\n".join(PROSE)
    whole = shape.shapes([text, text + "\n" + "x|y|z\n" * 4000])
    assert whole[0, at["line_signs"]] == 0 and whole[1, at["line_signs"]] > 0.3
    monkeypatch.setattr(shape, "PIECE", 4096)
    assert np.abs(shape.shapes([text])[0] - whole[0])[: len(shape.PAIRS)].max() < 0.002
    monkeypatch.undo()
    several = shape.shapes(["one two", "", text, " \n", "é" * 3])
    assert np.allclose(several[2], whole[0]) and np.isfinite(several).all()


def test_plain_statistics(spark):
    df = spark.createDataFrame([(1, "The pump, it was.\n\n- x"), (2, None), (3, "")], "doc_id bigint, text string").withColumn("w", F.lit(1))
    got = {r["doc_id"]: r for r in quality.text_stats(df).collect()}
    assert got[1]["words"] == 5 and got[1]["line_end_share"] == 0.5 and got[2]["mean_word_length"] is None and got[3]["chars"] == 0
