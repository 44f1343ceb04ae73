"""Consensus, agreement and rater reliability from votes (problem 5) by minimax conditional entropy.

The vote x of rater i on question j, of kind c and with k options and right answer y, is distributed as
``exp((s_ic + t_j) [x = y]) / (exp(s_ic + t_j) + k - 1)``: the distribution of largest entropy among those that agree
with the answers as often, per rater and kind and per question, as was seen. s tilts raters, t tilts questions. Options differ between
questions, so the indicator of a right vote is the moment that the questions of a kind share.

Each round is coordinate ascent on the dual: label posteriors given s and t, then a Newton step on every s given t, then one on every t given
the new s. Coordinates of one kind don't interact given the other; the square of each is penalised by ALPHA or BETA. The dual's value,
the penalised log-likelihood of the votes with the answers summed out, is computed each round and reported (``p5_dual``); the fit ends when a round
gains less than GAIN of it, and raises if MOST rounds don't reach that.

Scale: raters and questions get numbers once, so that rounds shuffle numbers only. Votes are joined to raters and to (question, label) sums, both
made with partial aggregates; the heaviest raters and labels are salted. Only the tables of raters, questions and posteriors are written between rounds.

Counted votes are, per rater and question, the latest whose trimmed lower-case label is an option of the question. Defined
results: null, blank and no-answer labels, votes on unknown questions or on questions with torn JSON don't count; two
votes at the same time count as the smaller label; null voted_at is the oldest; a question without counted votes has no
consensus; equal posteriors give the smaller label; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm.skew import hot_keys, skew_join
from assayer.runtime import cut_lineage, release, table

ALPHA = 1.0
BETA = 4.0
GAIN, MOST = 1e-3, 60
LEAST_VOTES = 20
UNRELIABLE = 0.525


def _clean(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def _options(kind: Column, criteria: Column) -> Column:
    """Labels a vote may have: names of options, or the places of score levels."""
    c = F.ltrim(criteria)
    named = F.transform(F.map_keys(F.from_json(c, "map<string,string>")), _clean)
    placed = F.transform(F.sequence(F.lit(0), F.greatest(F.size(F.from_json(c, "array<string>")) - 1, F.lit(0))), lambda i: i.cast("string"))
    return F.when(F.lower(kind) == "noul", F.array(F.lit("false"), F.lit("true"))).when(c.startswith("{"), named).when(c.startswith("["), placed)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, question_id, kind, options) of typed_rows and bench_rows, once each."""
    fields = "struct<type:string,criteria:string>"
    typed = (
        table(spark, sf_dir, "typed_rows")
        .select(F.col("id").cast("string").alias("item_id"), F.when(F.try_parse_json("questions").isNotNull(), F.from_json("questions", "map<string,string>")).alias("q"))
        .select("item_id", F.explode("q").alias("question_id", "body"))
    )
    bench = table(spark, sf_dir, "bench_rows").select(F.col("id").cast("string").alias("item_id"), F.lit("question").alias("question_id"), F.when(F.try_parse_json("question").isNotNull(), F.col("question")).alias("body"))
    q = F.from_json("body", fields)
    both = typed.unionByName(bench).select("item_id", "question_id", F.lower(q["type"]).alias("kind"), _options(q["type"], q["criteria"]).alias("options"))
    return both.filter(F.size("options") >= 2).groupBy("item_id", "question_id").agg(F.min(F.struct("kind", "options")).alias("r")).select("item_id", "question_id", "r.*")


def counted_votes(votes: DataFrame, asked: DataFrame) -> DataFrame:
    """(item_id, question_id, kind, k, rater_id, label)"""
    return (
        votes.select(F.col("item_id").cast("string").alias("item_id"), "question_id", "rater_id", _clean(F.col("label")).alias("label"), F.coalesce("voted_at", F.lit("0001-01-01").cast("timestamp")).alias("at"))
        .filter("rater_id IS NOT NULL AND label IS NOT NULL AND label != ''")
        .join(asked, ["item_id", "question_id"])
        .filter(F.array_contains("options", F.col("label")))
        .groupBy("item_id", "question_id", "rater_id")
        .agg(F.min(F.struct((-F.unix_micros("at")).alias("age"), "label", "kind", F.size("options").alias("k"))).alias("r"))
        .select("item_id", "question_id", "r.kind", "r.k", "rater_id", "r.label")
    )


KEY = ["item_id", "question_id"]


def posteriors(votes: DataFrame, tilts: DataFrame, items: DataFrame | None, hot: list[tuple]) -> DataFrame:
    """(qid, k, label, c, t, q, z): probability of each label that has votes; z sums to the log-likelihood of the answers over a question's rows."""
    sums = skew_join(votes, tilts.select("rid", "s"), ["rid"], hot=hot).groupBy("qid", "k", "label").agg(F.sum("s").alias("s"), F.count("*").alias("c"))
    sums = sums.join(items.select("qid", "t"), "qid", "left").withColumn("t", F.coalesce("t", F.lit(0.0))) if items is not None else sums.withColumn("t", F.lit(0.0))
    own = Window.partitionBy("qid")  # at most one row per option
    part = F.exp(F.col("score") - F.col("top"))
    return (
        sums.withColumn("score", F.col("s") + F.col("c") * F.col("t"))
        .withColumn("top", F.greatest(F.max("score").over(own), F.lit(0.0)))
        .withColumn("seen", F.count("*").over(own))
        .withColumn("all", F.sum(part).over(own) + (F.col("k") - F.col("seen")) * F.exp(-F.col("top")))
        .select("qid", "k", "label", "c", "t", (part / F.col("all")).alias("q"), ((F.col("top") + F.log("all") - F.log("k")) / F.col("seen")).alias("z"))
    )


def _stepped(at: str, hold: float):
    """A Newton step of a coordinate from its slope g and bend h, of length 2 at most, where the model's sharpest moves overshoot."""
    step = (F.col("g") - hold * F.col(at)) / (F.col("h") + hold)
    return (F.col(at) + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step))).alias(at)


def coded(votes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Votes as (qid, k, rid, label), and what the numbers stand for: a question, or a rater on one kind of question."""
    questions = cut_lineage(votes.select(*KEY, "kind", "k").distinct().withColumn("qid", F.monotonically_increasing_id()))
    raters = cut_lineage(votes.groupBy("rater_id", "kind").agg(F.count("*").alias("votes")).withColumn("rid", F.monotonically_increasing_id()))
    named = skew_join(votes.join(questions, [*KEY, "kind", "k"]), raters.drop("votes"), ["rater_id", "kind"], hot=hot_keys(votes, ["rater_id", "kind"]))
    return cut_lineage(named.select("qid", "k", "rid", "label")), questions, raters


def dual_ascent(votes: DataFrame, raters: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame, list[float]]:
    """Posteriors, tilts (rid, s, accuracy) and the dual's value after each round. ``rounds`` runs exactly so many."""
    hot, hot_labels = hot_keys(votes, ["rid"]), hot_keys(votes, ["qid", "label"])
    tilts, items, values = cut_lineage(raters.select("rid", F.lit(1.0).alias("s"), F.lit(None).cast("double").alias("accuracy"), F.lit(0.0).alias("log"))), None, []
    e = F.exp(F.col("s") + F.col("t"))
    right = e / (e + F.col("k") - 1)
    slope, bend = F.sum(F.col("q") - F.col("p")).alias("g"), F.sum(F.col("p") * (1 - F.col("p"))).alias("h")
    while True:
        post = cut_lineage(posteriors(votes, tilts, items, hot))
        seen = skew_join(votes, post.select("qid", "label", "t", "q"), ["qid", "label"], hot=hot_labels)
        tilted = lambda by: skew_join(seen, by.select("rid", "s"), ["rid"], hot=hot).withColumn("p", right)  # noqa: E731, B023
        # The sums at the tilts that the posteriors were made with give the value of the dual and the next step of s at once.
        moved = cut_lineage(tilted(tilts).groupBy("rid", "s").agg(slope, bend, F.avg("p").alias("accuracy"), F.sum(F.log(e + F.col("k") - 1) - F.log("k")).alias("log")))
        held = (items.agg(F.sum(F.col("t") * F.col("t"))).first()[0] or 0.0) if items is not None else 0.0
        sums = moved.agg(F.sum("log").alias("log"), F.sum(F.col("s") * F.col("s")).alias("s2")).first()
        answers = post.agg(F.sum("z")).first()[0]
        if answers is None:
            return post, moved.select("rid", "s", "accuracy"), values
        values.append(answers - sums["log"] - ALPHA / 2 * sums["s2"] - BETA / 2 * held)
        done = len(values) > 1 and values[-1] - values[-2] < GAIN * abs(values[-1])
        if (done and rounds is None) or (rounds is not None and len(values) > rounds):
            return post, moved.select("rid", "s", "accuracy"), values
        if len(values) > MOST:
            raise ArithmeticError(f"the dual still gains {values[-1] - values[-2]} after {MOST} rounds")
        new_tilts = cut_lineage(moved.select("rid", _stepped("s", ALPHA)))
        new_items = cut_lineage(tilted(new_tilts).groupBy("qid", "t").agg(slope, bend).select("qid", _stepped("t", BETA)))
        for old in (tilts, items, post, moved):
            if old is not None:
                release(old)
        tilts, items = new_tilts, new_items


def fit(votes: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Posteriors (item_id, question_id, kind, k, label, c, q), and raters (rater_id, votes, s, accuracy): s is the mean tilt over the votes,
    accuracy the mean probability of a right vote under the fitted tilts."""
    numbers, questions, raters = coded(votes)
    post, tilts, _ = dual_ascent(numbers, raters, rounds)
    named = post.drop("k", "z").join(questions, "qid").drop("qid")
    share = lambda c: (F.sum(F.col(c) * F.col("votes")) / F.sum("votes")).alias(c)
    return named, raters.join(tilts, "rid").groupBy("rater_id").agg(F.sum("votes").alias("votes"), share("s"), share("accuracy"))


def votes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(counted_votes(table(spark, sf_dir, "rater_votes"), questions(spark, sf_dir)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raters = fit(votes_of(spark, sf_dir))
    return raters.filter((F.col("votes") >= LEAST_VOTES) & (F.col("accuracy") < UNRELIABLE)).select("rater_id")


def p5_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raters = fit(votes_of(spark, sf_dir))
    return raters.select("rater_id", "votes", F.round("s", 6).alias("tilt"), F.round("accuracy", 6).alias("accuracy"))


def p5_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dual's value after each round, and its gain as a share of it; the last gain is below GAIN."""
    numbers, _, raters = coded(votes_of(spark, sf_dir))
    _, _, values = dual_ascent(numbers, raters)
    rows = [(k, float(v), None if k == 0 else float((v - values[k - 1]) / abs(v))) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "round int, value double, gain double")


def p5_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per question: votes, consensus, its probability, and the share of pairs of votes that agree."""
    post, _ = fit(votes_of(spark, sf_dir))
    best = F.min(F.struct((-F.col("q")).alias("nq"), "label"))
    n, same = F.sum("c"), F.sum(F.col("c") * (F.col("c") - 1))
    return post.groupBy(*KEY, "kind", "k").agg(n.alias("votes"), best.alias("b"), same.alias("same")).select(
        *KEY, "kind", "k", "votes", F.col("b.label").alias("consensus"), F.round(-F.col("b.nq"), 6).alias("probability"),
        F.when(F.col("votes") > 1, F.round(F.col("same") / (F.col("votes") * (F.col("votes") - 1)), 6)).alias("agreement"),
    )


def p5_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Krippendorff's nominal alpha per kind of question, from counts alone."""
    votes = counted_votes(table(spark, sf_dir, "rater_votes"), questions(spark, sf_dir))
    c = votes.groupBy("kind", *KEY, "label").agg(F.count("*").alias("c"))
    unit = c.groupBy("kind", *KEY).agg(F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("c") - 1)).alias("same")).filter("m > 1")
    seen = unit.groupBy("kind").agg(F.count("*").alias("questions"), F.sum("m").alias("votes"), F.sum(F.col("m") - F.col("same") / (F.col("m") - 1)).alias("d"))
    labels = c.join(unit.select("kind", *KEY), ["kind", *KEY]).groupBy("kind", "label").agg(F.sum("c").alias("n")).groupBy("kind").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    expected = F.col("votes") - F.col("pairs") / (F.col("votes") - 1)
    return seen.join(labels, "kind").select("kind", "questions", "votes", F.round(1 - F.col("d") / expected, 6).alias("alpha"))
