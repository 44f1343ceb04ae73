"""Prediction rows judged against a domain: validity, right and wrong proposals, slices, gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions import labels as L
from assayer.sources.records import first_arrival


def once(predictions: DataFrame) -> DataFrame:
    """One row per pos: a redelivered row repeats its content, so the earliest arrival stands for it."""
    return first_arrival(predictions, "pos", "arrived_at")


def op_args(operations: DataFrame, level_from: int = 8) -> DataFrame:
    """Declared arguments per operation: unit for all, level for those from ``level_from`` on."""
    return operations.select(
        F.col("name").alias("op"),
        F.when(F.col("pos") >= level_from, F.array(F.lit("unit"), F.lit("level"))).otherwise(F.array(F.lit("unit"))).alias("declared"),
    )


def with_domain(preds: DataFrame, operations: DataFrame) -> DataFrame:
    """Adds known, read_only and declared of the proposed operation. The domain is at most a few dozen rows by contract."""
    dim = operations.join(op_args(operations), F.col("name") == F.col("op")).select(F.col("name").alias("_op"), F.col("read_only").alias("op_read_only"), F.col("declared").alias("op_declared"))
    return preds.join(dim, F.col("operation") == F.col("_op"), "left").withColumn("known", F.col("_op").isNotNull()).drop("_op")


def argument_error(operation: Column, arguments: Column, known: Column, declared: Column) -> Column:
    """Code of the first problem of a call, or null."""
    keys = F.map_keys(arguments)
    return (
        F.when(operation.isNull() | ~known, "unknown_operation")
        .when(arguments.isNull(), "wrong_type")
        .when(F.size(F.array_except(declared, keys)) > 0, "missing_argument")
        .when(F.size(F.array_except(keys, declared)) > 0, "unexpected_argument")
        .when(F.exists(F.map_values(arguments), lambda v: v.isNull() | (F.trim(v) == "")), "wrong_type")
    )


SUFFIXES = (".zone", " unit")


def canonical_argument(name: Column, value: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """A grounded argument without case and without the first of its kind's suffixes it ends with."""
    low = F.lower(value)
    cut = low
    for s in reversed(suffixes):
        cut = F.when(low.endswith(s), F.substr(low, F.lit(1), F.length(low) - len(s))).otherwise(cut)
    return F.when(name == "unit", cut).otherwise(value)


def same_arguments(got: Column, expected: Column) -> Column:
    as_set = lambda m: F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("k"), canonical_argument(e["key"], e["value"]).alias("v"))))
    return F.coalesce(as_set(got) == as_set(F.coalesce(expected, F.create_map().cast("map<string,string>"))), F.lit(False))


def judged(preds: DataFrame, operations: DataFrame) -> DataFrame:
    """Every row-level predicate of a prediction, as columns."""
    d = with_domain(preds, operations)
    d = d.withColumn("kind", L.kind_of(F.col("expected"))).withColumn("gold", L.expected_label(F.col("expected")))
    error = argument_error(F.col("operation"), F.col("arguments"), F.col("known"), F.col("op_declared"))
    d = d.withColumn("reason", F.when(F.col("outcome") == "invalid", F.coalesce("invalid_reason", F.lit("unparseable"))).when(F.col("outcome") == "propose", error))
    d = d.withColumn("proposed", (F.col("outcome") == "propose") & F.col("reason").isNull())
    d = d.withColumn("escalated", F.col("outcome").isin("escalate", "abstain_uncertain"))
    d = d.withColumn("mutating", F.col("proposed") & ~F.coalesce("op_read_only", F.lit(False)))
    d = d.withColumn("same_op", F.coalesce(F.col("operation") == F.col("expected.operation"), F.lit(False)))
    d = d.withColumn("right", F.col("proposed") & F.col("same_op") & same_arguments(F.col("arguments"), F.col("expected.args")))
    d = d.withColumn("wrong_operation", F.col("mutating") & ~F.col("same_op")).withColumn("wrong_arguments", F.col("mutating") & F.col("same_op") & ~F.col("right"))
    d = d.withColumn("rolled", L.rollup(F.col("candidates"))).withColumn("offer", L.offered_labels(F.col("offered"), F.col("candidates")))
    d = d.withColumn("top", L.top_candidate(F.col("rolled")))
    gone = ~F.array_contains(F.transform("offer", L.canonical), L.canonical(F.col("gold")))
    return d.withColumn("missing", F.col("id").endswith("-nocand") | (F.col("candidates").isNotNull() & gone))


def slice_name(gold: Column, gold_read_only: Column) -> Column:
    return F.when(gold.isin(L.ESCALATE, L.EXPLAIN), "escalate_or_explain").when(F.coalesce(gold_read_only, F.lit(False)), "read_only").otherwise("mutating")


def with_slice(d: DataFrame, operations: DataFrame) -> DataFrame:
    dim = operations.select(F.col("name").alias("gold"), F.col("read_only").alias("_ro"))
    return d.join(dim, "gold", "left").withColumn("slice", slice_name(F.col("gold"), F.col("_ro"))).drop("_ro")


@dataclass(frozen=True)
class Class:
    floor: float | None = None
    margin: float | None = None
    max_entropy: float | None = None


@dataclass(frozen=True)
class Gate:
    escalate: float | None = None
    read_only: Class = Class()
    mutating: Class = Class()

    def columns(self) -> dict[str, float | None]:
        return {"t_escalate": self.escalate} | {f"t_{k}_{f}": getattr(getattr(self, k), f) for k in ("read_only", "mutating") for f in ("floor", "margin", "max_entropy")}


def gate_features(d: DataFrame, operations: DataFrame) -> DataFrame:
    """What a gate looks at: argmax by offered order, its margin, the entropy, the mass of escalation, whether it is read-only."""
    dim = operations.select(F.col("name").alias("g_label"), F.col("read_only").alias("g_read_only"))
    top = L.gate_argmax(F.col("rolled"), F.col("offer"))
    d = d.withColumn("_t", top).withColumn("g_label", F.col("_t.key")).withColumn("g_top", F.col("_t.value")).drop("_t")
    n = F.size(F.array_distinct(F.transform("offer", L.canonical)))
    return (
        d.withColumn("g_margin", F.col("g_top") - L.second_place(F.col("rolled"), F.col("g_label")))
        .withColumn("g_entropy", L.entropy(F.col("rolled"), n))
        .withColumn("g_escalate", L.mass_of(F.col("rolled"), F.lit(L.ESCALATE)))
        .join(dim, "g_label", "left")
        .withColumn("g_read_only", F.coalesce("g_read_only", F.lit(False)))
    )


def decide(thresholds: Mapping[str, Column]) -> tuple[Column, Column]:
    """(outcome, why) in the fixed order of checks; a null threshold never fires, a null distribution has no decision."""
    pick = lambda f: F.when(F.col("g_read_only"), thresholds[f"t_read_only_{f}"]).otherwise(thresholds[f"t_mutating_{f}"])
    fires = lambda c: F.coalesce(c, F.lit(False))
    checks = [
        (F.col("g_label") == L.ESCALATE, "escalate", "argmax"),
        (fires(F.col("g_escalate") >= thresholds["t_escalate"]), "escalate", "threshold"),
        (F.col("g_label") == L.EXPLAIN, "explain", None),
        (fires(F.col("g_top") < pick("floor")), "abstain_uncertain", "floor"),
        (fires(F.col("g_margin") < pick("margin")), "abstain_uncertain", "margin"),
        (fires(F.col("g_entropy") > pick("max_entropy")), "abstain_uncertain", "entropy"),
    ]
    outcome = why = F.when(F.col("g_label").isNull(), F.lit(None).cast("string"))
    for test, to, because in checks:
        outcome, why = outcome.when(test, to), why.when(test, F.lit(because).cast("string"))
    return outcome.otherwise("propose"), why.otherwise(F.lit(None).cast("string"))


def redecided(d: DataFrame, thresholds: Mapping[str, Column]) -> DataFrame:
    """New outcome, operation and reason under the thresholds; arguments are kept only for the same valid proposal."""
    outcome, why = decide(thresholds)
    d = d.withColumn("new", outcome).withColumn("why", why)
    original = F.when(F.col("outcome") == "propose", F.col("operation")).when(~F.col("g_label").isin(L.ESCALATE, L.EXPLAIN), F.col("g_label"))
    same = (F.col("outcome") == "propose") & (F.col("operation") == F.col("g_label"))
    new_outcome = F.when(F.col("new").isNull(), F.col("outcome")).when(F.col("new") != "propose", F.col("new")).when(same & F.col("reason").isNull(), "propose").otherwise("invalid")
    new_reason = (
        F.when(F.col("new").isNull(), F.col("reason"))
        .when(F.col("new") != "propose", F.lit(None).cast("string"))
        .when(same, F.col("reason"))
        .when(original == F.col("g_label"), F.coalesce("reason", F.lit("not_grounded_by_sweep")))
        .otherwise("not_grounded_by_sweep")
    )
    return d.withColumn("n_outcome", new_outcome).withColumn("n_reason", new_reason).withColumn("n_right", (F.col("n_outcome") == "propose") & F.col("right"))
