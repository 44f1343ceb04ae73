"""Labels, candidate maps and distributions as columns.

Three tie rules are kept apart: ``top_candidate`` (label that sorts first), ``gate_argmax`` (label offered earlier) and
``first_argmax`` (lowest index).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ESCALATE, EXPLAIN = "escalate", "explain"
EPS = 1e-9
LOSS_EPS = 1e-12
BINS = 10
DIGITS = 12  # rolled-up sums are rounded, so that a tie doesn't depend on the order of addition


def kind_of(expected: Column, strict: bool = False) -> Column:
    """escalate, explain or operation, in this order. Strict: an unknown shape is an error."""
    k = F.when(expected["escalate"], ESCALATE).when(expected["explain"], EXPLAIN)
    if strict:
        return k.when(expected["operation"].isNotNull(), "operation").otherwise(F.raise_error("unknown expectation").cast("string"))
    return k.otherwise("operation")


def expected_label(expected: Column) -> Column:
    return F.when(expected["escalate"], ESCALATE).when(expected["explain"], EXPLAIN).otherwise(expected["operation"])


def canonical(label: Column) -> Column:
    return F.when((label == ESCALATE) | label.startswith(f"{ESCALATE}:"), F.lit(ESCALATE)).otherwise(label)


def escalate_reason(label: Column) -> Column:
    return F.when(label.startswith(f"{ESCALATE}:"), F.nullif(F.substr(label, F.lit(len(ESCALATE) + 2)), F.lit("")))


def offered_labels(offered: Column, candidates: Column) -> Column:
    """Offered order as recorded, else the labels of the distribution in code-point order."""
    return F.coalesce(offered, F.array_sort(F.map_keys(candidates)))


def rollup(candidates: Column) -> Column:
    """Entries (key, value) with the mass of the escalate family in one entry, keys ascending."""
    labels = F.array_sort(F.array_distinct(F.transform(F.map_keys(candidates), canonical)))
    entries = F.map_entries(candidates)
    mass = lambda k: F.round(F.aggregate(F.filter(entries, lambda e: canonical(e["key"]) == k), F.lit(0.0), lambda a, e: a + e["value"]), DIGITS)
    return F.transform(labels, lambda k: F.struct(k.alias("key"), mass(k).alias("value")))


def top_candidate(entries: Column) -> Column:
    """Entry of greatest value; ties go to the key that sorts first."""
    return F.array_sort(entries, lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))[0]


def gate_argmax(rolled: Column, offered: Column) -> Column:
    """Entry of greatest value; ties go to the key offered earlier, keys not offered come last in order."""
    order = F.array_distinct(F.transform(offered, canonical))
    place = lambda k: F.when(F.array_position(order, k) > 0, F.array_position(order, k)).otherwise(F.lit(1 << 30))
    return F.array_sort(
        rolled,
        lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(place(a["key"]) < place(b["key"]), -1).when(place(a["key"]) > place(b["key"]), 1).when(a["key"] < b["key"], -1).otherwise(1),
    )[0]


def first_argmax(probs: Column) -> Column:
    """Place of the maximum, the lowest of several, from 0."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def second_place(rolled: Column, top: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.filter(rolled, lambda e: e["key"] != top), lambda e: e["value"])), F.lit(0.0))


def entropy(rolled: Column, n_offered: Column) -> Column:
    """-sum p ln p over ln of the number of canonical offered labels; 0 for one label."""
    h = -F.aggregate(rolled, F.lit(0.0), lambda a, e: a + F.when(e["value"] > 0, e["value"] * F.ln(e["value"])).otherwise(0.0))
    return F.when(n_offered <= 1, F.lit(0.0)).otherwise(h / F.ln(F.greatest(n_offered, F.lit(2)).cast("double")))


def mass_of(rolled: Column, label: Column) -> Column:
    """Value of a key, 0 when it is absent."""
    return F.aggregate(F.filter(rolled, lambda e: e["key"] == label), F.lit(0.0), lambda a, e: a + e["value"])


def brier(rolled: Column, gold: Column) -> Column:
    """Over labels and gold; a gold label that is absent adds 1."""
    s = F.aggregate(rolled, F.lit(0.0), lambda a, e: a + F.pow(e["value"] - F.when(e["key"] == gold, 1.0).otherwise(0.0), F.lit(2.0)))
    return s + F.when(F.exists(rolled, lambda e: e["key"] == gold), 0.0).otherwise(1.0)


def log_loss(p: Column) -> Column:
    return -F.ln(F.greatest(p, F.lit(LOSS_EPS)))


def bin_index(p: Column, bins: int = BINS) -> Column:
    return F.least(F.greatest(F.floor(F.round(p * bins, 9)), F.lit(0)), F.lit(bins - 1)).cast("int")


def temperature_scale(candidates: Column, temperature: float) -> Column:
    """max(p, EPS) ** (1 / T) over its sum, as a map."""
    if temperature <= 0:
        raise ValueError(f"a temperature is positive; {temperature} is not")
    powered = F.transform_values(candidates, lambda _, v: F.pow(F.greatest(v, F.lit(EPS)), F.lit(1.0 / temperature)))
    return _over_sum(powered)


def vector_scale(candidates: Column, vector: dict[str, float]) -> Column:
    """Each label's probability times its own scale, 1 by default, over the sum."""
    scale = F.lit(1.0)
    scales = F.create_map(*[x for k, v in sorted(vector.items()) for x in (F.lit(k), F.lit(float(v)))]) if vector else None
    of = lambda k: F.coalesce(F.element_at(scales, k), scale) if scales is not None else scale
    return _over_sum(F.transform_values(candidates, lambda k, v: F.greatest(v, F.lit(EPS)) * of(k)))


def _over_sum(m: Column) -> Column:
    total = F.aggregate(F.map_values(m), F.lit(0.0), lambda a, v: a + v)
    return F.transform_values(m, lambda _, v: F.when(total > 0, v / total).otherwise(F.lit(1.0) / F.size(m)))


def row_nll(candidates: Column, gold: Column, temperature: Column | float = 1.0) -> Column:
    """logsumexp of all scores less that of the gold family; null when no label of the family is there."""
    t = F.lit(float(temperature)) if isinstance(temperature, int | float) else temperature
    scores = F.transform(F.map_entries(candidates), lambda e: F.struct(canonical(e["key"]).alias("key"), (F.ln(F.greatest(e["value"], F.lit(EPS))) / t).alias("value")))
    family = F.filter(scores, lambda e: e["key"] == canonical(gold))
    lse = lambda xs: F.array_max(F.transform(xs, lambda e: e["value"])) + F.ln(F.aggregate(xs, F.lit(0.0), lambda a, e: a + F.exp(e["value"] - F.array_max(F.transform(xs, lambda x: x["value"])))))
    return F.when(F.size(family) > 0, lse(scores) - lse(family))


# ------------------------------------------------------------------------------------------- arrays of probabilities


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, v: a + v)


def normalised(xs: Column) -> Column:
    return F.transform(xs, lambda v: v / total(xs))


def jensen_shannon(p: Column, q: Column) -> Column:
    """In bits; zero probabilities add nothing."""
    part = lambda x, y: F.when(x > 0, x * F.log2(x / ((x + y) / 2))).otherwise(0.0)
    return total(F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2))


def log_softmax(xs: Column) -> Column:
    top = F.array_max(xs)
    z = top + F.ln(total(F.transform(xs, lambda v: F.exp(v - top))))
    return F.transform(xs, lambda v: v - z)


def soften(p: Column, temperature: float) -> Column:
    """p ** (1 / T) over its sum, zeros kept."""
    return normalised(F.transform(p, lambda v: F.when(v > 0, F.pow(v, F.lit(1.0 / temperature))).otherwise(0.0)))


def ordinal_target(n: Column, gold: Column, smoothing: float) -> Column:
    """One-hot at gold with ``smoothing`` shared by the neighbours that exist."""
    near = F.when(gold > 0, 1).otherwise(0) + F.when(gold < n - 1, 1).otherwise(0)
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when(i == gold, F.lit(1.0) - F.when(near > 0, smoothing).otherwise(0.0)).when(F.abs(i - gold) == 1, F.lit(smoothing) / near).otherwise(0.0),
    )


def permuted(xs: Column, order: Column) -> Column:
    return F.transform(order, lambda i: F.get(xs, i))


def unpermuted(xs: Column, order: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(order) - 1), lambda i: F.get(xs, (F.array_position(order, i) - 1).cast("int")))


def mixed(a: Column, b: Column, share: float) -> Column:
    """Weighted mix over its sum; without a second distribution the first stays."""
    return F.when(b.isNull(), a).otherwise(normalised(F.zip_with(a, b, lambda x, y: x * (1 - share) + y * share)))


def wilson(correct: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """Interval of a share, (0, 1) for no trials."""
    d = F.greatest(n, F.lit(1)).cast("double")
    p = correct / d
    mid, half = p + z * z / (2 * d), z * F.sqrt(p * (1 - p) / d + z * z / (4 * d * d))
    low, high = (mid - half) / (1 + z * z / d), (mid + half) / (1 + z * z / d)
    return F.when(n > 0, F.greatest(low, F.lit(0.0))).otherwise(0.0), F.when(n > 0, F.least(high, F.lit(1.0))).otherwise(1.0)


def fake_quantised(values: Column, bits: int) -> Column:
    """Symmetric rounding of a vector to steps of its largest magnitude over 2 ** (bits - 1) - 1, half to even, as real numbers again.

    A negative number that becomes zero is -0.0, which Spark's round would make 0.0.
    """
    top = F.array_max(F.transform(values, lambda x: F.abs(x)))
    step = top / ((1 << (bits - 1)) - 1)
    signed = lambda y: F.when(F.round(y, 6) == 0, y * 0.0).otherwise(F.round(y, 6))
    return F.when(top == 0, F.transform(values, lambda _: F.lit(0.0))).otherwise(F.transform(values, lambda x: signed(F.rint(x / step) * step)))
