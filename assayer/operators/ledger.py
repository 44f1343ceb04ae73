"""Append-only logs as tables: chained decisions, logs of one decision a line, measurements that may be made once, stages that are stale.

A log is one writer's and orders its lines, so its digests are made in one pass over its bytes; every check on them is a DataFrame of violations.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE = "place long, id string, cited string, digest string, overrides string, broken boolean"


class LedgerError(ValueError):
    pass


def chain_lines(spark: SparkSession, lines: Iterable[bytes]) -> DataFrame:
    """One row a line with the digest of all bytes before it, kept by a running hash; a line that is no JSON object is broken."""
    seen, rows = hashlib.sha256(), []
    for place, line in enumerate(lines, 1):
        try:
            said = json.loads(line)
        except ValueError:
            said = None
        fields = said if isinstance(said, dict) else {}
        rows.append((place, fields.get("id"), fields.get("prev_sha256"), seen.hexdigest(), fields.get("overrides"), not isinstance(said, dict)))
        seen.update(line)
    return spark.createDataFrame(rows, LINE)


def chain_violations(lines: DataFrame) -> DataFrame:
    """(place, rule): broken, out_of_order, changed_before, unknown_override. An intact log has none."""
    known = lines.select(F.col("id").alias("overrides"), F.col("place").alias("_at"))
    late = lines.filter("overrides IS NOT NULL").join(known, "overrides", "left").groupBy("place").agg(F.coalesce(F.min("_at") < F.col("place"), F.lit(False)).alias("ok"))
    rules = {"broken": F.col("broken"), "out_of_order": ~F.col("broken") & ~F.col("id").eqNullSafe(F.concat(F.lit("D"), F.col("place"))), "changed_before": ~F.col("broken") & ~F.col("cited").eqNullSafe(F.col("digest"))}
    named = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in rules.items()]))
    return lines.select("place", F.explode(named).alias("rule")).unionByName(late.filter(~F.col("ok")).select("place", F.lit("unknown_override").alias("rule")))


def chained(spark: SparkSession, lines: Sequence[bytes], new: Mapping) -> bytes:
    """The line that ``new`` becomes behind an intact log; a log with violations takes none."""
    bad = chain_violations(chain_lines(spark, lines)).limit(3).collect()
    if bad:
        raise LedgerError(f"the log is not intact: {[(r['place'], r['rule']) for r in bad]}")
    whole = b"".join(lines)
    return json.dumps({**new, "id": f"D{len(lines) + 1}", "prev_sha256": hashlib.sha256(whole).hexdigest()}, sort_keys=True).encode() + b"\n"


def latest(log: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The last record of each key: an ordered aggregate, no sort of a key's records in a window."""
    rest = [c for c in log.columns if c not in keys]
    order = F.struct(*seq, *[c for c in rest if c not in seq])
    return log.groupBy(*keys).agg(F.max(order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def once_states(log: DataFrame, keys: Sequence[str], order: Sequence[str], deviation: str) -> DataFrame:
    """Each measurement with its state: first of its keys, deviation where one is named, else refused."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return log.withColumn("state", F.when(place == 1, "first").when(F.col(deviation).isNotNull(), "deviation").otherwise("refused"))


def trainable(corrections: DataFrame, decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Corrections whose last decision keeps or edits them: keys and ``target``.

    ``corrections`` has keys, seq and label; ``decisions`` has keys, seq, action (keep, edit, reject), cites (hash of the label it judged) and payload. A decision on
    another state of the correction is stale and counts as none.
    """
    now = latest(corrections.select(*keys, "seq", "label"), keys, ["seq"]).drop("seq")
    said = latest(decisions.select(*keys, "seq", "action", "cites", "payload"), keys, ["seq"]).drop("seq")
    good = now.join(said, list(keys)).filter((F.col("action") != "reject") & (F.col("cites") == label_hash(F.col("label"))))
    return good.select(*keys, F.when(F.col("action") == "edit", F.col("payload")).otherwise(F.col("label")).alias("target"))


def label_hash(label: Column) -> Column:
    return F.md5(F.coalesce(label, F.lit("")))


def content_hash(value: object) -> str:
    """sha256 of JSON with sorted keys and no blanks."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def stale_stages(stages: Mapping[str, Mapping], done: Mapping[str, Mapping]) -> list[str]:
    """Stages to run, in order: no finished record, other inputs or knobs, or a stage before them that is stale.

    stages: name -> {after: names, inputs: hashes, knobs: values}, in topological order.
    """
    out: list[str] = []
    for name, s in stages.items():
        own = done.get(name)
        fresh = own is not None and own.get("status") == "done" and own.get("inputs") == s.get("inputs") and own.get("knobs") == s.get("knobs")
        if not fresh or any(x in out for x in s.get("after", ())):
            out.append(name)
    return out


def replay(actions: Iterable[Mapping]) -> dict | None:
    """The value that keep, drop, edit and restore leave, in order; an edit back to the start clears itself."""
    state: dict | None = {"edits": {}, "dropped": False}
    for a in actions:
        kind = a["action"]
        if kind == "drop":
            state["dropped"] = True
        elif kind in ("keep", "restore"):
            state["dropped"] = False
            if kind == "restore":
                state["edits"] = {}
        elif kind == "edit":
            state["edits"][a["field"]] = a["value"]
            if a["value"] == a.get("base"):
                del state["edits"][a["field"]]
        elif kind != "note":
            raise LedgerError(f"unknown action {kind!r}")
    return state
