"""Text functions as columns: four normalisers, shingles, similarity, redaction, names and ids."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType



def no_words() -> Column:
    return F.array().cast("array<string>")


def normalize_text(t: Column) -> Column:
    """Lower case, runs outside a-z0-9 and white space to one blank, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"[^a-z0-9\s]+", " "), r"\s+", " "))


def unicode_fold(t: Column) -> Column:
    """The same for letters and digits of every script."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def alnum_fold(t: Column) -> Column:
    return F.regexp_replace(F.lower(t), "[^a-z0-9]", "")


def tokens(t: Column) -> Column:
    """Words of the normalised text; none for an empty one."""
    n = normalize_text(t)
    return F.when(F.length(n) > 0, F.split(n, " ")).otherwise(no_words())


def shingles_of(w: Column, size: int = 5) -> Column:
    """Distinct runs of ``size`` words; a shorter text is its own only shingle, an empty one has none.

    ``w`` should be a plain column: a lambda evaluates the expressions in it once per element.
    """
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, F.lit(size)), " "))
    return F.when(F.size(w) == 0, no_words()).when(F.size(w) < size, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(runs))


def shingles(t: Column, size: int = 5) -> Column:
    return shingles_of(tokens(t), size)


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets as arrays: 1 when both are empty, 0 when one is."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def seeded_hash(seed: str, ident: Column, digits: int = 16) -> Column:
    """First hex digits of sha256('seed:id') as a number wide enough for 64 unsigned bits."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256), 1, digits), 16, 10).cast("decimal(20,0)")


REDACTIONS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"),
    ("url", r"https?://[^\s\"'<>]+", "<url>"),
    ("tag", r"\b[a-z]{2}\d{5}\b", "<tag>"),
    ("number", r"\b\d{4,}\b", "<number>"),
)


def redact(t: Column) -> Column:
    for _, pattern, marker in REDACTIONS:
        t = F.regexp_replace(t, pattern, marker)
    return t


def redactions_fired(t: Column) -> Column:
    """Names of the rules that change the text, each judged on what the earlier ones left."""
    fired = []
    for name, pattern, marker in REDACTIONS:
        fired.append(F.when(t.rlike(pattern), F.lit(name)))
        t = F.regexp_replace(t, pattern, marker)
    return F.array_compact(F.array(*fired))


def split_words(name: Column) -> Column:
    """Sides that a file name or header marks, by whole words."""
    return F.array_sort(F.array_distinct(F.array_intersect(F.split(F.lower(name), "[^a-z0-9]+"), F.array(*[F.lit(x) for x in ("test", "held", "heldout", "validation", "val", "train")]))))


def strip_value(t: Column, value: Column) -> tuple[Column, Column]:
    """The text with every span that names ``value`` replaced by a vague reference, and whether it had one."""
    plain = F.regexp_replace(F.trim(value), r"([^A-Za-z0-9 ])", r"\\$1")
    pattern = F.concat(F.lit("(?i)(^|[^A-Za-z0-9])"), plain, F.lit("([^A-Za-z0-9]|$)"))
    return F.regexp_replace(t, pattern, F.lit("$1that one$2")), F.regexp(t, pattern) & (F.trim(value) != "")


def _first_object(said: str | None) -> str | None:
    at = said.find("{") if said else -1
    while at >= 0:
        depth, quoted, skip = 0, False, False
        for k in range(at, len(said)):
            c = said[k]
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            elif c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
                if depth == 0:
                    try:
                        json.loads(said[at : k + 1])
                        return said[at : k + 1]
                    except ValueError:
                        break
        at = said.find("{", at + 1)
    return None


@F.pandas_udf(StringType())
def first_object(said: pd.Series) -> pd.Series:
    """The first balanced JSON object in what a model said, whatever stands around it; braces in strings don't count. Balance is no regular language, so this is Python."""
    return said.map(_first_object)


def verdict(said: Column) -> Column:
    """yes or no of the object's verdict, else null."""
    v = F.lower(F.trim(F.get_json_object(first_object(said), "$.verdict")))
    return F.when(v.isin("yes", "no"), v)


def row_digest(*columns: str) -> Column:
    """48 bits of a digest of a row; sums of them don't depend on order and merge by addition."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, 12), 16, 10).cast("decimal(20,0)")


def table_line(*columns: str) -> Column:
    """A row of a report table."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns]), F.lit(" |"))
