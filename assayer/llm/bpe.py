"""Encoding of the corpus with a public byte-level BPE vocabulary (problem 6).

A text is cut by the vocabulary's public pattern; each piece starts as bytes. The leaves of a segment tree over the
byte positions hold ``rank << 32 | position`` of the pair that starts there, so the root is the leftmost pair of
least rank. A merge rewrites three leaves (the pair, its live left neighbour, the swallowed right one), each a
logarithmic update, so a piece of n bytes costs O(n log n) however long it is. Pieces seen before in the same
worker come from a memo of at most MEMO entries.

Defined results: null and empty texts give an empty list; blank texts give the tokens of their blanks; repeated rows
give equal lists; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.runtime import table

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the published split pattern of the 50k byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 1 << 18
LONG = 64
NONE = 1 << 62


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


@lru_cache(maxsize=2)
def _ranks(content: bytes) -> tuple[dict[bytes, int], dict[bytes, list[int]]]:
    return read_ranks(content), {}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << max(1, (n - 1).bit_length())
    tree = [NONE] * (2 * size)
    part = [piece[i : i + 1] for i in range(n)]
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    get = ranks.get
    for i in range(n - 1):
        r = get(part[i] + part[i + 1])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(at: int, value: int) -> None:
        at += size
        tree[at] = value
        at >>= 1
        while at:
            a, b = tree[2 * at], tree[2 * at + 1]
            low = a if a < b else b
            if tree[at] == low:
                return
            tree[at] = low
            at >>= 1

    def pair(at: int) -> int:
        to = right[at]
        if to >= n:
            return NONE
        r = get(part[at] + part[to])
        return NONE if r is None else r << 32 | at

    while tree[1] != NONE:
        at = tree[1] & 0xFFFFFFFF
        gone = right[at]
        part[at] += part[gone]
        right[at] = right[gone]
        if right[gone] < n:
            left[right[gone]] = at
        put(gone, NONE)
        put(at, pair(at))
        if left[at] >= 0:
            put(left[at], pair(left[at]))
    out, at = [], 0
    while at < n:
        out.append(ranks[part[at]])
        at = right[at]
    return out


SPLIT = regex.compile(PATTERN)


def encode(text: str, ranks: dict[bytes, int], memo: dict[bytes, list[int]]) -> list[int]:
    out: list[int] = []
    for piece in SPLIT.findall(text):
        known = memo.get(piece)
        if known is None:
            known = merge(piece.encode("utf-8", "surrogatepass"), ranks)
            if len(piece) <= LONG:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[piece] = known
        out += known
    return out


def vocabulary(spark: SparkSession, name: str, tokenizers: str):
    """The vocabulary file, broadcast: its size is that of the file, under 1 MB."""
    return spark.sparkContext.broadcast(Path(tokenizers, f"{name}.tiktoken").read_bytes())


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS, counts: bool = False) -> DataFrame:
    """(key, ids) or, with counts, (key, n_tokens)."""
    shared = vocabulary(df.sparkSession, name, tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, memo = _ranks(shared.value)
        for batch in batches:
            keys = batch.column(0)
            ids = [encode(t, ranks, memo) if t else [] for t in batch.column(1).to_pylist()]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            if counts:
                yield pa.RecordBatch.from_arrays([keys, pa.array(n)], names=[key, "n_tokens"])
            else:
                flat = np.fromiter((x for row in ids for x in row), np.int32, int(n.sum()))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys, lists], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, " + ("n_tokens bigint" if counts else "ids array<int>"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def p6_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), counts=True)
