"""Statistics of the shape of texts that need no dictionary and no language, for whole batches at once (problem 8).

Every character falls in one of twelve classes by its Unicode category. A text is described by how often one class follows
another, by the lengths of its words and tokens, by the share of characters in lines of some property, and by how well its
windows compress. All are ratios of sums over pieces, so a text of any length is read whole in pieces of bounded memory.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Sequence

import numpy as np

LINE, BLANK, LOWER, UPPER, DIGIT, END, COMMA, QUOTE, BRACKET, SIGN, ODD, MARK = range(12)
CLASSES = 12
PIECE = 1 << 18  # characters worked on at once
WINDOW = 4096  # characters compressed at once
SHORT, LONG = 3, 24


def _class_of(c: str) -> int:
    if c in "\n\r\x85\u2028\u2029":
        return LINE
    if c.isspace():
        return BLANK
    if c in ".!?…。！？؟।۔።":
        return END
    if c in ",;:、，،；：؛":
        return COMMA
    if c in "'\"-‐‑‒–—’‘“”„«»「」":
        return QUOTE
    kind = unicodedata.category(c)
    if kind in ("Ll", "Lo", "Lm"):
        return LOWER
    if kind in ("Lu", "Lt"):
        return UPPER
    if kind[0] == "N":
        return DIGIT
    if kind in ("Ps", "Pe") or c in "<>":
        return BRACKET
    if kind[0] == "M":
        return MARK
    return SIGN if ord(c) < 128 and kind != "Cc" else ODD


TABLE = np.array([_class_of(chr(i)) for i in range(1 << 16)] + [LOWER, ODD], np.int64)  # by code; then letters and others beyond 2^16

LINES = (
    "ends", "letter_first", "lettered", "few_letters", "digits", "signs", "wordy", "brief", "short_words", "no_short_words", "single", "odd", "long_token", "gaps", "again", "commas", "told",
)
PAIRS = tuple((a, b) for a in range(CLASSES) for b in range(CLASSES))
SUMS = ("chars", "words", "letters", "squares", "short", "tokens", "single", "long", "lines", "raw", "zipped")
NAMES = (
    *(f"follows_{a}_{b}" for a, b in PAIRS), *(f"line_{x}" for x in LINES),
    "size", "word_length", "word_spread", "short_words", "words_per_char", "single_tokens", "token_length", "long_tokens", "line_length", "zipped",
)


def _cut(texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    pieces, owner = [], []
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t)), PIECE):
            pieces.append(t[lo : lo + PIECE])
            owner.append(i)
    return pieces, np.array(owner, np.int64)


def _sums(pieces: list[str]) -> np.ndarray:
    """Sums of one group of pieces: pairs of classes, characters by line property, SUMS."""
    k = len(pieces)
    joined = "\n".join(pieces) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = TABLE[np.where(code < 1 << 16, code, np.where((code >= 0x20000) & (code < 0x32000), 1 << 16, (1 << 16) + 1))]
    for _ in range(2):  # a mark on a letter is part of it
        c[1:][(c[1:] == MARK) & ((c[:-1] == LOWER) | (c[:-1] == UPPER))] = LOWER
    n = np.array([len(p) + 1 for p in pieces])
    start = np.cumsum(n) - n
    piece = np.repeat(np.arange(k), n)
    out_pairs = np.bincount(piece * CLASSES * CLASSES + np.append(LINE, c[:-1]) * CLASSES + c, minlength=k * CLASSES * CLASSES).reshape(k, -1).astype(float)

    line_end = np.flatnonzero(c == LINE)
    line_of = np.zeros(len(c), np.int64)
    line_of[1:] = np.cumsum(c == LINE)[:-1]
    m = len(line_end)
    line_from = np.append(0, line_end[:-1] + 1)
    by = np.bincount(line_of * CLASSES + c, minlength=m * CLASSES).reshape(m, CLASSES)
    ink = by[:, LOWER:].sum(1)
    some = np.maximum(ink, 1)

    def runs(inside: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] if breaks is None else ~inside[:-1] | breaks[1:]
        last[:-1] &= ~inside[1:] if breaks is None else ~inside[1:] | breaks[1:]
        a = np.flatnonzero(first)
        return a, np.flatnonzero(last) - a + 1

    # Scripts without blanks: a word ends where kana and other letters meet, and after two of other characters.
    kana, han = (code >= 0x3041) & (code <= 0x309F), (code >= 0x30A0) & (code <= 0x9FFF)
    breaks = (han & ((np.arange(len(code)) - start[piece]) % 2 == 0)) | (np.diff(kana, prepend=False) & (kana | han))
    wa, wl = runs((c == LOWER) | (c == UPPER), breaks)
    ta, tl = runs(c > BLANK)
    words = np.bincount(line_of[wa], minlength=m)
    few = np.bincount(line_of[wa[wl <= SHORT]], minlength=m)
    tokens = np.bincount(line_of[ta], minlength=m)
    ones = np.bincount(line_of[ta[tl == 1]], minlength=m)
    longs = np.bincount(line_of[ta], np.where(tl >= LONG, tl, 0), m)
    blank = np.flatnonzero(c == BLANK)
    wide = np.zeros(m, np.int64)
    if len(blank):
        gap = (np.diff(blank, prepend=-9) == 1) & (np.diff(blank, append=blank[-1] + 9) == 1) | (code[blank] == 9)
        wide = np.bincount(line_of[blank[gap]], minlength=m)
    first, last = np.full(m, BLANK), np.full(m, BLANK)
    if len(ta):
        to = ta + tl - 1
        first[line_of[ta[::-1]]] = c[ta[::-1]]
        last[line_of[to]] = c[to]
        closing = (c[to] == QUOTE) | (c[to] == BRACKET)
        inner = np.where(closing & (tl > 1), c[np.maximum(to - 1, 0)], c[to])
        last[line_of[to]] = inner
    mixed = (code.astype(np.uint64) + (np.arange(len(code)) - line_from[line_of]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    own = np.add.reduceat(mixed * np.uint64(0xC2B2AE3D27D4EB4F), line_from) + piece[line_from].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    _, which, times = np.unique(own, return_inverse=True, return_counts=True)

    letters = by[:, LOWER] + by[:, UPPER] + by[:, MARK]
    short_share = few / np.maximum(words, 1)
    lettered = letters >= 0.85 * some
    told = lettered & (words >= 4) & (short_share >= 0.15)
    flags = (
        last == END, (first == LOWER) | (first == UPPER), lettered, letters < 0.6 * some, by[:, DIGIT] >= 0.15 * some, by[:, SIGN] + by[:, BRACKET] >= 0.08 * some,
        words >= 7, words <= 3, short_share >= 0.2, (words >= 3) & (short_share < 0.06), (ones >= 0.5 * tokens) & (tokens >= 5), by[:, ODD] >= 0.08 * some, longs >= 0.4 * some, wide >= 2,
        (times[which] >= 3) & (ink > 0), by[:, COMMA] >= np.maximum(2, 0.3 * words), told,
    )
    line_piece = piece[line_from]
    out_lines = np.stack([np.bincount(line_piece, ink * f, k) for f in flags], 1)
    per = lambda at, w=None: np.bincount(piece[at], w, k)
    raw, zipped = np.zeros(k), np.zeros(k)
    for i, p in enumerate(pieces):
        for lo in range(0, len(p), WINDOW):
            b = p[lo : lo + WINDOW].encode("utf-8", "surrogatepass")
            raw[i] += len(b)
            zipped[i] += len(zlib.compress(b, 1)) - 8
    sums = [
        np.bincount(line_piece, ink, k), per(wa), per(wa, wl), per(wa, wl.astype(float) ** 2), per(wa[wl <= SHORT]), per(ta), per(ta[tl == 1]), per(ta, np.where(tl >= LONG, tl, 0)),
        np.bincount(line_piece, ink > 0, k), raw, zipped,
    ]
    return np.concatenate([out_pairs, out_lines, np.stack(sums, 1)], 1)


def shapes(texts: Sequence[str]) -> np.ndarray:
    """One row of NAMES per text."""
    pieces, owner = _cut(texts)
    total = np.zeros((len(texts), len(PAIRS) + len(LINES) + len(SUMS)))
    lo = 0
    while lo < len(pieces):
        hi, held = lo, 0
        while hi < len(pieces) and (hi == lo or held + len(pieces[hi]) <= PIECE):
            held += len(pieces[hi])
            hi += 1
        np.add.at(total, owner[lo:hi], _sums(pieces[lo:hi]))
        lo = hi
    pairs, lines, sums = np.split(total, [len(PAIRS), len(PAIRS) + len(LINES)], 1)
    s = dict(zip(SUMS, sums.T, strict=True))
    least = lambda x: np.maximum(x, 1)
    mean = s["letters"] / least(s["words"])
    rest = [
        np.log1p(s["chars"]), mean, np.sqrt(np.maximum(s["squares"] / least(s["words"]) - mean**2, 0)) / least(mean), s["short"] / least(s["words"]), s["words"] / least(s["chars"]),
        s["single"] / least(s["tokens"]), s["chars"] / least(s["tokens"]), s["long"] / least(s["chars"]), np.log1p(s["chars"] / least(s["lines"])), s["zipped"] / least(s["raw"]),
    ]
    return np.concatenate([pairs / least(pairs.sum(1, keepdims=True)), lines / least(s["chars"])[:, None], np.stack(rest, 1)], 1)
