"""Weak voters on whether a text is natural prose (problem 8): they label the fitting sample only.

Each voter looks at another side of a text and says junk (1), prose (-1) or nothing (0). No statistic that the trees are
given is a voter's output, and no voter sees the trees' inputs, so the trees can contradict a voter that is wrong.
"""

from __future__ import annotations

import re
from collections import Counter

# Frequent function words of five languages. A text in another language gets no vote from them.
COMMON = {
    "en": "the of and to in a is that it was for on with as be at by this had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so said what up its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too",
    "de": "der die das und ist nicht ein eine zu den von mit dem des sich auf für es im sie er wir war hat an auch als wie aber nach noch bei nur so wenn man kann aus um am vor werden sind oder dann bis einen einem zur zum ob",
    "fr": "le la les de des du et un une est que qui ne pas dans en pour il elle ce cette sur au aux avec sont plus par on nous vous se mais même était si tout sa son depuis avant où",
    "es": "el la los las de del y un una es que no en por con se lo su para al como más pero ya ha fue muy sin sobre este esta son cuando hay también si porque todos era antes",
    "pl": "i w z na nie to się jest że do jak po ale o co tak za od czy był już tylko jeśli przez ten ta te być są kiedy lub dla może bo przed pod by tym jeszcze który wszystkie kto nikt",
}
WORDS = frozenset(" ".join(COMMON.values()).split())
LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
LIST = re.compile(r"^\s*(?:[-*+•◦‣–>]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\[[ xX]\])\s+\S")
LOG = re.compile(r"^\s*\[?(?:\d{4}[-/]\d\d[-/]\d\d|\d{1,2}[/.]\d{1,2}(?:[/.]\d{2,4})?|\d{1,2}:\d\d(?::\d\d)?|\d{10,13}\b)[T ,\]]?.*(?:\b(?:info|debug|warn|warning|error|trace|fatal)\b|\[|=)", re.I)
PAIR = re.compile(r"^\s*[\"']?[\w.-]{1,40}[\"']?\s*(?:=|:|=>|->)\s*\S{0,60}(?: \S{1,20}){0,2}[,;]?\s*$")
CODE = re.compile(r"(?:[;{}]\s*$|^\s*[{}\[\]()]+,?;?\s*$|^\s*(?:def|for|if|else|elif|while|return|import|class|var|let|const|function)\b.*[({:;=\[]|[\w\])]\s*(?:==|!=|\+=|:=|&&|\|\||=)\s*[\w\[({\"']|</?\w+[^>]*>|^\s*\"[^\"]*\"\s*:|^\s*\"[^\"]*\",?\s*$|^[{\[].*[}\]]\s*$)")
CELLS = re.compile(r"\s*[|;¦]\s*|\t+|(?<=\S) {3,}(?=\S)")
TRAIL = re.compile(r"\s+[·•|»›>/~]\s+")
BAD = re.compile(r"[�□¤\u0080-\u009f]|Ã.|â€|(?<![^\W\d_])[̀-ͯ]")
ENDS = re.compile(r"[.!?…。！？]+")
MOST = 0.70  # share of a text from which a voter speaks


def by_lines(text: str) -> int:
    """Lines in the form of lists, tables, pairs, logs, code and menus."""
    total = formed = 0
    for s in text.splitlines():
        n = len(s.strip())
        if not n:
            continue
        total += n
        if LIST.match(s) or LOG.match(s) or PAIR.match(s) or CODE.search(s) or len(CELLS.findall(s)) >= 2 or len(TRAIL.findall(s)) >= 3:
            formed += n
    return int(formed >= MOST * total)


def by_words(text: str) -> int:
    """Function words by their share of the characters, where the language is one of COMMON."""
    found = WORD.findall(text)
    if len(found) < 8 or sum(map(str.isascii, found)) < 0.5 * len(found):
        return 0
    share = sum(len(w) for w in found if len(w) > 1 and w.lower() in WORDS) / sum(map(len, text.split()))
    return -1 if share >= 0.14 else int(share < 0.05 and len(found) >= 16)


def by_sentences(text: str) -> int:
    """Sentences: they end in a mark, begin as one, and have the length of one."""
    good = 0
    for s in ENDS.split(text)[:-1]:
        s = s.strip()
        words = s.split()
        first = s[:1]
        if not first.isalpha() or first.islower() or not (4 <= len(words) <= 60 or (not first.isupper() and 6 <= len(s) <= 120)):
            continue
        if len(LETTER.findall(s)) >= 0.7 * sum(map(len, words)) >= 0.7 * 2 * len(words):
            good += len(s) + 1
    return -int(good >= MOST * len(text.strip()))


def by_repeats(text: str) -> int:
    """One token or line again and again."""
    tokens = text.split()
    if len(tokens) < 8:
        return 0
    often = Counter(tokens).most_common(3)
    if sum(k for _, k in often) >= MOST * len(tokens):
        return 1
    lines = Counter(x.strip() for x in text.splitlines())
    return int(sum(len(x) * k for x, k in lines.items() if k >= 4) >= MOST * sum(len(x) * k for x, k in lines.items()))


def by_characters(text: str) -> int:
    """Encoded, broken and torn-apart text."""
    tokens = text.split()
    ink = sum(map(len, tokens))
    if len(BAD.findall(text)) >= 0.15 * ink or (len(tokens) >= 8 and sum(len(t) == 1 for t in tokens) >= MOST * len(tokens)):
        return 1
    long = sum(len(t) for t in tokens if len(t) >= 32 and t.isascii())
    return int(long >= MOST * ink or len(LETTER.findall(text)) < 0.45 * ink)


VOTERS = (by_lines, by_words, by_sentences, by_repeats, by_characters)


def weak_label(text: str) -> float | None:
    """1 junk, 0 prose, None where voters are silent or as many say one as the other."""
    vote = sum(v(text) for v in VOTERS)
    return None if vote == 0 else float(vote > 0)
