"""Oversized texts cut at natural boundaries, by lexical cohesion.

A text is cut into units (sentences and lines; where one is too long,
clauses, then words). At every gap between units the word vectors of the
blocks on both sides are compared; a gap where the similarity is a deep
valley is a change of topic. Each piece ends at the deepest valley within
its size window, the later of equally deep ones, and the next piece repeats
the end of the one before, from a word boundary on where there is one.

Defined cases: null gives no piece, a text within the limit (the empty one
too) one piece; a run without any boundary is cut at the limit, but not
before a combining mark or joiner, unless the whole piece would be one
character and its marks. Lengths are code points. The time a text takes
grows as its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 800, 80
#: Units on each side of a gap.
BLOCK = 3
#: A piece holds at least this part of what it may, if a boundary allows it.
FILL = 0.5

_SENTENCE = re.compile(r".+?(?:(?<![.!?؟…。！？])[.!?؟…。！？]++[\"'»”’)\]]*+(?=\s|$)\s*|[\r\n]+\s*|$)", re.S)
_CLAUSE = re.compile(r".+?(?:[،,;؛:—–]\s*|$)", re.S)
_WORD = re.compile(r"\S*\s*", re.S)
_TOKEN = re.compile(r"\w[\w‌]*")


def _glued(text: str, at: int) -> bool:
    """Whether a cut at this place would take a character from its mark or joiner."""
    ch = text[at]
    return bool(unicodedata.combining(ch)) or ch in "‌‍️" or text[at - 1] in "‌‍"


def units(text: str, most: int) -> list[tuple[int, int]]:
    """Spans that cover the text, none longer than most."""

    def cut(start: int, end: int, patterns: tuple) -> Iterator[tuple[int, int]]:
        if end - start <= most:
            yield start, end
        elif patterns:
            found = [m.span() for m in patterns[0].finditer(text, start, end) if m.end() > m.start()]
            for a, b in found if len(found) > 1 else [(start, end)]:
                yield from cut(a, b, patterns[1:])
        else:
            while end - start > most:
                at = start + most
                while at > start + 1 and _glued(text, at):
                    at -= 1
                at = at if at > start + 1 else start + most
                yield start, at
                start = at
            yield start, end

    spans = []
    for m in _SENTENCE.finditer(text):
        if m.end() > m.start():
            spans += cut(m.start(), m.end(), (_CLAUSE, _WORD))
    merged: list[tuple[int, int]] = []
    for a, b in spans:  # words of an overlong clause are put together again where they fit
        if merged and (b - a) < 20 and b - merged[-1][0] <= min(most, 120) and "\n" not in text[merged[-1][0] : a]:
            merged[-1] = (merged[-1][0], b)
        else:
            merged.append((a, b))
    return merged


def depths(text: str, spans: list[tuple[int, int]], block: int = BLOCK) -> list[float]:
    """Depth of the similarity valley at the gap after each span but the last."""
    bags = [Counter(_TOKEN.findall(text[a:b].lower())) for a, b in spans]
    n = len(bags) - 1
    if n < 1:
        return []
    # the blocks on both sides of a gap move along; their dot product and lengths are kept up to date
    left, right = Counter(bags[0]), Counter()
    for bag in bags[1 : 1 + block]:
        right.update(bag)
    dot = sum(k * right[w] for w, k in left.items())
    of_left, of_right = sum(k * k for k in left.values()), sum(k * k for k in right.values())
    sims = []
    for i in range(1, n + 1):
        sims.append(dot / math.sqrt(of_left * of_right) if of_left and of_right else 0.0)
        moves = [(bags[i], 1, -1)]
        if i >= block:
            moves.append((bags[i - block], -1, 0))
        if i + block <= n:
            moves.append((bags[i + block], 0, 1))
        for bag, l, r in moves:
            for w, k in bag.items():
                x, y = left[w], right[w]
                a, b = x + l * k, y + r * k
                dot += a * b - x * y
                of_left += a * a - x * x
                of_right += b * b - y * y
                for side, at in ((left, a), (right, b)):
                    if at:
                        side[w] = at
                    else:
                        del side[w]
    # the peak on each side: where the similarity stops rising
    after, before = sims[:], sims[:]
    for i in range(n - 2, -1, -1):
        if sims[i + 1] >= sims[i]:
            after[i] = after[i + 1]
    for i in range(1, n):
        if sims[i - 1] >= sims[i]:
            before[i] = before[i - 1]
    return [(after[i] - s) + (before[i] - s) for i, s in enumerate(sims)]


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """Start, end and repeated characters of each piece; what is not repeated makes up the text."""
    if len(text) <= limit:
        return [(0, len(text), 0)]
    spans = units(text, limit - overlap)
    depth = depths(text, spans)
    out: list[tuple[int, int, int]] = []
    first, start, back = 0, 0, 0
    while first < len(spans):
        room = limit - back
        last = first
        while last + 1 < len(spans) and spans[last + 1][1] - start <= room:
            last += 1
        if last < len(spans) - 1:
            fair = [k for k in range(first, last + 1) if spans[k][1] - start >= FILL * room] or [last]
            last = max(fair, key=lambda k: (round(depth[k], 9), k))
        end = spans[last][1]
        out.append((start - back, end, back))
        first, start = last + 1, end
        if first < len(spans):
            back = _repeated(text, end, min(overlap, end - out[-1][0] - 1))
    return out


def _repeated(text: str, end: int, most: int) -> int:
    """How many characters before end to repeat: at most so many, from a word's start on."""
    low = max(0, end - most)
    for at in range(low, end):
        if at == 0 or (text[at - 1].isspace() and not text[at].isspace()):
            return end - at
    at = low
    while at < end and at and _glued(text, at):
        at += 1
    return end - at


def split_texts(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """<key>, piece_no, n_pieces, start_at, n_repeated, piece: every text in pieces, positions from 0."""
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("t")).where(F.col("t").isNotNull())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, t in zip(pdf["id"], pdf["t"], strict=True):
                found = pieces(t, limit, overlap)
                out += [(i, k, len(found), a, n, t[a:b]) for k, (a, b, n) in enumerate(found)]
            yield pd.DataFrame(out, columns=["id", "piece_no", "n_pieces", "start_at", "n_repeated", "piece"])

    kind = df.schema[key].dataType.simpleString()
    schema = f"id {kind}, piece_no int, n_pieces int, start_at int, n_repeated int, piece string"
    zero, one = F.lit(0), F.lit(1)
    short = rows.where(F.length("t") <= limit).select("id", zero.alias("piece_no"), one.alias("n_pieces"), zero.alias("start_at"), zero.alias("n_repeated"), F.col("t").alias("piece"))
    long = rows.where(F.length("t") > limit).mapInPandas(cut, schema)
    return short.unionByName(long).withColumnRenamed("id", key)
