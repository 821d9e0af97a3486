"""Languages of documents and of their parts, by nearest centroid.

A part's character n-grams and words make a TF-IDF vector, compared by
cosine with several centroids per language, which spherical k-means finds in
a sample of labelled texts. A part too far from every centroid is rejected;
the others have a confidence, from the distances to the languages. Parts are
sentences, cut further where the script changes for as long as a sentence.

Links, tags, addresses and numbers are no words. A sentence has LONG words,
or fewer of which TELLING occur in the samples of few languages; a part that
is none makes no language of its own and follows its neighbour, so single
names do not count. A document without any such part is taken as one part.

Grams are hashed to BUCKETS places, so that the model has a bound whatever
the sample. Whole Arrow batches are scored at once, by array operations; a
worker remembers the vectors of words.

Defined cases: null, empty and wordless texts have no parts, and one row in
languages() with a null language and confidence 0; no text, sentence or word
is too long; repeated rows give repeated results. The sample is bounded by
SAMPLES texts a language, none above LONGEST characters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import spread, worked_out

#: Labelled texts a language that fit() reads, documents a language that widen() reads, and their longest.
SAMPLES, WIDENED, LONGEST = 2000, 200, 2000
CENTROIDS = 8
#: Words that make a sentence, and telling words that make a shorter one.
LONG, TELLING = 6, 4
#: Cosine to the nearest centroid below which a part is rejected, and sharpness of the confidence.
REJECT, SHARPNESS = 0.15, 0.03
#: Confidence from which on a part makes a language of its own.
SURE = 0.7
#: Places of hashed grams. The table of centroids has at most so many rows of 4 bytes a centroid: 100 MB for six languages.
BUCKETS = 1 << 19
#: Weight of grams that all languages have, and of grams that no sample has.
FLOOR, UNSEEN = 0.05, 0.3
#: Words and grams that a worker remembers, and grams that are scored at once.
REMEMBERED, HELD, AT_ONCE, SLICE = 200_000, 16_000_000, 4_000_000, 100_000

_FOLDED, _DROPPED = "يىكةأإآؤئ", "ًٌٍَُِّْـ​‌‍‎‏⁠﻿\xad"
_FOLD = str.maketrans(_FOLDED, "ییکهااایی", _DROPPED)
#: What makes the run of characters around it no word: links and addresses, digits, and tags from their mark on.
_NOISY = re.compile(r"[@#\d]|://|[wW]{3}\.")
_BLANK = re.compile(r"\s")
_LETTER = rf"[^\W\d_{_DROPPED}]"
_WORD = re.compile(rf"{_LETTER}+(?:[’'{_DROPPED}]+{_LETTER}+)*")
_BOUNDARY = re.compile(r"[.!?؟…。\r\n|*—/]+[\"'»”’)\]]*\s*")

# Ways to write the six languages.
NAMES = {
    "fa": ("fa", "fas", "per", "prs", "persian", "farsi", "فارسی"),
    "ar": ("ar", "ara", "arb", "arabic", "العربية", "عربي", "عربی"),
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "tr": ("tr", "tur", "turkish", "türkçe", "turkce"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
}
PLACEHOLDERS = ("", "?", "??", "???", "-", "--", "und", "unk", "unknown", "none", "null", "nan", "n/a", "na", "xx", "zxx", "mis", "other")


def label_language(label: Column) -> Column:
    """The code of a label however spelt, '' for a placeholder, the label itself if it is another language's."""
    low = F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))
    stem = F.regexp_extract(low, r"^[^-_.]*", 0)
    code = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        code = F.coalesce(code, F.when(low.isin(*names) | stem.isin(*names), lang))
    return F.coalesce(code, F.when(low.isNull() | low.isin(*PLACEHOLDERS), "").otherwise(low))


def folded(word: str) -> str:
    return word.translate(_FOLD).lower()


def masked(text: str) -> str:
    """The text with blanks in place of links, tags, addresses and numbers, places unchanged."""
    out, at = [], 0
    found = _NOISY.search(text)
    while found:
        start = found.start()
        if text[start] != "#":
            while start > at and not text[start - 1].isspace():
                start -= 1
        blank = _BLANK.search(text, found.end())
        end = blank.start() if blank else len(text)
        out += text[at:start], " " * (end - start)
        at = end
        found = _NOISY.search(text, at)
    return "".join(out) + text[at:] if out else text


def words_of(text: str) -> list[str]:
    return _WORD.findall(masked(text))


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans that cover a masked text."""
    ends = []
    for m in _BOUNDARY.finditer(text):
        a, b = m.span()
        if text[a] not in "—/" or (a and text[a - 1].isspace() and text[b - 1].isspace()):
            ends.append(b)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends], ends))


def grams_of(word: str) -> np.ndarray:
    """Places of the word itself and of its n-grams."""
    w = f" {word} "
    size = len(w)
    runs = [(i, i + n) for n in (2, 3, 4) for i in range(size - n + 1)] if size <= 1000 else ((i, i + n) for n in (2, 3, 4) for i in range(size - n + 1))
    rest = 3 * size - 6 if size >= 4 else len(runs)
    found = np.empty(rest + 1, np.int32)
    found[0] = _place(w)
    found[1:] = np.fromiter((_place(w[a:b]) for a, b in runs), np.int32, rest)
    return found


def _place(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


def _room(held: np.ndarray, size: int) -> np.ndarray:
    """The array, longer if it has fewer places than size."""
    return held if size <= len(held) else np.concatenate([held, np.zeros(2 * size - len(held), held.dtype)])


class Words:
    """What a worker remembers of words: their grams, and what scoring made of them."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.grams = np.empty(1 << 12, np.int32)
        self.starts = np.zeros(1 << 10, np.int64)

    @property
    def held(self) -> int:
        """Grams held."""
        return int(self.starts[len(self.ids)])

    def look_up(self, words: Sequence[str]) -> list[int]:
        """The numbers of the words; new ones are added."""
        known = self.ids
        try:
            return [known[w] for w in words]
        except KeyError:
            pass
        for w in dict.fromkeys(words):
            if w not in known:
                found, start, n = grams_of(folded(w)), self.held, len(known)
                end = start + len(found)
                self.grams = _room(self.grams, end)
                self.starts = _room(self.starts, n + 2)
                self.grams[start:end] = found
                self.starts[n + 1] = end
                known[w] = n
        return [known[w] for w in words]

    def expand(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The grams of these words one after another, and the number of grams of each."""
        starts = self.starts[at]
        n = self.starts[at + 1] - starts
        return self.grams[np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())], n


class Centroids:
    """TF-IDF centroids of labelled texts."""

    def __init__(self, texts: list[str], langs: list[str], samples: list[tuple[str, str]] = (), k: int = CENTROIDS, rounds: int = 12):
        self.samples = list(samples)
        self.langs = sorted(set(langs))
        order = sorted(range(len(texts)), key=lambda i: langs[i])  # texts of a language follow one another
        of_lang = np.array([self.langs.index(langs[i]) for i in order], dtype=np.int32)
        rows, counts, words = [], [], Words()
        for i in order:
            found, _ = words.expand(np.array(words.look_up(words_of(texts[i])), dtype=np.int64))
            grams, often = np.unique(found, return_counts=True)
            rows.append(grams.astype(np.int32))
            counts.append(often.astype(np.float32))
            if len(words.ids) > REMEMBERED or words.held > HELD:
                words.forget()
        del words
        n = len(rows)
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        at = np.concatenate(rows) if n else np.zeros(0, np.int32)
        values = np.concatenate(counts) if n else np.zeros(0, np.float32)
        del rows, counts
        df = np.bincount(at, minlength=BUCKETS)
        # a gram of many languages (of place names, say) tells little, whatever its frequency
        ends = np.concatenate([[0], np.cumsum(sizes)])
        borders = np.searchsorted(of_lang, np.arange(len(self.langs) + 1))
        spread = np.zeros(BUCKETS, np.int64)
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            spread += np.bincount(at[ends[a] : ends[b]], minlength=BUCKETS) > 0
        many = len(self.langs)
        self.idf = np.full(BUCKETS, UNSEEN * np.log(1 + n), dtype=np.float32)
        seen = np.flatnonzero(df)
        self.idf[seen] = np.log((1 + n) / (1 + df[seen])) * (np.log(many / spread[seen]) / np.log(max(many, 2)) + FLOOR)
        self.telling = (spread > 0) & (spread <= max(1, many // 3))
        # rows of seen grams only, and one of zeros for all others
        self.row = np.full(BUCKETS, len(seen), np.int32)
        self.row[seen] = np.arange(len(seen))
        values *= self.idf[at]
        at = self.row[at]
        tables, owner = [], []
        for j, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
            mine = slice(ends[a], ends[b])
            tables.append(_k_means(_Sparse(at[mine], values[mine], sizes[a:b], len(seen)), min(k, b - a), rounds))
            owner += [j] * len(tables[-1])
        del at, values
        self.owner = np.array(owner, dtype=np.int64)
        self.table = np.zeros((len(seen) + 1, len(owner)), np.float32)
        for c, one in enumerate(one for t in tables for one in t):
            self.table[:-1, c] = one * self.idf[seen]
        self._start()

    def _start(self) -> None:
        self.words = Words()
        self.vectors = np.empty((0, len(self.owner)), np.float32)
        self.is_telling = np.empty(0, bool)
        self.is_arabic = np.empty(0, bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "vectors", "is_telling", "is_arabic")} | {"samples": []}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def knows(self, word: str) -> bool:
        """Whether a sample has the word."""
        return bool(self.row[grams_of(folded(word))[0]] < len(self.table) - 1)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Numbers of words, whose vectors are at hand then."""
        at = np.array(self.words.look_up(words), dtype=np.int64)
        old, new = len(self.is_telling), len(self.words.ids)
        if new > old:
            if new > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty((2 * new - len(self.vectors), len(self.owner)), np.float32)])
            starts = self.words.starts
            first = starts[old:new]
            a = old
            while a < new:  # so many grams at once, for the memory it takes
                b = max(a + 1, int(np.searchsorted(starts[: new + 1], starts[a] + SLICE, side="right")) - 1)
                if starts[b] - starts[a] <= SLICE:
                    rows = self.table[self.row[self.words.grams[starts[a] : starts[b]]]]
                    self.vectors[a:b] = np.add.reduceat(rows, starts[a:b] - starts[a], axis=0)
                else:
                    self.vectors[a] = sum(self.table[self.row[self.words.grams[x : min(x + SLICE, starts[b])]]].sum(axis=0) for x in range(starts[a], starts[b], SLICE))
                a = b
            self.is_telling = np.concatenate([self.is_telling, self.telling[self.words.grams[first]]])
            named = list(self.words.ids)[old:]
            self.is_arabic = np.concatenate([self.is_arabic, np.array([_is_arabic(w) for w in named], dtype=bool)])
        return at

    def make_room(self) -> None:
        if len(self.words.ids) > REMEMBERED or self.words.held > HELD:
            self._start()

    def best(self, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language (-1: none is near) and the confidence of parts, given the words of all and how many each has, at least one."""
        lang, sure = np.full(len(sizes), -1), np.zeros(len(sizes))
        if not self.langs or not len(sizes):
            return lang, sure
        ends = np.cumsum(sizes)
        weight = np.cumsum(self.words.starts[at + 1] - self.words.starts[at])[ends - 1]
        dots, norms = np.zeros((len(sizes), len(self.owner)), np.float32), np.zeros(len(sizes))
        a = 0
        while a < len(sizes):
            b = max(a + 1, int(np.searchsorted(weight, (weight[a - 1] if a else 0) + AT_ONCE, side="right")))
            some = at[ends[a] - sizes[a] : ends[b - 1]]
            if len(some) and weight[b - 1] - (weight[a - 1] if a else 0) <= AT_ONCE:
                dots[a:b] = np.add.reduceat(self.vectors[some], np.cumsum(sizes[a:b]) - sizes[a:b], axis=0)
                norms[a:b] = self._norms(some, sizes[a:b])
            else:  # one part, longer than what is worked on at once
                often = np.zeros(BUCKETS)
                for x in range(0, len(some), SLICE):
                    dots[a] += self.vectors[some[x : x + SLICE]].sum(axis=0)
                    often += np.bincount(self.words.expand(some[x : x + SLICE])[0], minlength=BUCKETS)
                norms[a] = np.linalg.norm(often * self.idf)
            a = b
        cosines = dots / np.maximum(norms, 1e-9)[:, None]
        scores = np.stack([cosines[:, self.owner == j].max(axis=1) for j in range(len(self.langs))], axis=1).astype(np.float64)
        top = scores.max(axis=1)
        near = top >= REJECT
        lang[:] = np.where(near, scores.argmax(axis=1), -1)
        sure[:] = np.where(near, 1 / np.exp((scores - top[:, None]) / SHARPNESS).sum(axis=1), 0.0)
        return lang, sure

    def _norms(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Lengths of the vectors of parts."""
        grams, n = self.words.expand(at)
        keys = np.repeat(np.repeat(np.arange(len(sizes)), sizes), n) * BUCKETS + grams
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        often = np.diff(np.concatenate([first, [len(keys)]]))
        keys = keys[first]
        return np.sqrt(np.bincount(keys // BUCKETS, np.square(often * self.idf[keys % BUCKETS]), minlength=len(sizes)))

    def classify(self, words: list[str]) -> tuple[str | None, float]:
        """Language and confidence; none if no centroid is near."""
        if not words:
            return None, 0.0
        lang, sure = self.best(self.look_up(words), np.array([len(words)]))
        return (self.langs[lang[0]], float(sure[0])) if lang[0] >= 0 else (None, 0.0)


class _Sparse:
    """Rows of unit length, by columns and values one after another."""

    def __init__(self, at: np.ndarray, values: np.ndarray, sizes: np.ndarray, width: int):
        self.at, self.sizes, self.width = at, sizes, width
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        norm = np.sqrt(np.bincount(self.row, np.square(values), minlength=len(sizes))).astype(np.float32)
        self.values = values / np.maximum(norm, np.float32(1e-9))[self.row]

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width, np.float32)
        out[self.at[self.row == row]] = self.values[self.row == row]
        return out

    def mean(self, rows: np.ndarray) -> np.ndarray:
        some = rows[self.row]
        return np.bincount(self.at[some], self.values[some], minlength=self.width) / max(1, rows.sum())

    def dot(self, one: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * one[self.at], minlength=len(self.sizes))


def _k_means(x: _Sparse, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; no chance in it."""
    c = np.stack([x.dense(r) for r in np.linspace(0, len(x.sizes) - 1, k).astype(int)])
    for _ in range(rounds):
        at = np.stack([x.dot(one) for one in c]).argmax(axis=0)
        for j in range(k):
            if (at == j).any():
                c[j] = x.mean(at == j)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def _sample(df: DataFrame, key: str, text: str, lang: Column, most: int, longest: int, among: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """Texts and languages, at most most a language: those of smallest hash of the key, thinned before they reach the driver."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), lang.alias("l")).where(F.length("t").between(1, longest))
    rows = worked_out(rows, "l").where(F.col("l").isNotNull())
    if among is not None:
        rows = rows.where(F.col("l").isin(*among))
    parts = F.lit(1 << 30)
    hashed = F.pmod(F.xxhash64(F.col("k"), F.lit(7)), parts)
    # by hash, some four times what is taken: the expected number a language, whatever the table's size
    kept = F.lit(False)
    for one, n in rows.groupBy("l").agg(F.count(F.lit(1))).collect():  # one row a language
        kept = kept | ((F.col("l") == one) & (hashed < F.lit(min(1 << 30, (1 << 30) * 4 * most // n))))
    found: dict[str, list] = {}
    for h, k, t, one in rows.where(kept).select(hashed, "k", "t", "l").collect():
        found.setdefault(one, []).append((h, k, t))
    return [(t, one) for one in sorted(found) for _, _, t in sorted(found[one], key=lambda x: (x[0], str(x[1]), x[2]))[:most]]


def fit(samples: DataFrame, key: str, text: str, lang: str, most: int = SAMPLES, longest: int = LONGEST) -> Centroids:
    """Centroids of at most so many samples a language, none above longest characters."""
    found = _sample(samples, key, text, F.col(lang), most, longest)
    return Centroids([t for t, _ in found], [x for _, x in found], found)


def widen(model: Centroids, df: DataFrame, key: str, text: str, label: str, most: int = WIDENED, longest: int = LONGEST, rounds: int = 2) -> Centroids:
    """The model fitted again with sentences of labelled documents beside its samples.

    Of each label a sample by hash of the key, at most most documents and none
    above longest characters, gives up to two sentences each. Those documents
    count of which the model finds a sentence of the label's language and none
    of another; sentences that no centroid is near come first, for what they
    add. The next round starts from what the one before found. The sample only
    trains the model: every document is classified.
    """
    if not model.langs:
        return model
    asked = []
    for i, (t, lang) in enumerate(_sample(df, key, text, label_language(F.col(label)), most, longest, model.langs)):
        clean = masked(t)
        asked += [(i, lang, clean[a:b], words) for a, b in sentences(clean) if len(words := _WORD.findall(clean, a, b)) >= LONG]
    for _ in range(rounds):
        at = model.look_up([w for *_, words in asked for w in words])
        found, sure = model.best(at, np.array([len(words) for *_, words in asked], dtype=np.int64))
        confirmed: dict[int, list] = {}
        far: dict[int, list] = {}
        other = set()
        for (i, lang, t, _), j, c in zip(asked, found.tolist(), sure.tolist(), strict=True):
            if j < 0:
                far.setdefault(i, []).append((t, lang))
            elif model.langs[j] == lang:
                confirmed.setdefault(i, []).append((t, lang))
            elif c >= SURE:
                other.add(i)
        texts, langs = [t for t, _ in model.samples], [x for _, x in model.samples]
        for i, mine in confirmed.items():
            if i not in other:
                for t, lang in (far.get(i, []) + mine[:1] + mine[1:][-1:])[:2]:
                    texts.append(t)
                    langs.append(lang)
        model = Centroids(texts, langs, model.samples)
    return model


def _is_arabic(word: str) -> bool:
    return "؀" <= word[0] <= "ۿ" or "ﭐ" <= word[0] <= "﻿"


def _is_sentence(model: Centroids, at: np.ndarray) -> bool:
    return len(at) >= LONG or (len(at) >= TELLING and int(model.is_telling[at].sum()) >= TELLING)


def _by_script(clean: str, start: int, end: int, at: np.ndarray, model: Centroids) -> list[tuple[int, int, np.ndarray]]:
    """A sentence of two scripts, cut where the script changes between runs as long as a sentence: start, end, words."""
    arabic = model.is_arabic[at]
    edges = np.flatnonzero(arabic[1:] != arabic[:-1]) + 1
    runs = [(a, b) for a, b in zip([0, *edges], [*edges, len(at)], strict=True)]
    cuts: list[int] = []
    script = None
    for a, b in runs:
        if _is_sentence(model, at[a:b]) and arabic[a] != script:
            if script is not None:
                cuts.append(a)
            script = arabic[a]
    if not cuts:
        return [(start, end, at)]
    places = [m.start() for m in _WORD.finditer(clean, start, end)]
    borders = [start, *[places[c] for c in cuts], end]
    return list(zip(borders[:-1], borders[1:], np.split(at, cuts), strict=True))


def parts_of_all(texts: Sequence[str | None], model: Centroids) -> list[list[tuple]]:
    """Parts that cover each text, neighbours of one language put together: start, end, lang, confidence, words."""
    model.make_room()
    spans: list[tuple[int, int, int]] = []  # text, start, end
    words: list[str] = []
    sizes: list[int] = []
    clean: list[str | None] = []
    for i, t in enumerate(texts):
        shown = masked(t) if t else None
        clean.append(shown)
        if t:
            for a, b in sentences(shown):
                own = _WORD.findall(shown, a, b)
                spans.append((i, a, b))
                sizes.append(len(own))
                words += own
    at = model.look_up(words)
    n = np.array(sizes, dtype=np.int64)
    first = np.cumsum(n) - n
    arabic = np.concatenate([[0], np.cumsum(model.is_arabic[at])])[np.concatenate([first, [len(at)]])] if len(n) else np.zeros(1)
    of_arabic = np.diff(arabic)
    mixed = np.flatnonzero((of_arabic > 0) & (of_arabic < n))
    if len(mixed):
        cut = {int(k): _by_script(clean[spans[k][0]], spans[k][1], spans[k][2], at[first[k] : first[k] + n[k]], model) for k in mixed}
        spans = [(i, x, y) for k, (i, a, b) in enumerate(spans) for x, y in ([c[:2] for c in cut[k]] if k in cut else [(a, b)])]
        n = np.array([m for k, size in enumerate(sizes) for m in ([len(c[2]) for c in cut[k]] if k in cut else [size])], dtype=np.int64)
        first = np.cumsum(n) - n
    told = np.diff(np.concatenate([[0], np.cumsum(model.is_telling[at])])[np.concatenate([first, [len(at)]])]) if len(n) else np.zeros(0)
    asked = (n >= LONG) | ((n >= TELLING) & (told >= TELLING))
    lang, sure = np.full(len(n), -1), np.zeros(len(n))
    if asked.any():
        lang[asked], sure[asked] = model.best(at[np.repeat(asked, n)], n[asked])
    lang[sure < SURE] = -1
    sure[lang < 0] = 0.0

    # texts without a part of some language are taken as a whole
    text_of = np.array([s[0] for s in spans], dtype=np.int64)
    has = np.zeros(len(texts), bool)
    has[text_of[lang >= 0]] = True
    in_text = np.bincount(text_of, n, minlength=len(texts)).astype(np.int64) if len(n) else np.zeros(len(texts), np.int64)
    whole = ~has & (in_text > 0)
    whole_lang, whole_sure = np.full(len(texts), -1), np.zeros(len(texts))
    if whole.any():
        whole_lang[whole], whole_sure[whole] = model.best(at[np.repeat(whole[text_of], n)], in_text[whole])

    out: list[list[tuple]] = [[] for _ in texts]
    for i in np.flatnonzero(whole_lang >= 0).tolist():
        out[i] = [(0, len(texts[i]), model.langs[whole_lang[i]], round(float(whole_sure[i]), 4), int(in_text[i]))]
    open_parts: list = []  # start, end, lang, sum of confidence by words, words, words of the sum
    before = -1

    def close() -> None:
        out[before] = [(a, b, model.langs[k], round(s / m, 4), c) for a, b, k, s, c, m in open_parts]

    for (i, a, b), k, s, m, kept in zip(spans, lang.tolist(), sure.tolist(), n.tolist(), has[text_of].tolist() if len(n) else (), strict=True):
        if not kept:
            continue
        if i != before:
            if before >= 0:
                close()
            open_parts, before = [], i
        if open_parts and (k < 0 or open_parts[-1][2] in (-1, k)):
            last = open_parts[-1]
            last[1] = b
            last[4] += m
            if k >= 0:
                last[2], last[3], last[5] = k, last[3] + s * m, last[5] + m
        else:
            open_parts.append([a, b, k, s * m, m, m if k >= 0 else 0])
    if before >= 0:
        close()
    return out


def parts_of(text: str, model: Centroids) -> list[dict]:
    """Parts of one text."""
    return [dict(zip(("start", "end", "lang", "confidence", "words"), p, strict=True)) for p in parts_of_all([text], model)[0]]


PARTS = "array<struct<start:int,end:int,lang:string,confidence:double,words:int>>"
_PART = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("words", pa.int32())])
#: Characters of the texts that are worked on at once.
CHARACTERS = 2_000_000


def _as_arrow(found: list[list[tuple]]) -> pa.Array:
    flat = [p for parts in found for p in parts]
    columns = list(zip(*flat, strict=True)) if flat else [()] * 5
    inner = pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _PART, strict=True)], fields=list(_PART))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), type=pa.int32()), inner)


def with_parts(df: DataFrame, text: str, model: Centroids, out: str = "parts") -> DataFrame:
    """df with out, the parts of text."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            found: list[list[tuple]] = []
            some: list[str | None] = []
            held = 0
            for t in batch.to_pylist():
                some.append(t)
                held += len(t or "")
                if held > CHARACTERS:
                    found += parts_of_all(some, model)
                    some, held = [], 0
            yield _as_arrow(found + parts_of_all(some, model))

    # not deterministic, else a filter on the parts is pushed down, and works them out twice
    parts = F.arrow_udf(run, PARTS).asNondeterministic()
    return spread(df).withColumn(out, parts(text))


def languages(df: DataFrame, key: str, text: str, label: str, model: Centroids) -> DataFrame:
    """<key>, lang, confidence, words, is_wrong, n_langs: each language of each text, whether the label is missing or wrong, and how many languages there are.

    A text without a language has one row: lang null, confidence 0, words 0,
    is_wrong false, n_langs 0.
    """
    rows = with_parts(df.select(F.col(key), F.col(text).alias("_t"), label_language(F.col(label)).alias("_l")), "_t", model, "_p")
    langs = F.array_sort(F.array_distinct(F.transform("_p", lambda p: p["lang"])))
    rows = rows.select(key, "_l", "_p", langs.alias("_langs"))
    total = lambda lang, of: F.aggregate(F.filter("_p", lambda p: p["lang"] == lang), F.lit(0.0), lambda s, p: s + of(p))
    each = rows.select(key, "_l", "_p", "_langs", F.explode_outer("_langs").alias("lang"))
    words = total(F.col("lang"), lambda p: p["words"].cast("double"))
    sure = total(F.col("lang"), lambda p: p["words"] * p["confidence"])
    return each.select(
        key, "lang", F.coalesce(F.round(sure / F.greatest(words, F.lit(1.0)), 4), F.lit(0.0)).alias("confidence"), words.cast("long").alias("words"),
        (F.col("lang").isNotNull() & ~F.array_contains("_langs", F.col("_l"))).alias("is_wrong"), F.size("_langs").alias("n_langs"),
    )
