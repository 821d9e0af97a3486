"""Visually identical text brought to one form, by vocabulary tries and a weighted edit automaton.

The vocabulary is every token of the whole column, dealt to shards by its
look. A shard's well-spelt tokens make a trie, and each other token walks it
as it stands: look-alikes, joined and composed forms and invisible characters
are moves that cost nothing, any other edit costs 1, and the budget is 0
unless given. Of the words reached the most frequent spelling is the
canonical one; a token that reaches none is normalised by the table. Texts
take the form of each of their tokens.

Look-alikes: width, presentation forms, ligatures and Roman numerals,
compositions, invisible characters, kinds of blank, and letters and digits
of other scripts: those listed below and those that the confusables table of
Unicode (UTS 39, in the version of the ICU library that Spark brings, 16.0
in Spark 4.1) gives for the alphabets in ALPHABETS. Case, accents,
punctuation, the number of blanks, line breaks, tabs, superscripts, the
dotless i and the zero-width non-joiner are visible, as is a joiner between
emoji.

Defined cases: null stays null, an empty text stays empty; repeated texts
come out equal; no token and no text is too long.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.runtime import Scratch, hot_values, lookup_join, spread

#: Tokens of a shard of the vocabulary.
WORDS = 200_000
#: Tokens whose form is another one, and their characters, up to which they are broadcast; more are joined.
SPELLINGS, SPELLING_CHARACTERS = 200_000, 8_000_000
#: Rows of a class that a task pairs with the rest of the class.
PAIRED = 2_000

# Letters and digits that look like another one.
_CYRILLIC = "АВЕКМНОРСТУХЅІЈԌԚԜӀаеорсухѕіјһԁԛԝӏ", "ABEKMHOPCTYXSIJGQWIaeopcyxsijhdqwl"
_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ", "ABEZHIKMNOPTYXovcj"
_ARMENIAN = "ՕՍօոսց", "OUonug"
_ARABIC = "يىكەہھ٠١٢٣٧٨٩", "ییکههه۰۱۲۳۷۸۹"
_LATIN = "ɡ", "g"
LOOK_ALIKES = {a: b for left, right in (_CYRILLIC, _GREEK, _ARMENIAN, _ARABIC, _LATIN) for a, b in zip(left, right, strict=True)}
# Blocks of alphabets whose letters may look like those of another.
ALPHABETS = {"Greek": (0x0370, 0x03FF), "Cyrillic": (0x0400, 0x052F), "Armenian": (0x0530, 0x058F), "Cherokee": (0x13A0, 0x13FF), "Coptic": (0x2C80, 0x2CFF), "Lisu": (0xA4D0, 0xA4FF)}
_VISIBLE_FORMAT = "\u200c"
_JOINER = "\u200d"
_INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180f\u3164\uffa0"
_FORMS = ("<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>", "<font>")
_BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters for the JVM.
_JVM_BLANK = r"\s\x1c-\x1f\x85\p{Z}"
_BLANKS = re.compile(f"([{_BLANK}]+)")
#: Blanks that look like a plain one.
_SPACES = "".join(ch for ch in _BLANK if unicodedata.category(ch) == "Zs" and ch != " ")
_AS_SPACE = str.maketrans(_SPACES, " " * len(_SPACES))


def _joined(ch: str) -> bool:
    return "\ufb00" <= ch <= "\ufb4f" or "\u2160" <= ch <= "\u217f" or ch in "\u0132\u0133\u01c4\u01c5\u01c6\u01c7\u01c8\u01c9\u01ca\u01cb\u01cc\u01f1\u01f2\u01f3"


def units_of(ch: str, table: dict[str, str] = LOOK_ALIKES) -> str:
    """What a character looks like, by table: no, one or several basic characters."""
    if ch == _VISIBLE_FORMAT:
        return ch
    kind = unicodedata.category(ch)
    if kind == "Cf" or ch in _INVISIBLE or "\ufe00" <= ch <= "\ufe0f" or "\U000e0100" <= ch <= "\U000e01ef":
        return ""
    if kind == "Zs":
        return " "
    apart = unicodedata.decomposition(ch)
    if apart and (not apart.startswith("<") or apart.startswith(_FORMS) or (apart.startswith("<compat>") and _joined(ch))):
        return "".join(units_of(chr(int(x, 16)), table) for x in apart.split() if not x.startswith("<"))
    return unicodedata.normalize("NFD", table.get(ch, ch))


def confusables(spark: SparkSession) -> dict[str, str]:
    """LOOK_ALIKES and what the confusables table of the JVM's ICU adds for ALPHABETS.

    A letter goes to the Latin one of its case that has the same skeleton, or
    else to the first letter of another alphabet that has. Where several
    letters of one alphabet have one skeleton they can be told apart, so
    those not listed stay as they are.
    """
    latin = [chr(c) for c in range(0x41, 0x7B) if chr(c).isalpha()]
    letters = [(a, chr(c)) for a, (low, high) in ALPHABETS.items() for c in range(low, high + 1) if unicodedata.category(chr(c)) in ("Lu", "Ll", "Lo") and not unicodedata.decomposition(chr(c))]
    asked = latin + [ch for _, ch in letters]
    skeletons = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton(0, "\n".join(asked)).split("\n")
    looks = {ch: (s, unicodedata.category(ch).replace("Lo", "Lu")) for ch, s in zip(asked, skeletons, strict=True)}
    plain = {}
    for ch in latin:
        plain.setdefault(looks[ch], ch)
    sharing: dict[tuple, list[str]] = {}
    for a, ch in letters:
        sharing.setdefault((a, looks[ch]), []).append(ch)
    table, first = dict(LOOK_ALIKES), {}
    for (a, look), group in sharing.items():
        if len(group) == 1 and group[0] not in table:
            target = plain.get(look) or first.setdefault(look, group[0])
            if target != group[0]:
                table[group[0]] = target
    return table


class Look:
    """units_of() with a memory, and the joiner between emoji kept."""

    def __init__(self, table: dict[str, str] = LOOK_ALIKES) -> None:
        self.table = table
        self.known: dict[str, str] = {}
        self.plain: dict[str, bool] = {}

    def moves(self, token: str) -> Iterator[str]:
        """What each character of a token moves along, marks of one letter in their order."""
        known, marks = self.known, []
        for i, ch in enumerate(token):
            u = known.get(ch)
            if u is None:
                u = known[ch] = units_of(ch, self.table)
            if ch == _JOINER and 0 < i < len(token) - 1 and _pictured(token[i - 1]) and _pictured(token[i + 1]):
                u = ch
            if u.isascii() and not marks:
                yield u
                continue
            for unit in u:
                if unicodedata.combining(unit):
                    marks.append(unit)
                else:
                    yield from sorted(marks, key=unicodedata.combining)
                    marks.clear()
                    yield unit
        yield from sorted(marks, key=unicodedata.combining)

    def units(self, token: str) -> str:
        return "".join(self.moves(token))

    def table_form(self, token: str) -> str:
        return unicodedata.normalize("NFC", self.units(token))

    def well_spelt(self, word: str) -> bool:
        """Whether a word may be a canonical spelling: nothing in disguise, Arabic and Persian forms both count as plain."""
        if word.isascii():
            return True
        for ch in word:
            ok = self.plain.get(ch)
            if ok is None:
                ok = self.plain[ch] = unicodedata.normalize("NFC", units_of(ch, self.table)) == ch or ch in _ARABIC[0]
            if not ok:
                return False
        return unicodedata.normalize("NFC", word) == word


def _pictured(ch: str) -> bool:
    return unicodedata.category(ch) in ("So", "Sk") or ch == "\ufe0f"


class Trie:
    """Well-spelt words by what they look like; an end holds the most frequent spelling.

    A node maps units to nodes and '' to its end. A branch of one word is kept
    as (units of the word, how many of them lead here, end).
    """

    def __init__(self, words: Sequence[tuple[str, int]], look: Look):
        self.look = look
        self.root: dict = {}
        for word, n in words:
            if look.well_spelt(word):
                self._add(look.units(word), (-n, word))

    def _add(self, units: str, end: tuple[int, str]) -> None:
        node, asked = self.root, False
        for i, unit in enumerate(units):
            child = node.get(unit)
            if child is None:
                node[unit] = (units, i + 1, end)
                return
            if isinstance(child, tuple):
                if not asked and child[0] == units:
                    node[unit] = (units, i + 1, min(end, child[2]))
                    return
                asked = True  # the two part further on: one node a unit until they do
                other, at, its = child
                child = node[unit] = {other[at]: (other, at + 1, its)} if at < len(other) else {"": its}
            node = child
        node[""] = min(end, node.get("", end))

    @staticmethod
    def _after(node: dict | tuple, unit: str) -> dict | tuple | None:
        if isinstance(node, dict):
            return node.get(unit)
        units, at, end = node
        return (units, at + 1, end) if at < len(units) and units[at] == unit else None

    @staticmethod
    def _all_after(node: dict | tuple) -> list[tuple[str, dict | tuple]]:
        if isinstance(node, dict):
            return [(u, child) for u, child in node.items() if u]
        units, at, end = node
        return [(units[at], (units, at + 1, end))] if at < len(units) else []

    @staticmethod
    def _end(node: dict | tuple) -> tuple[int, str] | None:
        if isinstance(node, dict):
            return node.get("")
        return node[2] if node[1] == len(node[0]) else None

    def find(self, token: str, budget: int = 0) -> str | None:
        """The best spelling within the budget: least cost, then most frequent, then smallest.

        The states of the automaton are places of the trie with their cost; a
        character of the token moves them along the units it looks like.
        """

        def reach(into: dict, node: dict | tuple, cost: int) -> None:
            """A state, and those that follow it by units of the word that the token lacks."""
            place = id(node) if isinstance(node, dict) else (node[0], node[1])
            if cost <= budget and (place not in into or into[place][1] > cost):
                into[place] = (node, cost)
                if cost < budget:
                    for _, child in self._all_after(node):
                        reach(into, child, cost + 1)

        states: dict = {}
        reach(states, self.root, 0)
        for move in self.look.moves(token):
            for unit in move:
                if not budget:
                    (node, _), = states.values()
                    node = self._after(node, unit)
                    if node is None:
                        return None
                    states = {0: (node, 0)}
                    continue
                after: dict = {}
                for node, cost in states.values():
                    if (child := self._after(node, unit)) is not None:
                        reach(after, child, cost)
                    if cost < budget:
                        reach(after, node, cost + 1)
                        for other, child in self._all_after(node):
                            if other != unit:
                                reach(after, child, cost + 1)
                states = after
                if not states:
                    return None
        ends = [(cost, *end) for node, cost in states.values() if (end := self._end(node)) is not None]
        return min(ends)[2] if ends else None


def form_of(token: str, trie: Trie) -> str:
    """The canonical spelling of a token, or what the table makes of it."""
    found = trie.find(token)
    return trie.look.table_form(token) if found is None else found


def with_forms(forms: Callable[[str], str]) -> Callable[[str], str]:
    """The function that brings a text to its form, given the form of every token."""

    def canonical(text: str) -> str:
        parts = _BLANKS.split(text)
        parts[::2] = map(forms, parts[::2])
        parts[1::2] = [x.translate(_AS_SPACE) for x in parts[1::2]]
        return "".join(parts)

    return canonical


def canonizer(words: Sequence[tuple[str, int]], table: dict[str, str] = LOOK_ALIKES) -> Callable[[str], str]:
    """The function that brings a text to its form by a vocabulary at hand."""
    trie = Trie(words, Look(table))
    return with_forms(lambda token: form_of(token, trie))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"[{_JVM_BLANK}]+"), lambda x: x != "")


def spellings(df: DataFrame, text: str, scratch: Scratch, words_per_task: int = WORDS) -> DataFrame:
    """token, form, n: every token of the column whose form is another one, and how often it occurs.

    Tokens that look the same are in one shard, so that each meets every
    spelling of it that the column has.
    """
    tokens = spread(df.select(F.col(text).alias("t"))).select(F.explode(_tokens(F.col("t"))).alias("token"))
    counts = scratch.write(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "tokens")
    shared = df.sparkSession.sparkContext.broadcast(confusables(df.sparkSession))  # some hundred letters

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = Look(shared.value)
        for pdf in batches:
            yield pdf.assign(look=[zlib.crc32((t if t.isascii() else look.units(t)).encode("utf-8", "surrogatepass")) for t in pdf["token"]])

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = [w for pdf in batches for w in zip(pdf["token"].tolist(), pdf["n"].tolist(), strict=True)]
        trie = Trie(words, Look(shared.value))
        found = [(w, form, n) for w, n in words if not w.isascii() and (form := form_of(w, trie)) != w]
        yield pd.DataFrame(found, columns=["token", "form", "n"])

    shards = max(1, -(-counts.count() // words_per_task))
    routed = counts.mapInPandas(route, "token string, n bigint, look bigint").repartition(shards, "look")
    return scratch.write(routed.mapInPandas(match, "token string, form string, n bigint"), "spellings")


def canonical_text(df: DataFrame, text: str, out: str, scratch: Scratch | None = None, most: int = SPELLINGS, words_per_task: int = WORDS) -> DataFrame:
    """df with out, the one form of text."""
    scratch = scratch or Scratch(df.sparkSession, "looks")
    other = spellings(df, text, scratch, words_per_task)
    n, characters = other.agg(F.count(F.lit(1)), F.sum(F.length("token") + F.length("form"))).first()
    if n > most or (characters or 0) > SPELLING_CHARACTERS:
        return _joined_text(df, text, out, other, scratch)
    shared = df.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in other.select("token", "form").collect()})  # counted above

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forms = shared.value
        canonical = with_forms(lambda token: forms.get(token, token))
        for s in batches:
            yield pd.Series([t if t is None or t.isascii() else canonical(t) for t in s], dtype=object)

    return spread(df).withColumn(out, form.asNondeterministic()(text))


def _joined_text(df: DataFrame, text: str, out: str, other: DataFrame, scratch: Scratch) -> DataFrame:
    """The same by a join of every token with its form."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != out])
    rows = scratch.write(df.select(row.alias("row"), F.col(text).alias("t")).withColumn("at", F.monotonically_increasing_id()), "rows")
    parts = rows.select("at", F.posexplode(F.regexp_extract_all("t", F.lit(f"([{_JVM_BLANK}]+|[^{_JVM_BLANK}]+)"), F.lit(1))).alias("k", "token"))
    hot = hot_values(other, "token", "n")
    parts = lookup_join(parts, other.select("token", "form"), ["token"], hot, F.struct("at", "k"), "left")
    blank = F.when(F.col("token").rlike(f"^[{_JVM_BLANK}]"), F.translate("token", _SPACES, " " * len(_SPACES))).otherwise(F.col("token"))
    texts = parts.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("form", blank).alias("f")))).alias("l"))
    texts = texts.select("at", F.array_join(F.transform("l", lambda x: x["f"]), "").alias("form"))
    return rows.join(texts, "at", "left").select("row.*", F.coalesce("form", "t").alias(out))


def look_classes(df: DataFrame, key: str, text: str, scratch: Scratch | None = None) -> DataFrame:
    """id, class_id, c1, c2, r, n: rows of classes of texts that look the same and are not all equal, with the smallest key of the class and its number of rows.

    c1 and c2 are 128 bits of the form, r 64 of the text itself.
    """
    scratch = scratch or Scratch(df.sparkSession, "looks")
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull())
    forms = canonical_text(rows, "t", "f", scratch)
    prints = forms.select("id", F.xxhash64("f").alias("c1"), F.xxhash64(F.lit(1), "f").alias("c2"), F.xxhash64("t").alias("r"))
    prints = scratch.write(prints.distinct(), "prints")
    classes = prints.groupBy("c1", "c2").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    classes = scratch.write(classes.where(F.col("low") != F.col("high")).select("c1", "c2", "class_id", "n"), "classes")
    return scratch.write(lookup_join(prints, classes, ["c1", "c2"], hot_values(classes, "c1", "n"), F.col("id")), "members")


def look_alike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """post_a, post_b: every two rows whose texts differ and look the same, the smaller key first.

    The pairs come from the members of look_classes(): one side of a class is
    dealt to tasks of PAIRED rows, to each of which the other side goes, so
    the work is that of the result and no task has more than its part of it.
    """
    members = look_classes(df, key, text)
    slices = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / PAIRED))
    left = members.select("c1", "c2", F.pmod(F.xxhash64("id"), slices).alias("_slice"), F.col("id").alias("ia"), F.col("r").alias("ra"))
    right = members.select("c1", "c2", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("_slice"), F.col("id").alias("ib"), F.col("r").alias("rb"))
    pairs = left.join(right, ["c1", "c2", "_slice"]).where((F.col("ia") < F.col("ib")) & (F.col("ra") != F.col("rb")))
    return pairs.select(F.col("ia").alias("post_a"), F.col("ib").alias("post_b"))
