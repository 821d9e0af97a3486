"""Several names packed into one string: one name a row, with its position.

Each field becomes a lattice of names: atoms between separators, with quoted
spans sealed, and runs of unquoted atoms as they stand. The column tells how
often each name occurs. Names start with the times they stand beyond doubt
(quoted, alone, or in lattices of one way); expectation-maximisation adds the
expected times of the doubtful ones, by the forward and backward weights of
each lattice, until these settle, and every lattice gives its Viterbi path.
A run that stands nowhere beyond doubt starts with no weight and so keeps
none: lattices leave it out.

Separators: the Arabic and Latin comma and semicolon, | / • and line breaks
and tabs anywhere, and a dash between blanks. They do not separate within
double, single, angle or curly quotes. A hyphen or apostrophe inside a word
never separates. Brackets around a whole list are dropped.

Defined cases: null, blank and 'None' hold no names; empty names do not
count, repeated ones do; an unclosed quote mark is an ordinary character;
very long fields are read whole; repeated rows give repeated results.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import Scratch

#: JVM-side test for fields that may hold more than one name or need cleaning.
NEEDS_PARSING = r"""[،,;؛|/•\n\r\t\[\{"'«“‘]|\s[-–—]\s"""
#: Change of the expected times of any name, as a part of it, that ends the learning, and rounds after which it ends anyhow.
SETTLED, ROUNDS = 1e-3, 40
#: What a doubtful name counts for besides, and a name the column does not have.
LEAST = 0.5

_SEP = re.compile(r"\s*(?:[،,;؛|/•\n\r\t]|(?<=\s)[-–—](?=\s))\s*")
_END = r"(?=\s*(?:[،,;؛|/•\n\r\t]|\s[-–—]\s|$))"
_QUOTED = re.compile(rf"""(?:"((?:[^"\\]|\\.|"")*)"|'((?:[^']|'(?=\w))*)'|«([^»]*)»|“([^”]*)”|‘([^’]*)’){_END}""", re.S)
_PLAIN = re.compile(r"""(?:(?<!\w)"[^"]*"(?!\w)|«[^»]*»|“[^”]*”|(?!\s[-–—]\s)[^،,;؛|/•\n\r\t])+""", re.S)
_ESCAPE = re.compile(r"\\(.)")


def parse(value: str | None) -> tuple[list[str], list[bool], list[str]]:
    """Atoms, whether each was quoted, and the separators between them."""
    text = (value or "").strip()
    if text in ("", "None"):
        return [], [], []
    if len(text) > 1 and text[0] + text[-1] in ("[]", "{}"):
        if text[:2] in ('["', '[]'):
            try:
                names = [str(x).strip() for x in json.loads(text) if x is not None]
                names = [x for x in names if x]
                return names, [True] * len(names), [","] * max(0, len(names) - 1)
            except ValueError:
                pass
        text = text[1:-1].strip()
    atoms: list[str] = []
    sealed: list[bool] = []
    gaps: list[str] = []
    gap, at, n = "", 0, len(text)
    while at < n:
        if text[at].isspace() and not _SEP.match(text, at):
            at += 1
            continue
        if m := _SEP.match(text, at):
            gap += m.group()
            at = m.end()
            continue
        if m := _QUOTED.match(text, at):
            k = m.lastindex
            name = m.group(k).replace('""', '"') if k == 1 else m.group(k)
            name, quoted = _ESCAPE.sub(r"\1", name) if "\\" in name else name, True
        else:
            m = _PLAIN.match(text, at)
            name, quoted = (m.group(), False) if m else (text[at], False)
        at = m.end() if m else at + 1
        if name := name.strip():
            if atoms:
                gaps.append(gap)
            gap = ""
            atoms.append(name)
            sealed.append(quoted)
    return atoms, sealed, gaps


def runs(atoms: Sequence[str], sealed: Sequence[bool], gaps: Sequence[str], longest: int) -> list[tuple[int, int, str]]:
    """Runs of two to longest unquoted atoms, as they stand: start, number, name."""
    found = []
    for i in range(len(atoms)):
        name = atoms[i]
        for j in range(i + 1, min(len(atoms), i + longest)):
            if sealed[i] or sealed[j] or "\n" in gaps[j - 1] or "\t" in gaps[j - 1]:
                break
            name += gaps[j - 1] + atoms[j]
            found.append((i, j - i + 1, name))
    return found


class Lattice:
    """Ways to read the atoms of a field: edges from atom to atom, each a name with its logarithmic weight."""

    def __init__(self, atoms: Sequence[str], joined: dict[tuple[int, int], str], weight: dict[str, float], total: float):
        self.n = len(atoms)
        cost = lambda name: math.log(max(weight.get(name, 0.0), LEAST) / max(total, 1.0))
        self.into: list[list[tuple[int, str, float]]] = [[] for _ in range(self.n + 1)]
        for j, name in enumerate(atoms):
            self.into[j + 1].append((j, name, cost(name)))
        for (start, size), name in joined.items():
            self.into[start + size].append((start, name, cost(name)))

    def expected(self) -> dict[str, float]:
        """How often each name is expected, over all ways by their weight."""
        if all(len(edges) < 2 for edges in self.into):
            return dict(Counter(edges[0][1] for edges in self.into[1:]))
        forward, backward = [0.0], [-math.inf] * self.n + [0.0]
        for edges in self.into[1:]:
            forward.append(_log_sum([forward[i] + w for i, _, w in edges]))
        for j in range(self.n, 0, -1):
            for i, _, w in self.into[j]:
                backward[i] = _log_sum([backward[i], w + backward[j]])
        out: dict[str, float] = {}
        for j, edges in enumerate(self.into):
            for i, name, w in edges:
                out[name] = out.get(name, 0.0) + math.exp(forward[i] + w + backward[j] - forward[-1])
        return out

    def best(self) -> list[str]:
        """The likeliest way; of two equally likely ones the one of more names at its end."""
        ways: list[tuple[float, int, str]] = [(0.0, 0, "")]
        for edges in self.into[1:]:
            ways.append(max((ways[i][0] + w, i, name) for i, name, w in edges))
        out, j = [], self.n
        while j:
            out.append(ways[j][2])
            j = ways[j][1]
        return out[::-1]


def _log_sum(logs: list[float]) -> float:
    top = max(logs)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in logs))


def _lattices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(key, field, parse(value)) for key, field, value in zip(pdf["_key"], pdf["_field"], pdf["_value"], strict=True)]
        yield pd.DataFrame(
            {
                "_key": [r[0] for r in rows],
                "_field": [r[1] for r in rows],
                "atoms": [r[2][0] for r in rows],
                "sealed": [r[2][1] for r in rows],
                "gaps": [r[2][2] for r in rows],
            }
        )


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """At least as many as the atoms that each name would have without quotes."""
    for pdf in batches:
        yield pd.DataFrame({"n": [len(_SEP.split(x)) for x in pdf["name"]]})


def _open_runs(longest: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = zip(pdf["_row"], pdf["_field"], pdf["atoms"], pdf["sealed"], pdf["gaps"], strict=True)
            found = [(row, field, *r) for row, field, *lattice in rows for r in runs(*lattice, longest)]
            yield pd.DataFrame(found, columns=["_row", "_field", "start", "size", "name"])

    return run


def _of(atoms, joined, weights, total) -> Lattice:
    ways = {(x["start"], x["size"]): x["name"] for x in joined} if joined is not None else {}
    return Lattice(list(atoms), ways, {w["name"]: w["w"] for w in weights} if weights is not None else {}, 1.0 if total is None or total != total else total)


def _expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = zip(pdf["_field"], pdf["atoms"], pdf["joined"], pdf["weights"], pdf["total"], strict=True)
        found = [(field, name, n) for field, *lattice in rows for name, n in _of(*lattice).expected().items()]
        yield pd.DataFrame(found, columns=["_field", "name", "n"])


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = zip(pdf["atoms"], pdf["joined"], pdf["weights"], pdf["total"], strict=True)
        yield pd.DataFrame({"_key": pdf["_key"], "_field": pdf["_field"], "names": [_of(*lattice).best() for lattice in rows]})


def split_fields(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """<key>, field_name, pos, entity, n_names: every name of every field, positions from 1."""
    scratch = Scratch(df.sparkSession, "fields")
    key_type = df.schema[key].dataType.simpleString()
    long = df.select(
        F.col(key).alias("_key"), F.explode(F.array(*[F.struct(F.lit(f).alias("_field"), F.col(f).alias("_value")) for f in fields])).alias("_s")
    ).select("_key", "_s.*")
    trimmed = F.regexp_replace("_value", r"(?U)^\s+|\s+$", "")
    single = long.where(~F.col("_value").rlike(NEEDS_PARSING)).select("_key", "_field", trimmed.alias("name")).where(~F.col("name").isin("", "None"))
    schema = f"_key {key_type}, _field string, atoms array<string>, sealed array<boolean>, gaps array<string>"
    lattices = scratch.write(long.where(F.col("_value").rlike(NEEDS_PARSING)).mapInPandas(_lattices, schema).withColumn("_row", F.monotonically_increasing_id()), "lattices")

    known = _known_runs(scratch, lattices)
    joined = known.groupBy("_row").agg(F.collect_list(F.struct("start", "size", "name")).alias("joined"))
    choice = scratch.write(lattices.select("_row", "_field", "atoms").join(joined, "_row"), "choice")
    weighed = _learn(scratch, lattices, single, choice)
    ready = lattices.select("_row", "_key", "_field", "atoms").join(weighed.select("_row", "joined", "weights", "total"), "_row", "left")
    paths = ready.mapInPandas(_paths, f"_key {key_type}, _field string, names array<string>")
    names = single.select("_key", "_field", F.array("name").alias("names")).unionByName(paths)
    out = names.select("_key", "_field", F.size("names").alias("n_names"), F.posexplode("names").alias("p", "entity"))
    return out.select(F.col("_key").alias(key), F.col("_field").alias("field_name"), (F.col("p") + 1).cast("long").alias("pos"), "entity", "n_names")


def _known_runs(scratch: Scratch, lattices: DataFrame) -> DataFrame:
    """_row, _field, start, size, name: runs of unquoted atoms that the column holds whole elsewhere."""
    whole = lattices.select("_field", F.explode(F.arrays_zip("atoms", "sealed")).alias("a")).where("a.sealed").select("_field", F.col("a.atoms").alias("name"))
    whole = whole.where(F.col("name").rlike(r"[،,;؛|/•]|\s[-–—]\s")).select("_field", "name").distinct()
    whole = scratch.write(whole, "whole")
    longest = whole.mapInPandas(_lengths, "n int").agg(F.max("n")).first()[0] or 1
    schema = "_row bigint, _field string, start int, size int, name string"
    open_runs = lattices.where(F.size("atoms") > 1).mapInPandas(_open_runs(longest), schema)
    return open_runs.join(whole, ["_field", "name"])


def _learn(scratch: Scratch, lattices: DataFrame, single: DataFrame, choice: DataFrame) -> DataFrame:
    """choice with the learned weights of the names of each lattice, and the total of its field."""
    sure = lattices.join(choice.select("_row"), "_row", "left_anti").select("_field", F.explode("atoms").alias("name"))
    # the names in doubt are those of lattices with a choice; of the others only the sum matters
    asked = choice.select("_row", "_field", F.explode(F.array_distinct(F.concat("atoms", F.transform("joined", lambda x: x["name"])))).alias("name"))
    once, nothing = F.lit(1.0).alias("n"), F.lit(None).cast("boolean").alias("doubt")
    said = sure.unionByName(single.select("_field", "name")).select("_field", "name", once, nothing)
    said = said.unionByName(asked.select("_field", "name", F.lit(0.0).alias("n"), F.lit(True).alias("doubt")))
    names = said.groupBy("_field", "name").agg(F.sum("n").alias("n"), F.max("doubt").alias("doubt"))
    names = names.groupBy("_field", F.when(F.col("doubt"), F.col("name")).alias("name")).agg(F.sum("n").alias("n"), F.max("doubt").alias("doubt"))
    names = scratch.write(names, "names")
    rest = names.groupBy("_field").agg(F.sum("n").alias("rest"))
    doubtful = names.where("doubt").select("_field", "name", F.col("n").alias("base"))
    expected = doubtful.select("_field", "name", F.lit(0.0).alias("n"))

    def weigh(expected: DataFrame) -> DataFrame:
        w = doubtful.join(expected, ["_field", "name"], "left").select("_field", "name", (F.col("base") + F.coalesce("n", F.lit(0.0))).alias("w"))
        totals = expected.groupBy("_field").agg(F.sum("n").alias("more")).join(rest, "_field", "full").select("_field", (F.coalesce("more", F.lit(0.0)) + F.coalesce("rest", F.lit(0.0))).alias("total"))
        learned = asked.join(w, ["_field", "name"]).groupBy("_row").agg(F.collect_list(F.struct("name", "w")).alias("weights"))
        return choice.join(learned, "_row").join(F.broadcast(totals), "_field")  # one row a field name

    for _ in range(ROUNDS):
        found = weigh(expected).mapInPandas(_expected, "_field string, name string, n double").groupBy("_field", "name").agg(F.sum("n").alias("n"))
        now = scratch.write(found, "expected")
        change = now.join(expected.withColumnRenamed("n", "before"), ["_field", "name"], "full")
        change = change.agg(F.max(F.abs(F.coalesce("n", F.lit(0.0)) - F.coalesce("before", F.lit(0.0))) / (F.coalesce("n", F.lit(0.0)) + 1))).first()[0]
        scratch.drop(expected)
        expected = now
        if (change or 0.0) < SETTLED:
            break
    return scratch.write(weigh(expected), "weighed")
