"""Model calls as Arrow UDFs, with deterministic defaults where no model is given.

A model is a callable made once per Python worker by a factory, so weights
are loaded once, and called with a list of texts. Null texts are handed on as
''. No default claims the quality of a trained model.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import text as T
from tapesh.runtime import worked_out


def _batches(texts: list[str], size: int) -> Iterator[list[str]]:
    for at in range(0, len(texts), size):
        yield texts[at : at + size]


# ---- classifier


def rule_classifier(words: int = 3) -> Callable[[Column], Column]:
    """Class 1 for cleaned texts of at least so many words, in column arithmetic."""
    return lambda clean: F.when(F.size(F.filter(F.split(clean, " "), lambda x: x.rlike(r"[\p{L}\p{N}]"))) >= words, 1).otherwise(0)


def model_classifier(factory: Callable[[], Callable[[list[str]], list[int]]], batch: int = 128) -> Callable[[Column], Column]:
    @F.pandas_udf("int")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in series:
            yield pd.Series([y for b in _batches([t or "" for t in s], batch) for y in model(b)], dtype="Int32")

    return run


def classify(df: DataFrame, text: str, classifier: Callable[[Column], Column]) -> DataFrame:
    """df with clean_text, predicted_class and passed_filter: class 1 and more than two characters."""
    out = worked_out(df.withColumn("clean_text", T.clean_text(F.col(text))), "clean_text")
    out = out.withColumn("predicted_class", classifier(F.col("clean_text")))
    return out.withColumn("passed_filter", (F.col("predicted_class") == 1) & (F.length("clean_text") > 2))


# ---- embedder


def hashing_embedder(dim: int = 64) -> Callable[[Column], Column]:
    """Signed hashed bags of words and letter triples, of length 1."""

    def factory() -> Callable[[list[str]], list[list[float]]]:
        known: dict[str, np.ndarray] = {}

        def of_word(w: str) -> np.ndarray:
            v = np.zeros(dim, dtype=np.float32)
            for g in [w, *(f"_{w}_"[i : i + 3] for i in range(len(w)))]:
                h = crc32(g.encode("utf-8", "surrogatepass"))
                v[h % dim] += 1.0 if h >> 16 & 1 else -1.0
            if len(known) < 200_000:
                known[w] = v
            return v

        def one(text: str) -> list[float]:
            words = text.lower().split()
            if not words:
                return [0.0] * dim
            v = np.add.reduce([known[w] if w in known else of_word(w) for w in words])
            n = float(np.sqrt((v * v).sum()))
            return (v / n if n else v).tolist()

        return lambda texts: [one(t) for t in texts]

    return model_embedder(factory)


def model_embedder(factory: Callable[[], Callable[[list[str]], list[list[float]]]], batch: int = 128, dim: int | None = None) -> Callable[[Column], Column]:
    """Embeddings by batches; with dim, a batch that fails is filled with zeros."""

    @F.pandas_udf("array<float>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in series:
            out: list = []
            for b in _batches([t or "" for t in s], batch):
                try:
                    out += model(b)
                except Exception:
                    if dim is None:
                        raise
                    out += [[0.0] * dim] * len(b)
            yield pd.Series(out, dtype=object)

    return run


# ---- entities

ENTITIES = "struct<locations:array<string>,events:array<string>>"


def gazetteer(locations: list[str], events: list[str]) -> Callable[[Column], Column]:
    """Names of two lists that occur in a text as whole words."""
    return model_extractor(lambda: _gazetteer(locations, events))


def _gazetteer(locations: list[str], events: list[str]) -> Callable[[list[str]], list[list[tuple[str, str]]]]:
    kinds = {n: "LOC" for n in locations} | {n: "EVE" for n in events}
    if not kinds:
        return lambda texts: [[] for _ in texts]
    find = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(kinds, key=len, reverse=True))) + r")(?!\w)").findall
    return lambda texts: [[(kinds[x], x) for x in find(t)] for t in texts]


def model_extractor(factory: Callable[[], Callable[[list[str]], list[list[tuple[str, str]]]]], batch: int = 64, chunk_words: int = 200) -> Callable[[Column], Column]:
    """struct<locations, events>: grouped (label, name) of a text's pieces; a label with 'loc' or 'eve' in it counts."""

    @F.pandas_udf(ENTITIES)
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for s in series:
            owner, chunks = [], []
            for k, t in enumerate(s):
                words = (t or "").split() or [" "]
                for at in range(0, len(words), chunk_words):
                    owner.append(k)
                    chunks.append(" ".join(words[at : at + chunk_words]))
            found: list[tuple[set, set]] = [(set(), set()) for _ in s]
            at = 0
            for b in _batches(chunks, batch):
                for entities in model(b):
                    for label, name in entities:
                        for kind, mine in zip(("loc", "eve"), found[owner[at]], strict=True):
                            if kind in label.lower() and name.strip():
                                mine.add(name.strip())
                    at += 1
            yield pd.DataFrame({"locations": [sorted(a) for a, _ in found], "events": [sorted(b) for _, b in found]})

    return run


def extract_entities(df: DataFrame, text: str, extractor: Callable[[Column], Column], keep_both: bool = False) -> DataFrame:
    """df with location_entities and event_entities; keep_both keeps rows that have both."""
    out = df.withColumn("_e", extractor(F.col(text)))
    out = out.withColumns({"location_entities": T.join_entities(F.col("_e.locations")), "event_entities": T.join_entities(F.col("_e.events"))}).drop("_e")
    return out.where(F.col("location_entities").isNotNull() & F.col("event_entities").isNotNull()) if keep_both else out


# ---- verifier


class OutOfMemory(Exception):
    """A generator that ran out of memory raises this."""


def count_tokens(text: str) -> int:
    return len(text.split())


def cut_tokens(text: str, most: int) -> str:
    words = text.split()
    return text if len(words) <= most else " ".join(words[:most])


def build_prompt(messages: list[str], cfg: EngineConfig, instruction: str = "", tokens: Callable[[str], int] = count_tokens) -> str:
    """The numbered messages within the token budget: whole, then each cut ever shorter, then fewer of them."""
    render = lambda m: instruction + "\n".join(f"[{i}] {x}" for i, x in enumerate(m, 1))
    for cap in (None, *cfg.token_caps):
        cut = messages if cap is None else [cut_tokens(m, cap) for m in messages]
        if tokens(render(cut)) <= cfg.max_input_tokens:
            return render(cut)
    cut = [cut_tokens(m, 200) for m in messages]
    while len(cut) > 1 and tokens(render(cut)) > cfg.max_input_tokens:
        cut.pop()
    return render(cut)


def next_cap(cap: int | None, caps: tuple[int, ...], step: int = 50, least: int = 20) -> int | None:
    """The token cap after one that did not fit; null once there is no lower one."""
    lower = [c for c in caps if cap is None or c < cap]
    if lower:
        return lower[0]
    return max(cap - step, least) if cap and cap > least else None


def rule_generator(least: int = 3) -> Callable[[], Callable[[str], str]]:
    """Accepts prompts of at least so many messages; the title is the first message's start."""

    def reply(prompt: str) -> str:
        lines = [x for x in prompt.split("\n") if x.startswith("[")]
        title = " ".join(lines[0].split()[1:8]).replace('"', "'").replace("\\", " ") if lines else ""
        yes = "true" if len(lines) >= least else "false"
        return f'"is_event": {yes}, "title": "{title}", "summary": "{len(lines)} messages"}}'

    return lambda: reply


def verify(df: DataFrame, key: str, messages: str, cfg: EngineConfig, factory: Callable[[], Callable[[str], str]] | None = None, instruction: str = "") -> DataFrame:
    """df's key with raw, used_token_cap, attempts, oom_count and the parsed reply of each candidate with messages.

    A sample of the messages, fixed by the seed and the key, is cleaned,
    rendered within the budget and sent; a reply that cannot be read is asked
    for again, a lack of memory cuts the messages shorter, or drops the
    longest where that changes nothing. Candidates are independent, so they
    run in parallel; abort_run() gives the sequential reading.
    """
    import json

    factory = factory or rule_generator()
    kind = df.schema[key].dataType.simpleString()

    def readable(reply: str) -> bool:
        opened = reply if reply.strip().startswith("{") else "{" + reply
        body = re.search(r"\{.*\}", opened, re.S)
        try:
            return isinstance(json.loads(body.group()), dict) if body else False
        except ValueError:
            return False

    def one(generate: Callable[[str], str], k: object, texts: list[str]) -> tuple:
        if len(texts) > cfg.verifier_sample:
            drawn = random.Random(f"{cfg.seed}-{k}").sample(range(len(texts)), cfg.verifier_sample)
            texts = [texts[i] for i in sorted(drawn)]
        cap, ooms, raw = None, 0, None
        for attempt in range(1, cfg.max_attempts + 1):
            sent = texts if cap is None else [cut_tokens(t, cap) for t in texts]
            try:
                raw = generate(build_prompt(sent, cfg, instruction))
            except OutOfMemory:
                ooms += 1
                lower = next_cap(cap, cfg.oom_caps)
                if lower is None or [cut_tokens(t, lower) for t in texts] == sent:
                    if len(texts) > 1:
                        texts = [t for i, t in enumerate(texts) if i != max(range(len(texts)), key=lambda j: len(texts[j]))]
                cap = lower if lower is not None else cap
                continue
            if readable(raw):
                return raw, cap, attempt, ooms
        return None, cap, cfg.max_attempts, ooms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = factory()
        for pdf in batches:
            rows = [one(generate, k, [m for m in ms if m]) for k, ms in zip(pdf["k"], pdf["m"], strict=True)]
            out = pd.DataFrame(rows, columns=["raw", "used_token_cap", "attempts", "oom_count"])
            yield out.assign(k=pdf["k"].to_numpy(), used_token_cap=out["used_token_cap"].astype("Int32"))[["k", "raw", "used_token_cap", "attempts", "oom_count"]]

    asked = df.where(F.size(messages) > 0).select(F.col(key).alias("k"), F.transform(messages, T.clean_message).alias("m"))
    out = asked.mapInPandas(run, f"k {kind}, raw string, used_token_cap int, attempts int, oom_count int")
    return out.withColumn("reply", T.parse_reply(F.coalesce("raw", F.lit("")))).select(F.col("k").alias(key), "raw", "used_token_cap", "attempts", "oom_count", "reply.*")


def abort_run(replies: DataFrame, day: str, order: str, after: int) -> DataFrame:
    """Replies before a run of so many unreadable ones in a row ends the day, in the given order."""
    from pyspark.sql import Window

    w = Window.partitionBy(day).orderBy(order)
    failed = F.when(F.col("parsed"), 0).otherwise(1)
    last = F.sum(failed).over(w.rowsBetween(-after + 1, 0))
    ended = F.max(F.when((last == after), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return replies.withColumn("_end", F.coalesce(ended, F.lit(0))).where(F.col("_end") == 0).drop("_end")
