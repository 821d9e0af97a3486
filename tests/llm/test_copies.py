import time

import pytest
from pyspark.sql import functions as F

from tapesh import runtime
from tapesh.llm import copies as C

TEXTS = [
    (1, "Title: Book Swap | From: A | To: B | Time: 17:30"),
    (2, "to:  b\nTIME: 17:30\nfrom: a\ntitle: book swap !"),
    (3, "Title: Book Swap | From: B | To: A | Time: 17:30"),
    (4, "Hello, world. Good news"),
    (5, "hello \t world\n«good» NEWS!"),
    (6, "Good news. Hello, world"),
    (7, "می\u200cشود"),
    (8, "میشود"),
    (9, "..."),
    (10, "!!!"),
    (11, ""),
    (12, None),
    (13, "STRASSE kısa"),
    (14, "Straße KISA"),
    (15, "\ufb01ne"),
    (16, "fine"),
    (17, "same"),
    (18, "same"),
    (18, "same"),
    (None, "same"),
    (19, "a b"),
    (20, "a\u00a0b"),
    (21, "x" * 200_000),
    (22, ("x" * 100_000) + " " + "X" * 100_000),
    (23, "A: 1; A: 1; B: 2"),
    (24, "A: 1; B: 2; B: 2"),
    (25, "B: 2 | A: 1\nA: 1"),
]
WANT = [(1, 2), (4, 5), (13, 14), (17, 18), (21, 22), (23, 25)]


@pytest.mark.parametrize("hot_rows", [1, 50_000])
def test_copies(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    df = spark.createDataFrame([(*r, "x", 0) for r in TEXTS], "post_id bigint, t string, f1 string, id int")
    assert sorted(tuple(r) for r in C.copies(df, "post_id", "t").collect()) == WANT
    assert C.copies(df.limit(0), "post_id", "t").count() == 0
    assert {tuple(r) for r in C.collapse(df, "post_id", "t").collect()} == {(a, 2) for a, _ in WANT}


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(C, "fingerprint", lambda f: [F.lit(1).cast("long").alias("f1"), F.lit(2).cast("long").alias("f2")])
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A!"), (4, "B?"), (5, "b")], "post_id bigint, t string")
    assert sorted(tuple(r) for r in C.copies(df, "post_id", "t").collect()) == [(1, 3), (2, 4), (2, 5)]


def test_multisets(spark):
    rows = [(1, ["a", "b", "b"], ["b", "a", "b"]), (2, ["a", "a", "b"], ["a", "b", "b"]), (3, ["a"], ["a", "a"]), (4, ["a", "b"], ["b", "a"]), (5, ["a", "b"], ["c", "a"])]
    df = spark.createDataFrame(rows, "i int, a array<string>, b array<string>")
    assert [r[0] for r in df.orderBy("i").select(C.same_fields(F.col("a"), F.col("b"))).collect()] == [None, None, False, True, False]
    assert {r["i"]: r["same"] for r in C.same_counts(df, ["i"], "a", "b").collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    prints = df.orderBy("i").select(*C.fingerprint(F.col("a"))).collect(), df.orderBy("i").select(*C.fingerprint(F.col("b"))).collect()
    assert [a == b for a, b in zip(*prints, strict=True)] == [True, False, False, True, False]


def test_many_fields_are_compared_in_linear_time(spark):
    fields = [f"k{i}: v{i}" for i in range(100_000)]
    rows = [(1, "\n".join(fields)), (2, "\n".join(reversed(fields))), (3, "\n".join(fields[:-1]) + "\nk: v"), (4, "; ".join(fields + fields)), (5, "; ".join(fields[::-1] * 2))]
    df = spark.createDataFrame(rows, "post_id bigint, t string")
    start = time.time()
    assert sorted(map(tuple, C.copies(df, "post_id", "t").collect())) == [(1, 2), (4, 5)]
    assert time.time() - start < 40


def test_an_id_with_several_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c d"), (2, "A. B"), (3, "C, D"), (3, "e")], "post_id bigint, t string")
    assert sorted(map(tuple, C.copies(df, "post_id", "t").collect())) == [(1, 2), (1, 3)]


def test_every_message_is_collapsed_once(spark):
    df = spark.createDataFrame(TEXTS, "post_id bigint, t string")
    got = C.collapsed(df, "post_id", "t").collect()
    often = {a: 2 for a, _ in WANT}
    want = [(i, often.get(i, 1)) for i in {r[0] for r in TEXTS} - {b for _, b in WANT} - {None}] + [(None, 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_labels_of_any_length_with_digits_and_brackets(spark):
    long = "The place where all of us will meet before the march " * 2
    rows = [
        (1, "Phase 2: start | Time (UTC): 17:30"), (2, "time (utc): 17:30\nphase 2: START"),
        (3, f"{long}: here | And/or [3rd]: x"), (4, f"and/or [3rd]: X; {long}: here"),
        (5, "2nd: a | 1: b"), (6, "1: b | 2nd: a"), (7, "17:30 | 18:30"), (8, "18:30 | 17:30"),
        (9, ("y" * 100_000) + " | a: b"), (10, "a: b | " + ("y" * 100_000)),
    ]
    df = spark.createDataFrame(rows, "post_id bigint, t string")
    assert sorted(map(tuple, C.copies(df, "post_id", "t").collect())) == [(1, 2), (3, 4)]
