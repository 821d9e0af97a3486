"""Golden rows of text, calendar and grammar."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapesh.functions import jalali as J
from tapesh.functions import temporal
from tapesh.functions import text as T
from tapesh.functions import vectors as V


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.clean_text, "سلام https://x.y/z @u #t 😀 خبر", "سلام خبر"),
        (T.clean_text, "👨‍👩‍👧 ok", "ok"),
        (T.clean_text, None, ""),
        (T.normalize_text, "علي كتاب! a_b", "علی کتاب a_b"),
        (T.clean_message, "t.me/abc خبر @u_1 مهم 😀", "خبر مهم"),
        (T.digits_to_ascii, "۱۲٣", "123"),
        (T.entity_set, "تهران، قم , تهران", ["تهران", "قم"]),
        (T.entity_set, None, []),
        (T.entity_set, " ", []),
        (T.entity_set, "None", []),
        (T.entity_set, "،", []),
        (T.strip, "  a\t", "a"),
    ],
)
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want


def test_word_chunks(spark):
    got = one(spark, " ".join(["w"] * 450), T.word_chunks)
    assert [len(x.split()) for x in got] == [200, 200, 50]
    assert one(spark, "  ", T.word_chunks) == [" "] == one(spark, None, T.word_chunks)


def test_terms(spark):
    words = lambda c: T.terms(T.tokens(T.normalize_text(c)))
    assert one(spark, "خبر مهم", words) == ["خبر", "مهم", "خبر مهم"]
    assert one(spark, "و از", words) == []


def test_rendering(spark):
    kind = "array<string>"
    assert one(spark, ["a", "b"], T.numbered, kind) == "[1] a\n[2] b"
    assert one(spark, [str(i) for i in range(12)], T.joined_with_note, kind).endswith("9 | ... (2 more message(s))")
    assert one(spark, ["سلام", "b"], T.sample_json, kind) == '{"messages":["سلام","b"]}'


@pytest.mark.parametrize(
    ("reply", "parsed", "event", "title"),
    [
        ('"is_event": true, "title": "t"}', True, True, "t"),
        ('{"is_event": false} trailing', True, False, "No title"),
        ("nothing", False, False, None),
        ("", False, False, None),
        ('{"is_event": "x', False, False, None),
    ],
)
def test_reply(spark, reply, parsed, event, title):
    r = one(spark, reply, T.parse_reply)
    assert (r["parsed"], r["is_event"], r["title"]) == (parsed, event, title)


CALENDAR = [("1404/01/01", "2025-03-21"), ("1403/12/30", "2025-03-20"), ("1404/06/01", "2025-08-23"), ("1348/10/11", "1970-01-01")]


def test_calendar(spark):
    for jalali, gregorian in CALENDAR:
        assert one(spark, gregorian, lambda c: J.format_jalali(J.to_jalali(c.cast("date")))) == jalali
        assert str(one(spark, jalali, J.parse_jalali)) == gregorian
    assert one(spark, "1404/12/30", J.parse_jalali) is None
    assert one(spark, "abc", J.parse_jalali) is None


def test_calendar_round_trip(spark):
    days = spark.range(-14000, 45000).select(F.col("id").cast("int").alias("n"))
    j = J.to_jalali(F.date_add(F.lit("1970-01-01").cast("date"), F.col("n")))
    back = days.select("n", J.jalali_to_epoch_day(j["y"], j["m"], j["d"]).alias("m"), J.valid_jalali(j["y"], j["m"], j["d"]).alias("ok"))
    assert back.where("n <> m or not ok").count() == 0
    assert all(J.day_of(*J.date_of(n)) == n for n in range(-14000, 45000, 7))


def test_gregorian_days(spark):
    days = spark.range(-140000, 45000, 11).select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id").cast("int").alias("n"))
    got = days.where(J.gregorian_to_epoch_day(F.year("d"), F.month("d"), F.day("d")) != F.col("n"))
    assert got.count() == 0


@pytest.mark.parametrize(("start", "n", "want"), [("1404/06/31", 1, "1404/07/30"), ("1403/12/30", 12, "1404/12/29"), ("1404/01/05", -1, "1403/12/05")])
def test_add_months(spark, start, n, want):
    assert one(spark, start, lambda c: J.format_jalali(J.add_months(J.to_jalali(J.parse_jalali(c)), F.lit(n)))) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (None, "1970-01-01 00:00:00"), ("", "1970-01-01 00:00:00"), ("1404/06/01", "2025-08-23 00:00:00"), ("1404-06-01 10:00:00", "2025-08-23 00:00:00"),
        ("1404/13/01", "1970-01-01 00:00:00"), ("2025-08-23 10:00:00", "2025-08-23 10:00:00"), ("abc", "1970-01-01 00:00:00"),
    ],
)
def test_standard_time(spark, value, want):
    assert str(one(spark, value, J.standard_time)) == want


GRAMMAR = [
    ("1404/06/15", "1404/06/15"), ("04/06/15", "1404/06/15"), ("1404.06.15", None), ("15/06", "1404/06/15"), ("6/15", None), ("۲۵ شهریور", "1404/06/25"),
    ("دوم مهر", "1404/07/02"), ("31 مهر", None), ("25 فروردین", None), ("اواخر شهریور", "1404/06/25"), ("فردا", "1404/06/02"), ("پس فردا", "1404/06/03"),
    ("امروز", None), ("آخر هفته", "1404/06/07"), ("پنجشنبه", "1404/06/06"), ("شنبه آینده", "1404/06/08"), ("جمعه هفته آینده", "1404/06/14"),
    ("3 روز دیگر", "1404/06/04"), ("ده روز دیگر", "1404/06/11"), ("دو هفته بعد", "1404/06/15"), ("یک ماه دیگر", "1404/07/01"), ("یک سال و نیم بعد", "1405/12/01"),
    ("روزهای آینده", "1404/06/03"), ("هفته آینده", "1404/06/08"), ("5 روز پیش", None), ("کتاب 25 شهریور", None), ("", None),
]


def test_grammar(spark):
    df = spark.createDataFrame([(t, dt.date(2025, 8, 23)) for t, _ in GRAMMAR] + [(None, dt.date(2025, 8, 23)), ("فردا", None)], "t string, d date")
    got = {r["t"]: r["future_date"] for r in temporal.future_dates(df, "t", "d").collect()}
    assert got == {t: w for t, w in GRAMMAR if w}


def test_grammar_compat_and_spans():
    day = J.day_of(1404, 6, 1)
    assert temporal.find_day("پنج‌شنبه", day, compat=True) == (day, "bare_weekday")
    assert temporal.find_day("پنج‌شنبه", day) == (day + 5, "bare_weekday")
    assert temporal.merge_spans([(0, 4), (8, 10), (20, 22)]) == [(0, 10), (20, 22)]
    text = "فردا یا 1404/07/01"
    assert temporal.find_day(text, day, spans=lambda t: [(0, 4)]) == (J.day_of(1404, 7, 1), "exact_full")
    assert temporal.find_day("سلام " * 100_000 + "فردا", day) == (day + 1, "relative_word")


def test_vectors(spark):
    df = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("a", 2, [0.0, 2.0]), ("a", 3, [0.0, 0.0])], "k string, i bigint, v array<float>")
    assert df.select(V.cosine(F.col("v"), F.lit([1.0, 1.0])).alias("c")).toPandas().c.round(4).tolist() == [0.7071, 0.7071, 0.0]
    assert [round(x, 4) for x in V.centroids(df, ["k"], "v").first()["centroid"]] == [0.3333, 0.6667]
    assert V.medoids(df, ["k"], "i", "v").first()["i"] == 1
    assert df.select(V.or_zeros(F.lit(None).cast("array<float>"), 2).alias("z")).first()["z"] == [0.0, 0.0]
