"""Hot keys, packed fields and timestamps against brute force, with the defined cases of each."""

import datetime as dt
import math
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tapesh import runtime
from tapesh.operators import split_fields as S
from tapesh.operators import timestamps as T
from tapesh.operators import value_frequency as V

# ---- per-key places


def brute_median(rows):
    groups = {}
    for k, t, i in rows:
        groups.setdefault(k, []).append((t is not None, t or 0, i is not None, i or 0))
    return {k: sorted(v)[(len(v) + 1) // 2 - 1][3] for k, v in groups.items()}


@pytest.mark.parametrize("hot_rows", [1, 50_000])
def test_select_at_matches_brute_force(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([0, 5, -3, 86_400_000_000 * 3 + 7, None, rng.randrange(10**15)]), rng.randrange(1, 1 << 45)) for _ in range(400)]
    rows += [("one", None, 3), ("same", 5, 9), ("same", 5, 9)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "k string, ts bigint, id bigint, _s0 string, _n int")
    out = V.select_at(df, ["k"], {"ts": V.TIME_STEPS, "id": V.ID_STEPS}, V.LOWER_MEDIAN).collect()
    assert {r["k"]: r["id"] for r in out} == brute_median(rows)
    assert len(out) == len({(r["k"]) for r in out})


def test_select_at_of_nothing(spark):
    df = spark.createDataFrame([], "k string, ts bigint, id bigint")
    assert V.select_at(df, ["k"], {"ts": V.TIME_STEPS, "id": V.ID_STEPS}, V.LOWER_MEDIAN).count() == 0


def test_frequencies_modes_and_distinct_counts(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("a", None), ("b", None)], "k string, v int")
    f = V.value_frequencies(df, ["k"], "v")
    assert [tuple(r) for r in V.distinct_counts(f, ["k"]).collect()] == [("a", 4, 2)]
    assert [tuple(r) for r in V.modes(f, ["k"], "v").collect()] == [("a", 1, 2)]
    assert [tuple(r) for r in V.value_stats(f, ["k"], "v").collect()] == [("a", 4, 2, 1, 2)]


# ---- packed fields

FIELDS = [
    ("A، B", ["A", "B"]),
    ('["A","Qal\'eh B"]', ["A", "Qal'eh B"]),
    ('["a \\"b\\" c", "d"]', ['a "b" c', "d"]),
    ('"Hall 3/B"; C', ["Hall 3/B", "C"]),
    ('"The ""Old"" Yard"، «x, y»|“p;q”', ['The "Old" Yard', "x, y", "p;q"]),
    ("'a, b' - c-d", ["a, b", "c-d"]),
    ("[A | B,, ,C]", ["A", "B", "C"]),
    ("کوه و دشت\tVal d'Ostel", ["کوه و دشت", "Val d'Ostel"]),
    ("A\r\nA\n", ["A", "A"]),
    ("  A ;", ["A"]),
    ('a " b, c', ['a " b', "c"]),
    ("[]", []),
    (" ، ", []),
    ("None", []),
    (" ", []),
    (None, []),
    ("", []),
    ('"open, b', ['"open', "b"]),
]


@pytest.mark.parametrize(("value", "names"), FIELDS)
def test_parse_fields(value, names):
    assert S.parse(value)[0] == names


def test_split_fields_numbers_names(spark):
    rows = [(i, v, None, "x") for i, (v, _) in enumerate(FIELDS)] + [(0, "A، B", None, "x")]
    df = spark.createDataFrame(rows, "id int, loc string, ev string, pos string")
    got = {}
    for r in S.split_fields(df, "id", ["loc", "ev"]).collect():
        got.setdefault(r["id"], []).append((r["pos"], r["entity"], r["n_names"]))
    for i, (_, names) in enumerate(FIELDS):
        want = [(k + 1, x, len(names)) for k, x in enumerate(names)]
        assert sorted(set(got.get(i, []))) == sorted(want)
    assert len(got[0]) == 4  # a repeated row
    assert S.split_fields(df.limit(0), "id", ["loc", "ev"]).count() == 0


def test_very_long_field(spark):
    df = spark.createDataFrame([(1, ", ".join(f"n{i}" for i in range(50_000)))], "id int, loc string")
    assert S.split_fields(df, "id", ["loc"]).agg(F.max("pos")).first()[0] == 50_000


def test_learned_frequencies_keep_a_name_whole(spark):
    """'Hall 3/B' is quoted often and its parts never occur: unquoted it is one name. 'A/C' is two, though quoted once."""
    rows = [(i, '"Hall 3/B"، X') for i in range(50)] + [(100 + i, "A، C") for i in range(50)] + [(200, '"A/C"، X'), (300, "Hall 3/B، X"), (301, "A/C، X")]
    df = spark.createDataFrame(rows, "id int, loc string")
    got = {}
    for r in S.split_fields(df, "id", ["loc"]).orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["entity"])
    assert got[300] == ["Hall 3/B", "X"]
    assert got[301] == ["A", "C", "X"]
    assert got[0] == ["Hall 3/B", "X"]


def every_way(atoms, joined):
    """All ways through a lattice."""
    if not atoms:
        return [[]]
    found = [[atoms[0], *rest] for rest in every_way(atoms[1:], {(a - 1, k): n for (a, k), n in joined.items() if a > 0})]
    for (a, k), name in joined.items():
        if a == 0:
            found += [[name, *rest] for rest in every_way(atoms[k:], {(b - k, m): n for (b, m), n in joined.items() if b >= k})]
    return found


def test_expected_times_and_best_ways_are_those_of_all_ways():
    rng = random.Random(5)
    for _ in range(60):
        atoms = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        joined = {(i, k): "/".join(atoms[i : i + k]) for i in range(len(atoms)) for k in (2, 3, 4) if i + k <= len(atoms) and rng.random() < 0.5}
        names = {*atoms, *joined.values()}
        weight, total = {n: rng.random() * 9 for n in names}, 50.0
        lattice = S.Lattice(atoms, joined, weight, total)
        ways = every_way(atoms, joined)
        share = [math.prod(max(weight[n], S.LEAST) / total for n in way) for way in ways]
        want = {}
        for way, p in zip(ways, share, strict=True):
            for n in way:
                want[n] = want.get(n, 0.0) + p / sum(share)
        assert lattice.expected() == pytest.approx(want)
        assert max(zip(share, ways))[0] == pytest.approx(math.prod(max(weight[n], S.LEAST) / total for n in lattice.best()))


def test_long_runs_curly_quotes_and_repeated_keys(spark):
    """No run is too long, and rows of one key do not mix."""
    rows = [(i, '"A/B/C/D"') for i in range(60)] + [(100, "A/B/C/D، X"), (100, "A/B/C/D، X"), (100, "Y، A/B"), (200, "‘Berlin’"), (201, "‘a, b’، c")]
    df = spark.createDataFrame(rows, "id int, loc string")
    got = sorted((r["id"], r["pos"], r["entity"]) for r in S.split_fields(df, "id", ["loc"]).where("id >= 100").collect())
    assert got == sorted([(100, 1, "A/B/C/D"), (100, 2, "X")] * 2 + [(100, 1, "Y"), (100, 2, "A"), (100, 3, "B"), (200, 1, "Berlin"), (201, 1, "a, b"), (201, 2, "c")])


# ---- timestamps


def us(*a, zone="UTC"):
    return int(dt.datetime(*a, tzinfo=ZoneInfo(zone)).timestamp()) * 10**6


TIMES = [
    ("2023-03-29 20:26:27", us(2023, 3, 29, 20, 26, 27, zone="Asia/Tehran")),
    ("2021-07-29T20:26:27.1234567", us(2021, 7, 29, 20, 26, 27, zone="Asia/Tehran") + 123456),
    ("1402/02/03 10:05", us(2023, 4, 23, 10, 5, zone="Asia/Tehran")),
    ("۱۴۰۲/۲/۳", us(2023, 4, 23, zone="Asia/Tehran")),
    ("٣ خرداد ١٤٠١ - ١٥:٥٧", us(2022, 5, 24, 15, 57, zone="Asia/Tehran")),
    ("3 خرداد 1401 ساعت 15:57:01", us(2022, 5, 24, 15, 57, 1, zone="Asia/Tehran")),
    ("04/02/2023 03:48", us(2023, 2, 4, 3, 48, zone="Asia/Tehran")),
    ("4.2.2023 3:48 PM", us(2023, 2, 4, 15, 48, zone="Asia/Tehran")),
    ("10/11/2023 12:08 am", us(2023, 11, 10, 0, 8, zone="Asia/Tehran")),
    ("08-Mar-2024 13:57", us(2024, 3, 8, 13, 57, zone="Asia/Tehran")),
    ("Mar 8, 2024 13:57", us(2024, 3, 8, 13, 57, zone="Asia/Tehran")),
    ("8 Mar 2024, 13:57", us(2024, 3, 8, 13, 57, zone="Asia/Tehran")),
    ("Sat, 04 Mar 2023 05:06:20 +0330", us(2023, 3, 4, 1, 36, 20)),
    ("2023-03-04T05:06:20-03:30", us(2023, 3, 4, 8, 36, 20)),
    ("2023-03-04 05:06:20 +10", us(2023, 3, 3, 19, 6, 20)),
    ("2023-03-04 05:06:20z", us(2023, 3, 4, 5, 6, 20)),
    ("2023-03-04 05:06:20 GMT", us(2023, 3, 4, 5, 6, 20)),
    ("2022-05-11T10:20:28[Europe/Berlin]", us(2022, 5, 11, 8, 20, 28)),
    ("2022-05-11 10:20:28 America/New_York", us(2022, 5, 11, 14, 20, 28)),
    ("20211210T224851Z", us(2021, 12, 10, 22, 48, 51)),
    ("20230626184428", us(2023, 6, 26, 18, 44, 28, zone="Asia/Tehran")),
    ("14021203", us(2024, 2, 22, zone="Asia/Tehran")),
    ("1636297828", 1636297828 * 10**6),
    ("1655212082.420", 1655212082420000),
    ("1708212586859", 1708212586859000),
    ("1710924878107903", 1710924878107903),
    ("1710924878107903123", 1710924878107903),
    (" 1402-03-22\x00\x00", us(2023, 6, 12, zone="Asia/Tehran")),
    ("\t2022-05-11 \n", us(2022, 5, 11, zone="Asia/Tehran")),
    ("2021-03-22 00:30:00", us(2021, 3, 21, 21, 0)),  # skipped by the clocks of Tehran: the offset before
    ("2021-09-21 23:30:00", us(2021, 9, 21, 19, 0)),  # occurs twice: the first
    ("1401/12/30 08:00", None),
    ("1402/13/05 10:00", None),
    ("2023-02-30 10:15:00", None),
    ("2021-06-15 27:10:00", None),
    ("2021-06-15 10:60", None),
    ("0000-00-00 00:00:00", None),
    ("25:61", None),
    ("n/a", None),
    ("-", None),
    ("", None),
    (None, None),
    ("2022-05-11 10:20:28 Mars/Base", None),
    ("20231399", None),
    ("3 خرداد 2022", None),
    ("1" * 5000, None),
    ("2021-07-29T20:26:27.123456" + "7" * 70, us(2021, 7, 29, 20, 26, 27, zone="Asia/Tehran") + 123456),
    ("2021-07-29" + " " * 3000 + "20:26:27.123456" + "7" * 5000 + " +0330", us(2021, 7, 29, 16, 56, 27) + 123456),
    ("1655212082." + "4" * 90, 1655212082444444),
    ("0" * 30 + "1636297828", 1636297828 * 10**6),
]


def test_timestamps(spark):
    df = spark.createDataFrame([(i, t, "Asia/Tehran", "dmy", "kept", 5) for i, (t, _) in enumerate(TIMES)], "i int, t string, z string, o string, _v string, _day int")
    out = T.to_utc_micros(df, "t", "z", "o").collect()
    assert out[0].asDict().keys() == {"i", "t", "z", "o", "_v", "_day", "utc_us"}
    assert all(r["_v"] == "kept" and r["_day"] == 5 for r in out)
    assert {r["t"]: r["utc_us"] for r in out} == dict(TIMES)


def test_timestamp_order_and_missing_zone(spark):
    df = spark.createDataFrame([("04/02/2023 03:48", None, "mdy"), ("04/02/2023 03:48", "UTC", None), ("15/02/2023", "UTC", "mdy")], "t string, z string, o string")
    got = [r["utc_us"] for r in T.to_utc_micros(df, "t", "z", "o").collect()]
    assert got == [us(2023, 4, 2, 3, 48), us(2023, 2, 4, 3, 48), None]
    assert T.to_utc_micros(df.limit(0), "t", "z", "o").count() == 0


def test_zone_rules_agree_with_zoneinfo(spark):
    rng = random.Random(3)
    zones = ["Asia/Tehran", "Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kabul"]
    rows = []
    for _ in range(300):
        at = dt.datetime(2019, 1, 1) + dt.timedelta(minutes=rng.randrange(6 * 365 * 1440))
        rows.append((at.strftime("%Y-%m-%d %H:%M"), z := rng.choice(zones), int(at.replace(tzinfo=ZoneInfo(z)).timestamp()) * 10**6))
    df = spark.createDataFrame(rows, "t string, z string, want bigint")
    assert T.to_utc_micros(df, "t", "z", None).where("utc_us <> want or utc_us is null").count() == 0


def test_a_name_of_many_atoms_is_kept_whole(spark):
    name = "Hall 3/B, Gate 4, North - East, Block 7"
    rows = [(i, f'"{name}"، X') for i in range(50)] + [(300, f"{name}، X"), (301, f"X, {name}")]
    df = spark.createDataFrame(rows, "id int, loc string")
    got = {}
    for r in S.split_fields(df, "id", ["loc"]).orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["entity"])
    assert got[0] == got[300] == [name, "X"] and got[301] == ["X", name]
