"""Statistics, rules, tiers and medoids on golden rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.operators import candidates as C
from tapesh.operators import keycluster as K

CFG = EngineConfig()


@pytest.mark.parametrize(("hours", "z", "peak"), [([2], 0, 2), ([3], 1.7975, 3), ([4], 2.1305, 4), ([5], 2.3969, 5), ([10], 3.1963, 10), ([100], 4.5673, 100), ([6, 2, 1, 1], 2.4754, 6)])
def test_hourly_spike(spark, hours, z, peak):
    rows = [("k", dt.datetime(2024, 1, 1, h, m % 60)) for h, n in enumerate(hours) for m in range(n)]
    r = C.hourly_spike(spark.createDataFrame(rows, "k string, ts timestamp_ntz"), ["k"], "ts", CFG).first()
    assert (round(r["z_score"], 4), r["peak"]) == (z, peak)
    assert (r["z_score"] >= CFG.spike_z) == (hours in ([5], [10], [100], [6, 2, 1, 1]))


def test_fence(spark):
    df = spark.createDataFrame([("a", n) for n in (2, 2, 3, 20)] + [("b", 9)], "day string, n int")
    got = {r["day"]: r["fence"] for r in C.iqr_fence(df).collect()}
    assert got == {"a": 15.125, "b": math.inf}


def test_rules(spark):
    cols = "n int, fence double, z_score double, ratio double, median_sim double, coverage double"
    df = spark.createDataFrame([(20, 15.0, 0.0, 0.7, 0.0, 0.0), (20, 15.0, 0.0, 0.8, 0.0, 0.0), (2, 15.0, 2.2, 6.0, 0.8, 0.6), (2, 15.0, 2.1, 6.0, 0.7, 0.6)], cols)
    assert [r["reasons"] for r in C.apply_rules(df, CFG).collect()] == [["dominant"], ["spike", "cohesive"]]


def test_representatives(spark):
    rows = [("d", 1, i, 1 - i / 100) for i in range(35)] + [("d", 2, i, i / 100) for i in range(100, 136)]
    df = spark.createDataFrame(rows, "day string, cluster bigint, msg_id bigint, sim double")
    got = C.representatives(df, CFG).orderBy("cluster", "rank").collect()
    assert [r["msg_id"] for r in got if r["cluster"] == 1] == list(range(35))
    assert [r["msg_id"] for r in got if r["cluster"] == 2] == list(range(135, 100, -1))


def test_terms(spark):
    df = spark.createDataFrame([("c", "خبر مهم"), ("c", "خبر مهم"), ("c", None)], "k string, t string")
    assert {(r["term"], r["freq"]) for r in C.term_counts(df, ["k"], "t").collect()} == {("خبر", 2), ("مهم", 2), ("خبر مهم", 2)}


TIERS = [
    (0, "L1", "E1", "Cluster_1_14040610_LocEvent"), (1, "L1, L2", "E1", "Cluster_1_14040610_LocEvent"), (2, "L2", "E1", "Cluster_1_14040610_LocEvent"),
    (3, "L3", "E2", "Cluster_2_14040610_Loc"), (4, "L3", None, "Cluster_2_14040610_Loc"), (5, None, "E3", "Cluster_3_14040610_Event"),
    (6, "L9", "E3", "Cluster_3_14040610_Event"), (7, "L8", "E8", "Cluster_4_14040610_LocEvent_Solo"), (8, "L1", None, "Cluster_5_14040610_Loc_Solo"), (9, None, " ", None),
]


def test_tiers(spark):
    rows = [(i, "1404/06/10", a, b) for i, a, b, _ in TIERS] + [(20, None, "L1", "E1"), (21, "None", "L1", "E1"), (22, "1404/06/09", "L1", "E1")]
    df = spark.createDataFrame(rows, "row_id bigint, future_date string, location_entities string, event_entities string")
    got = {r["row_id"]: r["cluster_id"] for r in K.cluster_posts(df, "row_id").collect()}
    assert got[22] == "Cluster_1_14040609_LocEvent_Solo"
    later = {i: c and c.replace("Cluster_", "").split("_", 1) for i, _, _, c in TIERS}
    assert {i: got[i] and got[i].replace("Cluster_", "").split("_", 1) for i in later} == {i: c and [str(int(c[0]) + 1), c[1]] for i, c in later.items()}
    assert got[20] is None and got[21] is None
    assert K.cluster_posts(df.limit(0), "row_id").count() == 0


def angle(a):
    return [math.cos(math.radians(a)), math.sin(math.radians(a))]


def test_medoid_clean_up(spark):
    rows = [(i, "c", "d", angle(a)) for i, a in enumerate((0, 5, 20, 30, 95))] + [(9, "s", "d", angle(10)), (10, None, "d", angle(1))]
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id string, future_date string, vec array<float>")
    got = {r["row_id"]: r["cluster_id"] for r in K.denoise(df, CFG).collect()}
    assert got == {0: "c", 1: "c", 3: "c", 4: None, 9: "s", 10: None}


@pytest.mark.parametrize(("a", "b", "dates", "merged"), [(30, 60, ("x", "x"), True), (30, 60, ("x", "y"), False), (30, 75, ("x", "x"), False)])
def test_medoid_merge(spark, a, b, dates, merged):
    df = spark.createDataFrame([(1, "c1", dates[0], angle(a)), (2, "c2", dates[1], angle(b))], "row_id bigint, cluster_id string, future_date string, vec array<float>")
    got = {r["row_id"]: r["cluster_id"] for r in K.merge_by_medoid(df, CFG).collect()}
    assert got == {1: "c1", 2: "c1" if merged else "c2"}


def test_verification_gate(spark):
    rows = [(i, "twenty", f"m{i}", "d", "L") for i in range(20)] + [(100 + i, "more", f"m{i}", "b" if i < 10 else "a", "L, M" if i % 2 else None) for i in range(21)]
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id string, text string, future_date string, location_entities string")
    r = K.verify_candidates(df, CFG).collect()
    assert [x["cluster_id"] for x in r] == ["more"]
    assert len(r[0]["messages"]) == 15 and r[0]["size"] == 21
    assert (r[0]["predicted_time"], r[0]["predicted_location"]) == ("a", "L, M")
    assert K.verify_candidates(df.repartition(3), CFG).first()["messages"] == r[0]["messages"]


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("k", " ")], "k string, v string")
    assert K.most_common(df, "k", "v", "m").first()["m"] == "a"


def test_global_number(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("x"))
    assert [r["n"] for r in K.global_number(df, ["x"], "n").orderBy("x").collect()] == list(range(1, 501))


def test_pipeline_keywords_and_candidates(spark):
    rows = [(F_day, i, t, dt.datetime(2024, 1, 1, 10, i), angle(a)) for i, (t, a) in enumerate([("خبر مهم شهر", 0), ("خبر مهم امروز", 2), ("خبر مهم دیگری", 4), ("ورزش", 90)]) for F_day in [dt.date(2024, 1, 1)]]
    m = spark.createDataFrame(rows, "day date, msg_id bigint, text string, ts timestamp_ntz, vec array<float>")
    member = m.where("msg_id < 3").selectExpr("day", "msg_id", "0L as cluster")
    c = C.candidates(m, member, CFG.but(spike_z=1.0)).collect()
    assert [x["cluster_id"] for x in c] == ["CL_20240101_1"]
    assert c[0]["size"] == 3 and c[0]["keywords"][:1] == ["خبر"] and c[0]["date_shamsi"] == "1402/10/11"
    assert c[0]["messages"] == ["خبر مهم شهر", "خبر مهم امروز", "خبر مهم دیگری"] and c[0]["daily_ratio_pct"] == 75.0


def test_first_of_a_list(spark):
    values = ["['Tehran', 'Qom']", '["Qom"]', "[]", "[ ]", " Rey ", "[3, 4]", "[no literal", "[bare, words]", None, "['it\\'s', 'x']", "['a, b', 'c']"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: r["x"] for r in df.select("i", K.first_of_list(F.col("v")).alias("x")).collect()}
    assert [got[i] for i in range(len(values))] == ["Tehran", "Qom", None, None, "Rey", "3", "[no literal", "[bare, words]", None, "it's", "a, b"]
    rows = spark.createDataFrame([("c", "['Qom', 'x']"), ("c", "Qom"), ("c", "Rey"), ("d", "[]"), ("d", None)], "k string, v string")
    assert [tuple(r) for r in K.most_common(rows, "k", "v", "mode", lists=True).collect()] == [("c", "Qom")]


@pytest.mark.parametrize("buffered", [0, 7, 100_000])
def test_cohesion_of_any_size(spark, buffered):
    import numpy as np

    rng = np.random.default_rng(1)
    groups = {1: [0.5], 2: [0.25, -0.5], 3: [0.1] * 9, 4: list(rng.uniform(-1, 1, 40)), 5: list(rng.uniform(0.7, 0.700001, 33))}
    rows = [(dt.date(2024, 1, 1), k, i, float(x)) for k, xs in groups.items() for i, x in enumerate(xs)]
    sims = spark.createDataFrame(rows, "day date, cluster bigint, msg_id bigint, sim double")
    got = {r["cluster"]: r for r in C.cohesion(sims, CFG, buffered).collect()}
    assert got[1]["median_sim"] == got[1]["coverage"] == 0
    for k in (2, 3, 4, 5):
        assert got[k]["n"] == len(groups[k])
        assert got[k]["median_sim"] == pytest.approx(np.percentile(groups[k], 50), abs=1e-12)
        assert got[k]["p25_sim"] == pytest.approx(np.percentile(groups[k], 25), abs=1e-12)
    assert C.cohesion(sims.limit(0), CFG, buffered).count() == 0


def test_long_words_and_parts_across_a_blank_count(spark):
    """Terms are found in words longer than the index takes, at their ends and across a blank."""
    long = "x" * 70
    day, vec = dt.date(2024, 1, 1), [1.0, 0.5]
    texts = ["abc abc", "zabcy", f"{long}abcd", "qqabc defqq", "abc def", "abc def", f"{long} {long}"]
    rows = [(day, i, t, [v + i / 10 for v in vec]) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, "day date, msg_id bigint, text string, vec array<double>")
    member = messages.select("day", "msg_id", F.lit(1).cast("bigint").alias("cluster"))
    got = {r["term"]: r["score"] for r in C.keyword_scores(messages, member, CFG).collect()}
    freq = {"abc": 4, "def": 2, "abc def": 2, long: 2}
    vecs = [r[3] for r in rows]
    unit = lambda x: [y / math.hypot(*x) for y in x]
    mean = lambda xs: [sum(c) / len(xs) for c in zip(*xs, strict=True)]
    for term, n in freq.items():
        mine = mean([v for t, v in zip(texts, vecs, strict=True) if term in t])
        want = 0.7 * sum(a * b for a, b in zip(unit(mine), unit(mean(vecs)), strict=True)) + 0.3 * math.log1p(n)
        assert got[term] == pytest.approx(want, abs=1e-5), term
