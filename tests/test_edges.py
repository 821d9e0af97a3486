"""Sources, models, sinks, streams, command line and the whole pipelines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapesh import schemas
from tapesh.config import EngineConfig
from tapesh.models import interfaces as M
from tapesh.plans import cli, pipelines
from tapesh.sinks import writers as W
from tapesh.sources import messages as S
from tapesh.streaming import windows

CFG = EngineConfig()


def test_prepare_telegram_and_twitter(spark):
    df = spark.createDataFrame([("a", "2024-01-02 03:04:05"), (None, "2024-01-02"), ("b", None), ("c", "2024-01-05")], "txtContent string, date string")
    out = S.prepare(df, CFG, "2024-01-01", "2024-01-05").collect()
    assert [(r["txtContent"], str(r["date"])) for r in out] == [("a", "2024-01-02 03:04:05")]
    tw = spark.createDataFrame([("a", bytearray(b"1404-01-01\x00\x00")), ("b", bytearray(b"1404-02-01"))], "txtContent string, shdate binary")
    out = S.prepare(tw, EngineConfig(platform=" X "), "1404-01-01", "1404-02-01").collect()
    assert [(r["txtContent"], str(r["date"])) for r in out] == [("a", "2025-03-21 00:00:00")]
    with pytest.raises(ValueError):
        S.jalali_range(tw, "shdate", "1404/01/01", None)
    assert S.prepare(spark.createDataFrame([("a",)], "txtContent string"), CFG).count() == 1


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.lit("t").alias("txtContent"), F.lit("x").alias("more"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("date")).write.parquet(str(tmp_path / "m"))
    src = S.MessageSource(spark, str(tmp_path / "m"))
    plan = src.load("1970-01-01", "1970-01-02").select("date")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "more" not in plan


def test_connection_needs_every_variable(monkeypatch):
    for k in ("CH_HOST", "CH_PORT", "CH_USER", "CH_PASS"):
        monkeypatch.delenv(k, raising=False)
    with pytest.raises(RuntimeError):
        S.jdbc_options()


def test_day_range(spark):
    assert [str(r["day"]) for r in S.day_range(spark, "2024-02-28", "2024-03-02").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(ValueError):
        S.day_range(spark, "2024-01-02", "2024-01-02")


def test_report_round_trip(spark, tmp_path):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    counts = spark.createDataFrame([(d1, 5, 2), (d2, 1, 0)], "day date, raw_count int, kept_count int")
    kept = spark.createDataFrame([(d1, 1, dt.datetime(2024, 1, 1, 9, 8, 7), "a [x] b"), (d1, 2, dt.datetime(2024, 1, 1, 10, 0, 0), "خبر")], "day date, no int, ts timestamp_ntz, clean_text string")
    W.report_text(W.classification_report(kept, counts), str(tmp_path / "r"), "day", "no")
    got = sorted((str(r["day"]), r["raw_count"], r["filtered_count"], r["no"], str(r["at"]), r["text"]) for r in S.read_report(spark, str(tmp_path / "r")).collect() if r["no"])
    assert got == [("2024-01-01", 5, 3, 1, "2024-01-01 09:08:07", "a [x] b"), ("2024-01-01", 5, 3, 2, "2024-01-01 10:00:00", "خبر")]


def test_classifier(spark):
    df = spark.createDataFrame([("یک خبر مهم",), ("ab",), (None,)], "t string")
    assert [r["passed_filter"] for r in M.classify(df, "t", M.rule_classifier()).collect()] == [True, False, False]
    always = M.model_classifier(lambda: lambda texts: [1] * len(texts), batch=2)
    assert [r["passed_filter"] for r in M.classify(df, "t", always).collect()] == [True, False, False]


def test_embedders(spark):
    df = spark.createDataFrame([("a b",), ("a b",), (None,)], "t string")
    rows = [r[0] for r in df.select(M.hashing_embedder(8)(F.col("t"))).collect()]
    assert rows[0] == rows[1] and abs(sum(x * x for x in rows[0]) - 1) < 1e-5 and rows[2] == [0.0] * 8

    def broken():
        def run(texts):
            raise RuntimeError

        return run

    assert df.select(M.model_embedder(broken, dim=3)(F.col("t")).alias("v")).first()["v"] == [0.0] * 3


def test_entities(spark):
    df = spark.createDataFrame([("در تهران و قم جشن بود",), ("هیچ",), (None,)], "t string")
    out = M.extract_entities(df, "t", M.gazetteer(["تهران", "قم"], ["جشن"])).collect()
    assert [(r["location_entities"], r["event_entities"]) for r in out] == [("تهران، قم", "جشن"), (None, None), (None, None)]
    assert M.extract_entities(df, "t", M.gazetteer(["تهران"], ["جشن"]), keep_both=True).count() == 1


def test_prompt_budget():
    cfg = CFG.but(max_input_tokens=30, token_caps=(10, 5))
    assert M.build_prompt(["a b", "c"], cfg) == "[1] a b\n[2] c"
    assert M.build_prompt(["w " * 40, "c"], cfg) == "[1] " + " ".join(["w"] * 10) + "\n[2] c"
    assert M.build_prompt(["w " * 300] * 9, CFG.but(max_input_tokens=450, token_caps=(400,))).count("[") == 2
    caps, cap = [], None
    while (cap := M.next_cap(cap, CFG.oom_caps)) is not None:
        caps.append(cap)
    assert caps == [300, 250, 200, 150, 100, 50, 20]


def test_verifier(spark):
    df = spark.createDataFrame([(1, ["a b c"] * 12), (2, ["x"]), (3, []), (4, None)], "k bigint, m array<string>")
    out = {r["k"]: r for r in M.verify(df, "k", "m", CFG).collect()}
    assert set(out) == {1, 2} and out[1]["is_event"] and not out[2]["is_event"] and out[1]["summary"] == "10 messages"

    def moody():
        calls = []

        def run(prompt):
            calls.append(prompt)
            if len(calls) == 1:
                raise M.OutOfMemory
            return "garbage" if len(calls) == 2 else '{"is_event": true, "title": "t"}'

        return run

    r = M.verify(df.where("k = 1"), "k", "m", CFG, moody).first()
    assert (r["attempts"], r["oom_count"], r["used_token_cap"], r["parsed"], r["is_event"], r["title"]) == (3, 1, 300, True, True, "t")
    never = M.verify(df.where("k = 1"), "k", "m", CFG, lambda: lambda p: "garbage").first()
    assert (never["attempts"], never["parsed"], never["is_event"]) == (5, False, False)


def test_abort_after_failures(spark):
    rows = [("d", i, ok) for i, ok in enumerate([True, False, False, True, False, False, False, True, True])]
    df = spark.createDataFrame(rows, "day string, i int, parsed boolean")
    assert [r["i"] for r in M.abort_run(df, "day", "i", 3).orderBy("i").collect()] == list(range(7))


def test_status(spark):
    rows = spark.createDataFrame([(1, "pending", '{"messages":["a"]}'), (2, "pending", '{"messages":["a"]}'), (3, "pending", '{"messages":[]}'), (4, "pending", '{"messages":["a"]}')], "id bigint, validation_status string, sample_messages string")
    yes = spark.createDataFrame([(1,), (1,)], "id bigint")
    status = lambda df: {r["id"]: r["validation_status"] for r in df.collect()}
    assert status(W.update_status(rows, yes)) == {1: "confirmed", 2: "rejected", 3: "pending", 4: "rejected"}
    assert set(status(W.update_status(rows, yes, attempted=False)).values()) == {"pending"}
    unread = spark.createDataFrame([(4,)], "id bigint")
    assert status(W.update_status(rows, yes, keep_unread=unread))[4] == "pending"


def test_day_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    W.overwrite_days(spark.createDataFrame([("a", 1), ("b", 1)], "day string, x int"), path)
    W.overwrite_days(spark.createDataFrame([("b", 2)], "day string, x int"), path)
    assert {(r["day"], r["x"]) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 2)}


def test_empty_frames(spark):
    for ddl in (schemas.CANDIDATE, schemas.CANDIDATE_CLUSTERS, schemas.DETECTED_EVENTS, schemas.PREDICTED_EVENTS, schemas.EVENT_RECORDS, schemas.REPLY):
        assert schemas.empty(spark, ddl).count() == 0


def detection_rows(spark):
    rows = [(i, f"بارش شدید برف در شهر {i % 2}", dt.datetime(2024, 1, 1, 10, i)) for i in range(12)]
    rows += [(100 + i, t, dt.datetime(2024, 1, 1, 3 + i, 0)) for i, t in enumerate(["نمایشگاه کتاب باز شد", "مسابقه فوتبال تهران", "قیمت نان ثابت ماند", "خط مترو افتتاح شد"])]
    rows += [(200, None, dt.datetime(2024, 1, 1)), (201, "ab", dt.datetime(2024, 1, 1)), (300, "یک خبر تنها امروز", dt.datetime(2024, 1, 2))]
    return spark.createDataFrame(rows, "msg_id bigint, text string, ts timestamp_ntz")


def test_detection(spark):
    out = pipelines.detect(detection_rows(spark), CFG)
    c = out["candidates"].collect()
    assert len(c) == 1 and c[0]["size"] == 12 and c[0]["cluster_id"] == "CL_20240101_1"
    assert [r["validation_status"] for r in out["candidate_rows"].collect()] == ["confirmed"]
    assert out["event_rows"].count() == 1 == out["verified"].count()
    assert W.candidate_report(out["candidates"]).first()["value"].startswith(" Candidate CL_20240101_1")
    assert W.verified_report(out["verified"]).count() == 1
    assert "replies" not in pipelines.detect(detection_rows(spark), CFG.but(skip_verification=True))


def test_days_apart_equal_days_together(spark):
    rows = detection_rows(spark)
    more = rows.withColumns({"msg_id": F.col("msg_id") + 1000, "ts": F.col("ts") + F.expr("interval 7 days")})
    cfg = CFG.but(skip_verification=True)
    run = lambda df: sorted((r["cluster_id"], r["size"]) for r in pipelines.detect(df, cfg)["candidates"].collect())
    assert run(rows.unionByName(more)) == sorted(run(rows) + run(more))


def test_prediction(spark, tmp_path):
    rows = [(i, f"جشن بزرگ فردا برگزار می‌شود شماره {'الف' * (i % 5 + 1)}", dt.datetime(2025, 8, 23, 9, i % 60), "تهران", "جشن") for i in range(25)]
    rows += [(100, "دیروز جشن بود", dt.datetime(2025, 8, 23), "تهران", "جشن"), (101, None, dt.datetime(2025, 8, 23), None, None)]
    df = spark.createDataFrame(rows, "msg_id bigint, text string, ts timestamp_ntz, location_entities string, event_entities string")
    out = pipelines.predict(df, CFG.but(medoid_duplicate=1.1, medoid_noise=-1.0))
    r = out["predicted_rows"].collect()
    assert len(r) == 1 and str(r[0]["predicted_time"]) == "2025-08-24 00:00:00" and r[0]["predicted_location"] == "تهران"
    assert out["dated"].count() == 25
    W.append(out["predicted_rows"], str(tmp_path / "p"))
    assert W.event_records(spark.read.parquet(str(tmp_path / "p"))).count() == 1


def test_cli(spark, tmp_path):
    rows = detection_rows(spark).selectExpr("msg_id", "text as txtContent", "ts as date")
    rows.write.parquet(str(tmp_path / "in"))
    cli.main(["detect", "--table", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--skip-llm-verification", "--start-date", "2024-01-01", "--end-date", "2024-01-02"])
    assert spark.read.parquet(str(tmp_path / "out/candidates")).count() == 1
    assert cli.config(cli.arguments(["predict", "--table", "t", "--out", "o", "--platform", "x"])).date == "shdate"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = detection_rows(spark)
    rows.unionByName(rows.limit(3)).write.parquet(src)
    stream = windows.first_seen(windows.read_stream(spark, src, rows.schema), "msg_id", "ts")
    seen = []
    q = windows.run_batches(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sum(seen) == rows.count()
    counts = windows.day_counts(windows.read_stream(spark, src, rows.schema), "ts", "text")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("day_counts_test").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {str(r["day"]): r["raw_count"] for r in spark.table("day_counts_test").collect()}
    assert sum(got.values()) == rows.count() + 3
    hours = windows.hour_counts(windows.read_stream(spark, src, rows.schema), "ts", [])
    q = hours.writeStream.outputMode("complete").format("memory").queryName("hour_counts_test").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("hour_counts_test").agg(F.max("n")).first()[0] >= 12


def test_jdbc_is_read_in_parts(spark):
    src = S.MessageSource(spark, "db.messages", CFG, "jdbc")
    options, days = src.read_options("2024-02-28", "2024-03-02")
    assert days == ["date >= '2024-02-28' AND date < '2024-02-29'", "date >= '2024-02-29' AND date < '2024-03-01'", "date >= '2024-03-01' AND date < '2024-03-02'"]
    assert int(options["fetchsize"]) > 0 and src.read_options("2024-02-28", None)[1] == []
    keyed, days = S.MessageSource(spark, "db.messages", CFG, "jdbc", ("id", "1", "900", 12)).read_options("2024-02-28", "2024-03-02")
    assert days == [] and (keyed["partitionColumn"], keyed["lowerBound"], keyed["upperBound"], keyed["numPartitions"]) == ("id", "1", "900", "12")
    with pytest.raises(ValueError):
        S.day_predicates("date", "1900-01-01", "2024-01-01")


def test_rows_have_a_stable_order(spark):
    rows = [(dt.datetime(2024, 1, 1 + i % 3), i) for i in range(50)] + [(None, 99)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, id int")
    orders = [{r["id"]: r["row_no"] for r in S.in_order(x, "date", "id").collect()} for x in (df, df.repartition(7))]
    want = {i: k for k, (_, i) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or dt.datetime.min, r[1])))}
    assert orders[0] == orders[1] == want
    assert S.in_order(df.limit(0), "date", "id").count() == 0


def test_clustering_report(spark, tmp_path):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    at = dt.datetime(2024, 1, 1, 9, 8, 7)
    rows = [(d1, 5, 2, at, "b"), (d1, 5, 1, at, "a"), (d1, 9, 3, at, "alone"), (d2, 7, 4, at, "alone too")]
    members = spark.createDataFrame(rows, "day date, cluster bigint, msg_id bigint, ts timestamp_ntz, text string")
    W.report_text(W.clustering_report(members), str(tmp_path / "r"), "day", "cluster", "no")
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "r")).collect())
    assert text.count("Clusters found (with more than 1 message): 1") == 1 and text.count("Clusters found (with more than 1 message): 0") == 1
    assert " Cluster #1 (2 message(s)):\n    - [09:08:07] a\n    - [09:08:07] b" in text and "alone" not in text


def test_frames_of_days_are_combined(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, t string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(map(tuple, W.combined(a, b, b).collect())) == [(1, "x"), (2, None), (2, None)]


def test_run_totals_and_aborted_days(spark):
    counts = spark.createDataFrame([(dt.date(2024, 1, 1), 5, 2), (dt.date(2024, 1, 2), 1, 0)], "day date, raw_count int, kept_count int")
    assert tuple(pipelines.run_totals(counts, counts, counts.limit(1)).first()) == (2, 6, 2, 4, 2, 1)
    assert tuple(pipelines.run_totals(counts.limit(0)).first()) == (0, 0, 0, 0, None, None)
    day = dt.date(2024, 1, 1)
    cands = spark.createDataFrame([(day, f"c{i}") for i in range(9)], "day date, cluster_id string")
    replies = spark.createDataFrame([(f"c{i}", i not in (2, 3, 4)) for i in range(9)], "cluster_id string, parsed boolean")
    left = pipelines.until_aborted(replies, cands, "day", CFG.but(abort_after=3))
    assert sorted(r["cluster_id"] for r in left.collect()) == ["c0", "c1", "c2", "c3", "c4"]
    assert pipelines.until_aborted(replies, cands, "day", CFG.but(abort_after=0)).count() == 9


def test_scratch_tables_end_with_their_scope(spark):
    import os

    from tapesh.runtime import HotKeys, Scratch, hot_values, lookup_join, scratch_scope

    with scratch_scope():
        scratch = Scratch(spark, "scope")
        table = scratch.write(spark.range(5))
        assert table.count() == 5
    assert not os.path.exists(scratch.root.removeprefix("file:"))
    counts = spark.createDataFrame([("a", 900), ("b", 1)], "k string, n bigint")
    hot = hot_values(counts, "k", "n", least=10)
    assert hot == ["a"] and hot.slices == HotKeys.slices
    rows = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 1)], "k string, i int")
    assert lookup_join(rows, counts, ["k"], hot, F.col("i")).count() == 31
