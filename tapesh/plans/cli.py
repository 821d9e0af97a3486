"""Command line: python -m tapesh.plans.cli detect|predict --table PATH --out PATH."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.plans.pipelines import detect, predict
from tapesh.runtime import Scratch, scratch_scope
from tapesh.sinks import writers as W
from tapesh.sources.messages import MessageSource


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("pipeline", choices=("detect", "predict"))
    p.add_argument("--table", required=True)
    p.add_argument("--kind", choices=("parquet", "jdbc"), default="parquet")
    p.add_argument("--out", required=True)
    p.add_argument("--platform", default="telegram")
    p.add_argument("--text-col")
    p.add_argument("--date-col")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--source-name", default="")
    p.add_argument("--sample-size", type=int, default=10)
    p.add_argument("--max-input-tokens", type=int)
    p.add_argument("--skip-llm-verification", action="store_true")
    return p.parse_args(argv)


def config(a: argparse.Namespace) -> EngineConfig:
    tokens = a.max_input_tokens or (5000 if a.pipeline == "detect" else 4800)
    return EngineConfig(
        platform=a.platform, text_col=a.text_col, date_col=a.date_col, source_name=a.source_name, verifier_sample=a.sample_size,
        max_input_tokens=tokens, skip_verification=a.skip_llm_verification,
    )


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    cfg = config(a)
    spark = SparkSession.builder.appName("tapesh").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    rows = MessageSource(spark, a.table, cfg, a.kind).load(a.start_date, a.end_date)
    key = next((c for c in ("msg_id", "post_id", "tweet_id", "doc_id") if c in rows.columns), None)
    more = [c for c in ("location_entities", "event_entities") if c in rows.columns]
    with scratch_scope():
        ids = F.col(key) if key else F.monotonically_increasing_id()
        rows = rows.select(ids.alias("msg_id"), F.col(cfg.text).alias("text"), F.col("date").alias("ts"), *more)
        if not key:  # written, so that a message keeps the number it was given
            rows = Scratch(spark, "messages").write(rows)
        done = (detect if a.pipeline == "detect" else predict)(rows, cfg)
        for name, df in done.items():
            W.append(df, f"{a.out}/{name}")


if __name__ == "__main__":
    main()
