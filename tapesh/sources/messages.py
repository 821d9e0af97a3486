"""Message sources: Parquet folders and JDBC tables behind one interface, and the report reader."""

from __future__ import annotations

import datetime as dt
import os
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import jalali as J
from tapesh.functions import text as T
from tapesh.operators.keycluster import global_number

_SHAPE = re.compile(r"\d{4}-\d{2}-\d{2}")


def jdbc_options() -> dict[str, str]:
    """Connection options from CH_HOST, CH_PORT, CH_USER and CH_PASS; there are no defaults."""
    missing = [k for k in ("CH_HOST", "CH_PORT", "CH_USER", "CH_PASS") if not os.environ.get(k)]
    if missing:
        raise RuntimeError(f"set {', '.join(missing)}")
    url = f"jdbc:clickhouse://{os.environ['CH_HOST']}:{os.environ['CH_PORT']}/"
    return {"url": url, "user": os.environ["CH_USER"], "password": os.environ["CH_PASS"]}


def check_jalali(bound: str) -> str:
    """A bound of the form yyyy-MM-dd, by shape alone."""
    if not _SHAPE.fullmatch(bound):
        raise ValueError(f"not a yyyy-MM-dd date: {bound!r}")
    return bound


def gregorian_range(df: DataFrame, date: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of start <= day < end; the comparison reaches the scan as a range of timestamps."""
    return _between(df, F.to_date(date), start and F.lit(start).cast("date"), end and F.lit(end).cast("date"))


def _between(df: DataFrame, value: Column, start: Column | None, end: Column | None) -> DataFrame:
    bounds = ([value >= start] if start is not None else []) + ([value < end] if end is not None else [])
    return df.where(reduce(lambda a, b: a & b, bounds)) if bounds else df


def jalali_range(df: DataFrame, date: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of start <= date < end as strings, in which zero-padded dates sort as days."""
    return _between(df, F.col(date), start and F.lit(check_jalali(start)), end and F.lit(check_jalali(end)))


#: Rows fetched at once, and parts read where no key is given.
FETCH_ROWS, DAYS_AT_MOST = 10_000, 5_000


def day_predicates(date: str, start: str | None, end: str | None) -> list[str]:
    """A condition for each day of start <= day < end, so that each is read by a task of its own; nothing for an open range."""
    if not start or not end:
        return []
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = [first + dt.timedelta(days=k) for k in range((last - first).days)]
    if len(days) > DAYS_AT_MOST:
        raise ValueError(f"more than {DAYS_AT_MOST} days")
    return [f"{date} >= '{a}' AND {date} < '{a + dt.timedelta(days=1)}'" for a in days]


@dataclass(frozen=True)
class MessageSource:
    """A table of messages, at a Parquet path or behind JDBC.

    Behind JDBC the table is read in parts: by ranges of a numeric or date
    key, given as (column, lowest, highest, parts), else by the days asked
    for. A range of Jalali days and an open range without a key are read by
    one task.
    """

    spark: SparkSession
    table: str
    cfg: EngineConfig = EngineConfig()
    kind: str = "parquet"
    key: tuple[str, str, str, int] | None = None

    def read_options(self, start: str | None = None, end: str | None = None) -> tuple[dict[str, str], list[str]]:
        """Options of the JDBC reader, and the conditions of its parts if these are days."""
        options = {"dbtable": self.table, "fetchsize": str(FETCH_ROWS)}
        if self.key:
            column, low, high, parts = self.key
            return options | {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}, []
        return options, [] if self.cfg.is_twitter else day_predicates(self.cfg.date, start, end)

    def scan(self, start: str | None = None, end: str | None = None) -> DataFrame:
        if self.kind == "parquet":
            return self.spark.read.parquet(self.table)
        options, days = self.read_options(start, end)
        options |= jdbc_options()
        if days:
            url = options.pop("url")
            return self.spark.read.jdbc(url, options.pop("dbtable"), predicates=days, properties=options)
        return self.spark.read.format("jdbc").options(**options).load()

    def load(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return prepare(self.scan(start, end), self.cfg, start, end)


def in_order(df: DataFrame, *by: str, out: str = "row_no") -> DataFrame:
    """df with out, the place of each row by date and id from 0, the same however the table is read; rows equal in all of by are in any order."""
    numbered = global_number(df, list(by), out)
    return numbered.withColumn(out, F.col(out) - 1)


def prepare(df: DataFrame, cfg: EngineConfig, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with text and date, in range, the date a TIMESTAMP_NTZ column named date.

    Columns that are missing are passed over. Twitter dates are Jalali days,
    maybe bytes with padding; others are read as they stand.
    """
    text, date = cfg.text, cfg.date
    df = df.dropna(subset=[c for c in (text, date) if c in df.columns])
    if date not in df.columns:
        return df
    if cfg.is_twitter:
        raw = F.decode(date, "UTF-8") if dict(df.dtypes)[date] == "binary" else F.col(date).cast("string")
        df = df.withColumn(date, T.strip(F.translate(raw, "\0", "")))
        df = jalali_range(df, date, start, end)
        return df.withColumn("date", J.parse_jalali(F.substring(F.replace(date, F.lit("/"), F.lit("-")), 1, 10), "-").cast("timestamp_ntz"))
    df = gregorian_range(df, date, start, end)
    return df.withColumn("date", F.col(date).try_cast("timestamp_ntz"))


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """day of start <= day < end, by epoch days, so that no calendar's month lengths matter."""
    if end <= start:
        raise ValueError("end must be after start")
    return spark.range(1).select(F.explode(F.expr(f"sequence(date'{start}', date_sub(date'{end}', 1))")).alias("day"))


# The labels of a report's header.
JALALI_LABEL, GREGORIAN_LABEL, RAW_LABEL = "Date (Jalali):", "(Gregorian):", "Total raw messages:"
_LINE = r"(?m)^[ \t]*\d+\.[ \t]*\[(\d{2}:\d{2}:\d{2})\][ \t]*(.*)$"


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """day, raw_count, filtered_count, no, at, text: the messages of phase-one reports, for resuming.

    Blocks are split by 70 equals signs as they are read; filtered_count is
    what the parsed lines leave of raw_count. A day without lines has one row
    with nulls.
    """
    blocks = spark.read.option("lineSep", "=" * 70).text(path)
    said = F.transform(F.split("value", "\n"), F.trim)
    labelled = lambda label: F.get(F.filter(said, lambda x: x.startswith(label)), F.lit(0))
    day = F.trim(F.substring_index(labelled(JALALI_LABEL), GREGORIAN_LABEL, -1)).try_cast("date")
    count = F.trim(F.substring_index(F.substring_index(labelled(RAW_LABEL), RAW_LABEL, -1), "|", 1)).try_cast("int")
    lines = F.regexp_extract_all("value", F.lit(_LINE), F.lit(0))
    days = blocks.select(day.alias("day"), count.alias("raw_count"), lines.alias("_l")).where(F.col("day").isNotNull() & F.col("raw_count").isNotNull())
    rows = days.select("day", "raw_count", (F.col("raw_count") - F.size("_l")).alias("filtered_count"), F.posexplode_outer("_l").alias("_p", "_x"))
    at = F.concat(F.col("day").cast("string"), F.lit(" "), F.regexp_extract("_x", _LINE, 1)).try_cast("timestamp_ntz")
    return rows.select("day", "raw_count", "filtered_count", (F.col("_p") + 1).alias("no"), at.alias("at"), F.regexp_extract("_x", _LINE, 2).alias("text"))
