"""Moments written in many formats, calendars, precisions and zones, as one UTC instant.

An ordered cascade of anchored patterns, each strict: the first that matches
the whole value decides, and an impossible part (a day the month does not
have, hour 27, an unknown zone) makes the result null. Everything is column
arithmetic on the JVM; the only lookup is the zone of a source.

Policies: a wall-clock time that the clocks skip keeps the offset in force
before the change; one that occurs twice is the first; digits beyond
microseconds are cut; parts not written are zero. Years 1300 to 1499 are
Jalali, others Gregorian. Null, blank and placeholder values give null. No
value and no fraction is too long; a Unix time above 20 digits is none.
Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.functions import jalali as J
from tapesh.runtime import worked_out

# Names of months, and digits.
ENGLISH_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
JALALI_MONTHS = ("فروردین", "اردیبهشت", "خرداد", "تیر", "مرداد", "شهریور", "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند")
PERSIAN_DIGITS, ARABIC_DIGITS = "۰۱۲۳۴۵۶۷۸۹", "٠١٢٣٤٥٦٧٨٩"

_ZONE = r"(?: ?(Z|z|UTC|utc|GMT|gmt|[+-]\d{2}(?::?\d{2})?|\[[A-Za-z]+(?:[/_+-][A-Za-z0-9]+)*\]|(?<= )[A-Z][A-Za-z]+(?:[/_+-][A-Za-z0-9]+)+))?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d++))?)?(?: ?([AaPp])\.?[Mm]\.?)?"
_TAIL = rf"(?:(?:[Tt]|,? ?-? |,? ساعت ){_TIME}{_ZONE}|{_ZONE})$"
_DOW = r"(?:[A-Za-z]{3,9},? )?"
_EN = "(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_FA = "|".join(JALALI_MONTHS)

#: name, pattern, replacement: year, month, day, hour, minute, second, fraction, am or pm, zone, zone without time.
CASCADE = (
    ("ymd", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_TAIL}", "$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    ("numeric", rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}){_TAIL}", "$4|$1|$3|$5|$6|$7|$8|$9|$10|$11"),
    ("compact", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt]?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d++))?)?{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8|"),
    ("day_name", rf"^{_DOW}(\d{{1,2}})[- ]({_EN}|{_FA})\.?,?[- ](\d{{4}}){_TAIL}", "$3|$2|$1|$4|$5|$6|$7|$8|$9|$10"),
    ("name_day", rf"^{_DOW}({_EN})\.? (\d{{1,2}}),? (\d{{4}}){_TAIL}", "$3|$1|$2|$4|$5|$6|$7|$8|$9|$10"),
    ("unix", r"^(\d++)(?:\.(\d++))?$", "$1||||||$2|||"),
)


def clean_value(value: Column) -> Column:
    """ASCII digits, one blank between parts, nothing around them."""
    text = F.translate(value, PERSIAN_DIGITS + ARABIC_DIGITS + "يك", "0123456789" * 2 + "یک")
    text = F.regexp_replace(text, r"[\s\x00\p{Z}\p{Cf}]+", " ")
    return F.trim(text)


def known_zones(df: DataFrame) -> list[str]:
    """The names of the JVM's zone table, some 600."""
    return sorted(df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds())


def to_utc_micros(df: DataFrame, value: str, zone: str, date_order: str | None, out: str = "utc_us") -> DataFrame:
    """df with out: microseconds since 1970-01-01 UTC of the moment that value names, or null.

    zone names the column with the zone of values without one (null: UTC);
    date_order the column with 'dmy' or 'mdy' (null: dmy). Other columns of
    df stay as they are.
    """
    zones = known_zones(df)
    # the row goes along as it is, so that no column of it can clash with a working column
    given = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != out]).alias("_row")
    order = F.col(date_order) if date_order else F.lit("dmy")
    t = df.select(given, clean_value(F.col(value)).alias("_v"), F.col(zone).alias("_default"), order.alias("_order"))
    kind, parts = F.lit(None).cast("int"), F.lit(None).cast("string")
    for k, (_, pattern, order) in reversed(list(enumerate(CASCADE))):
        kind = F.when(F.col("_v").rlike(pattern), k).otherwise(kind)
        parts = F.when(F.col("_k") == k, F.regexp_replace("_v", pattern, order)).otherwise(parts)
    # digits alone read as a date only if they have the length of one and a plausible year
    plain = F.col("_v").rlike(r"^\d+$")
    dated = F.length("_v").isin(8, 12, 14) & F.col("_v").rlike("^(?:1[34]|19|20)")
    t = t.withColumn("_k", F.when(plain & ~dated, 5).otherwise(kind))
    t = worked_out(t.withColumn("_p", F.split(parts, r"\|")), "_v", "_k", "_p")
    item = lambda i: F.nullif(F.get(F.col("_p"), F.lit(i)), F.lit(""))
    month = item(1)
    low = F.lower(F.substring(month, 1, 3))
    number = F.coalesce(*[F.when(low == m, i + 1) for i, m in enumerate(ENGLISH_MONTHS)], *[F.when(month == m, i + 1) for i, m in enumerate(JALALI_MONTHS)], month.try_cast("int"))
    t = t.withColumns({"_y": item(0).try_cast("int"), "_m": number, "_d": item(2).try_cast("int"), "_named": F.when(month.rlike("^[A-Za-z]"), "g").when(~month.rlike(r"^\d"), "j")})
    swap = (F.col("_k") == 1) & (F.coalesce(F.col("_order"), F.lit("dmy")) == "dmy")
    t = t.withColumns({"_m": F.when(swap, F.col("_d")).otherwise(F.col("_m")), "_d": F.when(swap, F.col("_m")).otherwise(F.col("_d"))})
    y, m, d = F.col("_y"), F.col("_m"), F.col("_d")
    t = worked_out(t, "_y", "_m", "_d", "_named")
    is_jalali = y.between(1300, 1499)
    fits = F.when(is_jalali, F.coalesce(F.col("_named") == "j", F.lit(True)) & J.valid_jalali(y, m, d)).otherwise(F.coalesce(F.col("_named") == "g", F.lit(True)) & J.valid_gregorian(y, m, d))
    day = F.when(fits, F.when(is_jalali, J.jalali_to_epoch_day(y, m, d)).otherwise(J.gregorian_to_epoch_day(y, m, d)))
    h12, half = item(3).try_cast("int"), F.lower(item(7))
    hour = F.when(half.isNull(), F.coalesce(h12, F.lit(0))).when(h12.between(1, 12), h12 % 12 + F.when(half == "p", 12).otherwise(0))
    minute, second = F.coalesce(item(4).try_cast("int"), F.lit(0)), F.coalesce(item(5).try_cast("int"), F.lit(0))
    micros = F.rpad(F.substring(F.coalesce(item(6), F.lit("0")), 1, 6), 6, "0").cast("int")
    t = t.withColumns({"_day": day, "_hour": hour.cast("long"), "_min": minute.cast("long"), "_sec": second.cast("long"), "_us": micros, "_z": F.coalesce(item(8), item(9))})
    t = worked_out(t, "_day", "_hour", "_min", "_sec", "_us", "_z")
    right = F.col("_hour").between(0, 23) & F.col("_min").between(0, 59) & F.col("_sec").between(0, 59)
    local = F.when(right, F.col("_day").cast("long") * 86_400_000_000 + F.col("_hour") * 3_600_000_000 + F.col("_min") * 60_000_000 + F.col("_sec") * 1_000_000 + F.col("_us"))
    whole = item(0).try_cast("decimal(20,0)")
    scale = F.when(whole < 10**11, 10**6).when(whole < 10**14, 10**3).otherwise(1)
    unix = F.when(whole < 10**17, (whole * scale).cast("long")).otherwise((whole - whole % 1000) / 1000).cast("long")
    t = t.withColumns({"_local": local, "_unix": unix + F.when(whole < 10**11, F.col("_us")).otherwise(0)})
    z = F.col("_z")
    sign = F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1)
    oh, om = F.substring(z, 2, 2).try_cast("int"), F.coalesce(F.nullif(F.regexp_extract(z, r"^[+-]\d{2}:?(\d{2})$", 1), F.lit("")).try_cast("int"), F.lit(0))
    offset = F.when((oh <= 18) & (om <= 59), (sign * (oh * 60 + om)).cast("long") * 60_000_000)
    name = F.when(z.isNull(), F.coalesce(F.col("_default"), F.lit("UTC"))).otherwise(F.regexp_replace(z, r"[\[\]]", ""))
    name = F.when(F.upper(name).isin("Z", "UTC", "GMT"), "UTC").when(name.isin(zones), name)
    t = worked_out(t.withColumn("_zone", name), "_local", "_unix", "_zone")
    at = F.when(F.col("_k") == 5, F.col("_unix")).when(z.rlike("^[+-]"), F.col("_local") - offset).when(F.col("_zone") == "UTC", F.col("_local"))
    at = at.otherwise(F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(F.col("_local")), F.col("_zone"))))
    return worked_out(t.select("_row", at.alias("_at")), "_at").select("_row.*", F.col("_at").alias(out))
