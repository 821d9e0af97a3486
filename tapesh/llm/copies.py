"""Copies hidden by layout: white space, letter case, punctuation and the order of labelled fields.

A text becomes a multiset of normalised (label, value) fields, a text that is
not written as fields a single one. Each field is hashed and the hashes are
combined by sums, which do not depend on order; texts are grouped by that
fingerprint, and every member is verified against the group's smallest id by
comparing the multisets of fields, without sorting: by hash sets where no
field repeats, else by the counts of the fields. Members that fail (a hash
collision) go through the same again with other hashes.

Defined cases: null texts and texts without letters or digits are no copies;
a repeated row is no copy of itself; where an id repeats with other texts,
each of them counts; no length and no number of fields is too long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import Scratch, hot_values, lookup_join, spread

_LAYOUT = r"[\p{P}$+<=>^`|~ \t\n\r\f\x0B]+"
_BETWEEN = r"[\n\r|;؛]+"
#: A label is what stands before the first colon of a part, if it has a letter.
_FIELD = r"(?s)^[^\p{L}\p{N}:]*+(?=[^\p{L}:：]*\p{L})([^:：]*+)[:：](.*)$"
_LOW = 0xFFFFFFFF


def plain(text: Column) -> Column:
    """Text without letter case, white space and punctuation.

    Letters whose capitals are the same fold alike: dotted and dotless i,
    sharp s and two s, both sigmas.
    """
    low = F.translate(F.lower(F.translate(text, "\u0130", "i")), "\u0131\u03c2", "i\u03c3")
    return F.regexp_replace(F.replace(low, F.lit("\u00df"), F.lit("ss")), _LAYOUT, "")


def fields_of(text: Column) -> Column:
    """Array of normalised fields; a text of one field, or with a part that is none, is a single element."""
    parts = F.filter(F.split(text, _BETWEEN), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    labelled = (F.size(parts) >= 2) & F.forall(parts, lambda x: x.rlike(_FIELD))
    field = lambda x: F.concat(plain(F.regexp_extract(x, _FIELD, 1)), F.lit("\x01"), plain(F.regexp_extract(x, _FIELD, 2)))
    return F.when(labelled, F.transform(parts, field)).otherwise(F.array(F.concat(F.lit("\x02"), plain(text))))


def fingerprint(fields: Column) -> list[Column]:
    """Two bigints: sums of the fields' hashes, by halves so that no sum overflows."""

    def lane(seed: int) -> Column:
        hashed = F.transform(fields, lambda x: F.xxhash64(x, F.lit(seed)))
        half = lambda cut: F.aggregate(hashed, F.lit(0).cast("long"), lambda s, h: s + cut(h).bitwiseAND(F.lit(_LOW)))
        low, high = half(lambda h: h), half(lambda h: F.shiftrightunsigned(h, 32))
        return low.bitwiseXOR(F.shiftleft(high, 31))

    return [lane(1).alias("f1"), lane(2).alias("f2")]


def same_fields(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same elements, null if that takes counts: an element repeats in both."""
    repeats = lambda x: F.size(F.array_distinct(x)) < F.size(x)
    return (
        F.when(F.size(a) != F.size(b), False)
        .when(repeats(a) & repeats(b), F.when(F.size(F.array_distinct(a)) != F.size(F.array_distinct(b)), False))
        .when(repeats(a) | repeats(b), False)
        .otherwise(F.size(F.array_except(a, b)) == 0)
    )


def same_counts(pairs: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """by, same: whether the arrays a and b hold the same elements equally often."""
    each = lambda c, n: pairs.select(*by, F.explode(c).alias("_x"), F.lit(n).alias("_n"))
    counts = each(a, 1).unionByName(each(b, -1)).groupBy(*by, "_x").agg(F.sum("_n").alias("_n"))
    return counts.groupBy(*by).agg((F.max(F.abs("_n")) == 0).alias("same"))


def copies(df: DataFrame, key: str, text: str, scratch: Scratch | None = None) -> DataFrame:
    """keep_id, <key>: each row that is not the smallest key of its set of copies."""
    scratch = scratch or Scratch(df.sparkSession, "copies")
    rows = spread(df.select(F.col(key).alias("id"), F.col(text).alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull())).where(F.col("t").rlike(r"[\p{L}\p{N}]"))
    prints = scratch.write(rows.select("id", fields_of(F.col("t")).alias("f")).select("id", *fingerprint(F.col("f"))), "prints")
    sets, members = _members(scratch, prints)
    # only rows of sets of copies have their texts moved; a text goes by its id and its fingerprint
    texts = rows.join(members.select("id").distinct(), "id", "left_semi").select("id", fields_of(F.col("t")).alias("f"))
    texts = scratch.write(texts.select("*", *fingerprint(F.col("f"))).dropDuplicates(["id", "f1", "f2"]), "texts")
    good, failed = _verified(scratch, sets, members, texts)
    found, level = good, 0
    while not failed.isEmpty():
        level += 1
        other = failed.join(texts, ["id", "f1", "f2"]).select("id", "f", *fingerprint(F.transform("f", lambda x: F.concat(F.lit(f"{level}\x04"), x))))
        other = scratch.write(other, "other")
        sets, members = _members(scratch, other.select("id", "f1", "f2"))
        good, failed = _verified(scratch, sets, members, other)
        found, texts = found.unionByName(good), other
    return found.distinct().select("keep_id", F.col("id").alias(key))


def _members(scratch: Scratch, prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets of more than one id with one fingerprint, and their members."""
    sets = prints.groupBy("f1", "f2").agg(F.min("id").alias("keep_id"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    sets = scratch.write(sets.where(F.col("keep_id") < F.col("last")).drop("last"), "sets")
    members = lookup_join(prints, sets.select("f1", "f2", "keep_id"), ["f1", "f2"], hot_values(sets, "f1", "n"), F.col("id"))
    return sets, scratch.write(members.select("id", "keep_id", "f1", "f2"), "members")


def _verified(scratch: Scratch, sets: DataFrame, members: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keep_id, id of members with the fields of the kept text, and id, f1, f2 of the others."""
    on = ["id", "f1", "f2"]
    pairs = members.where(F.col("id") != F.col("keep_id")).distinct().join(texts, on)
    kept = texts.join(sets.select(F.col("keep_id").alias("id"), "f1", "f2"), on, "left_semi").select(F.col("id").alias("keep_id"), "f1", "f2", F.col("f").alias("g"))
    pairs = lookup_join(pairs, kept, ["keep_id", "f1", "f2"], hot_values(sets, "keep_id", "n"), F.col("id"))
    same = same_fields(F.col("f"), F.col("g"))
    checked = scratch.write(pairs.select("keep_id", *on, same.alias("same"), F.when(same.isNull(), F.col("f")).alias("f"), F.when(same.isNull(), F.col("g")).alias("g")), "checked")
    counted = same_counts(checked.where(F.col("same").isNull()), ["keep_id", *on], "f", "g")
    all_checked = checked.where(F.col("same").isNotNull()).select("keep_id", *on, "same").unionByName(counted)
    all_checked = scratch.write(all_checked, "verified")
    return all_checked.where("same").select("keep_id", "id"), all_checked.where(~F.col("same")).select(*on)


def collapse(df: DataFrame, key: str, text: str) -> DataFrame:
    """keep_id, n_copies: one row a message that has copies, with the number of rows it stands for."""
    found = copies(df, key, text)
    return found.groupBy("keep_id").agg((F.count(F.lit(1)) + 1).alias("n_copies"))


def collapsed(df: DataFrame, key: str, text: str) -> DataFrame:
    """<key>, n_copies: every message once, with the number of messages it stands for, 1 where it has no copies.

    Null and wordless texts stand for themselves. A repeated row is the same
    message; rows without a key stay as they are.
    """
    scratch = Scratch(df.sparkSession, "collapsed")
    found = scratch.write(copies(df, key, text), "found")
    often = found.groupBy("keep_id").agg((F.count(F.lit(1)) + 1).alias("n"))
    gone = found.select(F.col(key).alias("id")).join(often.select(F.col("keep_id").alias("id")), "id", "left_anti").distinct()
    rows = df.select(F.col(key).alias("id"))
    kept = rows.where(F.col("id").isNotNull()).distinct().join(gone, "id", "left_anti")
    kept = kept.join(often.select(F.col("keep_id").alias("id"), "n"), "id", "left").unionByName(rows.where(F.col("id").isNull()).withColumn("n", F.lit(1).cast("long")))
    return kept.select(F.col("id").alias(key), F.coalesce("n", F.lit(1).cast("long")).alias("n_copies"))
