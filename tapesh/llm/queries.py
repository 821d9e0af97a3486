"""Queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.llm import bpe, chunks, components, copies, language, lookalike, packing
from tapesh.runtime import Scratch, read


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.link_posts(read(spark, sf_dir, "posts"), read(spark, sf_dir, "post_pairs"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copies(read(spark, sf_dir, "posts"), "post_id", "txtContent")


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once, with the number of its copies."""
    return copies.collapsed(read(spark, sf_dir, "posts"), "post_id", "txtContent")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.look_alike_pairs(read(spark, sf_dir, "posts"), "post_id", "txtContent")


def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its one form."""
    posts = read(spark, sf_dir, "posts").select("post_id", "txtContent")
    return lookalike.canonical_text(posts, "txtContent", "canonical").select("post_id", "canonical")


def p6_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the form of a text's form is itself."""
    once = Scratch(spark, "stable").write(p6_canonical(spark, sf_dir))
    twice = lookalike.canonical_text(once, "canonical", "again")
    return twice.select("post_id", F.col("canonical").eqNullSafe(F.col("again")).alias("stable"))


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.split_texts(read(spark, sf_dir, "posts"), "post_id", "txtContent")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts that the operator cut."""
    return p7_pieces(spark, sf_dir).where("n_pieces > 1").select("post_id").distinct()


def p7_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text put together from its pieces again, and whether limit and overlap are kept."""
    pieces = p7_pieces(spark, sf_dir)
    new = F.expr("substring(piece, n_repeated + 1)")
    parts = pieces.groupBy("post_id").agg(
        F.array_sort(F.collect_list(F.struct("piece_no", new.alias("t")))).alias("l"), F.max(F.length("piece")).alias("longest"), F.max("n_repeated").alias("most")
    )
    whole = F.array_join(F.transform("l", lambda x: x["t"]), "")
    return parts.select("post_id", F.md5(whole).alias("text_md5"), ((F.col("longest") <= 800) & (F.col("most") <= 80)).alias("fits"))


def p8_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text decoded from its ids again."""
    return bpe.decode_texts(p8_ids(spark, sf_dir), "ids").select("doc_id", "text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "ids")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = bpe.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return packing.pack(sizes, "doc_id", "n_tokens")


def p9_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document lies whole in one container or is above the capacity, and all its containers keep theirs."""
    packed = Scratch(spark, "fit").write(p9_containers(spark, sf_dir))
    filled = packed.where(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.sum("part_size").alias("filled"))
    rows = packed.join(filled, "container_id", "left").groupBy("doc_id")
    docs = rows.agg(F.sum("part_size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("filled").alias("filled"))
    whole = (F.col("n") == 1) | ((F.col("size") > packing.CAPACITY) & (F.col("n") == F.ceil(F.col("size") / packing.CAPACITY)))
    return docs.select("doc_id", whole.alias("whole"), (F.coalesce("filled", F.lit(0)) <= packing.CAPACITY).alias("fits"))


def _language_model(spark: SparkSession, sf_dir: str) -> language.Centroids:
    first = language.fit(read(spark, sf_dir, "lang_samples"), "sample_id", "sample_text", "lang")
    return language.widen(first, read(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _language_model(spark, sf_dir)
    return language.languages(read(spark, sf_dir, "documents"), "doc_id", "text", "lang", model)


def p10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's languages with their confidence."""
    return _languages(spark, sf_dir)


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of every document with its language and confidence."""
    model = _language_model(spark, sf_dir)
    parts = language.with_parts(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", model)
    return parts.select("doc_id", F.posexplode("parts").alias("part_no", "p")).select("doc_id", "part_no", "p.*")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _languages(spark, sf_dir).where("is_wrong or n_langs > 1").select("doc_id", "lang")


def p10_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the parts of each document follow one another from its beginning to its end, all with a language and a confidence, if there are any."""
    parts = language.with_parts(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", _language_model(spark, sf_dir))
    ends = F.transform("parts", lambda p: p["end"])
    starts = F.transform("parts", lambda p: p["start"])
    joined = (F.concat(starts, F.array(F.length("text"))) == F.concat(F.array(F.lit(0)), ends)) & F.forall("parts", lambda p: p["lang"].isNotNull() & p["confidence"].between(0, 1))
    return parts.select("doc_id", F.when(F.size("parts") > 0, joined).otherwise(True).alias("covered"))


QUERIES = {
    "p1_found": p1_found, "p5_found": p5_found, "p5_collapsed": p5_collapsed, "p6_found": p6_found, "p6_canonical": p6_canonical, "p6_stable": p6_stable, "p7_found": p7_found, "p7_pieces": p7_pieces,
    "p7_rejoined": p7_rejoined, "p8_ids": p8_ids, "p8_texts": p8_texts, "p9_containers": p9_containers, "p9_fit": p9_fit, "p10_found": p10_found, "p10_languages": p10_languages, "p10_segments": p10_segments, "p10_cover": p10_cover,
}
# Copies by definition: fields of a text sorted, texts compared whole.
_PLAIN = r"regexp_replace(replace(replace(replace(lower(replace({0}, 'İ', 'i')), 'ı', 'i'), 'ς', 'σ'), 'ß', 'ss'), '[\p{{P}}$+<=>^`|~ \t\n\r\f\x0B]+', '', 'g')"
_COPIES = rf"""t AS (SELECT post_id, txtContent AS t, list_filter(string_split_regex(txtContent, '[\n\r|;؛]+'), lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]')) AS parts
  FROM posts WHERE regexp_matches(txtContent, '[\p{{L}}\p{{N}}]')),
f AS (SELECT post_id, CASE WHEN len(parts) >= 2 AND len(list_filter(parts, lambda x: NOT regexp_matches(x, '^[^:：]*\p{{L}}[^:：]*[:：]'))) = 0
  THEN 'F' || array_to_string(list_sort(list_transform(parts, lambda x: {_PLAIN.format("regexp_extract(x, '^([^:：]*)[:：]', 1)")} || chr(1) || {_PLAIN.format("regexp_extract(x, '(?s)^[^:：]*[:：](.*)$', 1)")})), chr(2))
  ELSE 'T' || {_PLAIN.format('t')} END AS k FROM t),
c AS (SELECT post_id, min(post_id) OVER (PARTITION BY k) AS keep_id FROM f)"""
ORACLES = {
    "p5_found": f"WITH {_COPIES} SELECT keep_id, post_id FROM c WHERE post_id <> keep_id",
    "p5_collapsed": f"""WITH {_COPIES} SELECT p.post_id, count(*) AS n_copies FROM posts p JOIN (SELECT coalesce(c.keep_id, q.post_id) AS keep_id FROM posts q LEFT JOIN c ON c.post_id = q.post_id) x
  ON x.keep_id = p.post_id GROUP BY p.post_id""",
    "p6_stable": "SELECT post_id, true AS stable FROM posts",
    "p10_cover": "SELECT doc_id, true AS covered FROM documents",
    "p7_rejoined": "SELECT post_id, md5(txtContent) AS text_md5, true AS fits FROM posts WHERE txtContent IS NOT NULL",
    "p8_texts": "SELECT doc_id, text FROM documents",
    "p9_fit": "SELECT doc_id, true AS whole, true AS fits FROM documents",
    "p7_found": "SELECT post_id FROM posts WHERE length(txtContent) > 800",
    "p1_found": """WITH RECURSIVE v AS (SELECT DISTINCT p.post_a AS a, p.post_b AS b FROM post_pairs p
  JOIN posts x ON x.post_id = p.post_a JOIN posts y ON y.post_id = p.post_b
  WHERE p.post_a <> p.post_b AND contains(x.location_entities, p.shared_location) AND contains(y.location_entities, p.shared_location)),
l AS (SELECT post_id AS a, min(post_id) OVER (PARTITION BY cluster_id) AS b FROM posts WHERE cluster_id IS NOT NULL),
e AS (SELECT a, b FROM v UNION SELECT b, a FROM v UNION SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b),
r AS (SELECT a AS post_id, a AS g FROM e UNION SELECT e.b, r.g FROM r JOIN e ON e.a = r.post_id WHERE r.g < e.b)
SELECT post_id, min(g) AS group_id FROM (SELECT * FROM r UNION ALL SELECT DISTINCT a, a FROM e) GROUP BY post_id""",
}
