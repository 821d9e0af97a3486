"""Queries of the analytics operators, each over whole tables, with the SQL that checks it.

Vectors come from embeddings, joined with documents by id for text and time;
a vector's label stands for its day. Thresholds are those of FIXTURE, chosen
so that results on these vectors are not empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import jalali as J
from tapesh.functions import temporal
from tapesh.functions import text as T
from tapesh.functions import vectors as V
from tapesh.models import interfaces as M
from tapesh.operators import candidates as C
from tapesh.operators import graph as G
from tapesh.operators import keycluster as K
from tapesh.plans import pipelines as P
from tapesh.runtime import Scratch, read, spread
from tapesh.sinks import writers as W
from tapesh.sources import messages as S

FIXTURE = EngineConfig().but(
    similarity=0.30, merge_similarity=0.35, coverage_similarity=0.30, spike_z=1.5, spike_flag_z=1.5, cohesive_ratio=2.0, cohesive_median=0.2,
    cohesive_coverage=0.2, min_ratio=0.7, medoid_noise=0.0, medoid_duplicate=0.30, medoid_merge=0.1, verify_above=2,
)
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def posts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "posts")


def texts(spark: SparkSession, d: str) -> DataFrame:
    """post_id and txtContent, on all cores, since patterns cost more than moving a small table."""
    return spread(posts(spark, d).select("post_id", "txtContent"))


def vec_messages(spark: SparkSession, d: str) -> DataFrame:
    """day, msg_id, text, ts, vec."""
    v, doc = read(spark, d, "embeddings"), read(spark, d, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("label").cast("int"))
    at = v.join(doc.select("doc_id", "text", "posted_at"), v.vec_id == F.col("doc_id"))
    return at.select(day.alias("day"), F.col("vec_id").alias("msg_id"), "text", F.col("posted_at").alias("ts"), F.col("embedding").alias("vec"))


def by_label(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Messages, and a membership of one cluster a day."""
    m = vec_messages(spark, d)
    return m, m.select("day", "msg_id", F.lit(1).cast("long").alias("cluster"))


def epsilon_member(m: DataFrame) -> DataFrame:
    edges = G.similarity_edges(m, "day", "msg_id", "vec", FIXTURE.similarity)
    comp = G.connected_components(edges)
    return m.select("day", "msg_id").join(comp.select(F.col("node").alias("msg_id"), F.col("component").alias("cluster")), "msg_id")


# Parts of the SQL
# Fixed values, written here anew, so that the SQL does not repeat a slip of the library: blanks, words, links, emoji, stop words.
_BLANK = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_OTHER = r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LINK = rf"https?://{_OTHER}+|www\.{_OTHER}+"
_LONG_LINK = rf"{_LINK}|t\.me/{_OTHER}+|twitter\.com/{_OTHER}+|x\.com/{_OTHER}+"
_PICTURE = r"(?:[\x{1f1e6}-\x{1f1ff}\x{1f300}-\x{1faff}\x{2300}-\x{23ff}\x{2600}-\x{27bf}\x{2b05}-\x{2b55}\x{fe0f}\x{20e3}]\x{200d}?)+"
_SIGN = r"[^\p{L}\p{N}_\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0622}-\x{06cc}]"
_STOPS = ", ".join(
    f"'{w}'" for w in "و در به از که این آن برای با را می است شد شود کرد کرده ها های یک تا اما اگر یا هم بر نه دیگر روی پس قبل بعد هر چه چرا چطور".split()
)
VM = """vm AS (SELECT DATE '2024-01-01' + v.label::INTEGER AS day, v.vec_id AS msg_id, d.text, d.posted_at AS ts, v.embedding::DOUBLE[] AS vec
  FROM embeddings v JOIN documents d ON d.doc_id = v.vec_id)"""
EDGES = f"""{VM}, e AS (SELECT a.day, a.msg_id AS src, b.msg_id AS dst, list_cosine_similarity(a.vec, b.vec) AS w FROM vm a JOIN vm b
  ON a.day = b.day AND a.msg_id < b.msg_id WHERE list_cosine_similarity(a.vec, b.vec) >= 0.30)"""
MEMBER = f"""{EDGES}, sym AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach AS (SELECT a AS node, a AS root FROM sym UNION SELECT sym.b, reach.root FROM reach JOIN sym ON sym.a = reach.node WHERE reach.root < sym.b),
member AS (SELECT vm.day, vm.msg_id, c.cluster FROM vm JOIN (SELECT node, min(root) AS cluster FROM reach GROUP BY node) c ON c.node = vm.msg_id)"""


def CENTROID(member: str, out: str) -> str:  # noqa: N802
    return f"""{out} AS (SELECT day, cluster, list(x ORDER BY i) AS centroid FROM (SELECT day, cluster, i, avg(x) AS x FROM (
  SELECT m.day, m.cluster, unnest(vm.vec) AS x, generate_subscripts(vm.vec, 1) AS i FROM {member} m JOIN vm ON vm.msg_id = m.msg_id) GROUP BY ALL) GROUP BY day, cluster)"""


LABEL = f"{VM}, one AS (SELECT day, msg_id, 1::BIGINT AS cluster FROM vm), {CENTROID('one', 'cen')}"


def _norm(c: str) -> str:
    out = f"translate({c}, 'يك', 'یک')"
    for p in (_LINK, f"[@#]{_OTHER}+", _SIGN):
        out = f"regexp_replace({out}, '{p}', ' ', 'g')"
    return f"trim(regexp_replace({out}, '{_BLANK}+', ' ', 'g'))"


def _clean(c: str) -> str:
    out = c
    for p, by in ((_LINK, ""), (f"@{_OTHER}+", ""), (f"#{_OTHER}+", ""), (_PICTURE, ""), (r"\x{200c}", " ")):
        out = f"regexp_replace({out}, '{p}', '{by}', 'g')"
    return f"coalesce(trim(regexp_replace({out}, '{_BLANK}+', ' ', 'g')), '')"


def _tokens(norm: str) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda x: length(x) > 2 AND NOT list_contains([{_STOPS}], x))"


def _pairs(words: str) -> str:
    return f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def _set(c: str) -> str:
    names = f"list_filter(list_transform(string_split(replace({c}, '،', ','), ','), lambda x: {_strip('x')}), lambda x: x <> '')"
    return f"CASE WHEN {c} IS NULL OR {_strip(c)} IN ('', 'None') THEN []::VARCHAR[] ELSE list_distinct({names}) END"


def _jday(y: str, m: str, d: str) -> str:
    """Epoch day of a Jalali date."""
    return f"""(365 * ({y} - 979) + (({y} - 979) // 33) * 8 + ((({y} - 979) % 33) + 3) // 4 +
  CASE WHEN {m} <= 7 THEN 31 * ({m} - 1) ELSE 186 + 30 * ({m} - 7) END + {d} - 1 - 135061)"""


def _jalali(n: str) -> str:
    """CTE-free struct of the Jalali date of n = epoch day + 135061."""
    q0 = f"(({n} % 12053) % 1461)"
    y = f"(979 + 33 * ({n} // 12053) + 4 * (({n} % 12053) // 1461) + CASE WHEN {q0} >= 366 THEN ({q0} - 1) // 365 ELSE 0 END)"
    q = f"(CASE WHEN {q0} >= 366 THEN ({q0} - 1) % 365 ELSE {q0} END)"
    m = f"(CASE WHEN {q} < 186 THEN 1 + {q} // 31 ELSE 7 + ({q} - 186) // 30 END)"
    d = f"(CASE WHEN {q} < 186 THEN 1 + {q} % 31 ELSE 1 + ({q} - 186) % 30 END)"
    return f"{{'y': {y}, 'm': {m}, 'd': {d}}}"


_N = "(date_diff('day', DATE '1970-01-01', {}::DATE) + 135061)"
_FMT = "printf('%04d/%02d/%02d', j.y, j.m, j.d)"
_LEAP = "({} % 33) IN (1, 5, 9, 13, 17, 22, 26, 30)"

# ---- sources, filters and text


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1996-03-01'")
def date_range_scan(spark: SparkSession, d: str) -> DataFrame:
    return S.gregorian_range(read(spark, d, "orders"), "o_orderdate", "1995-03-01", "1996-03-01").select("o_orderkey", "o_totalprice")


@query("SELECT post_id, replace(future_date, '/', '-') AS future_day FROM posts WHERE replace(future_date, '/', '-') >= '1401-01-01' AND replace(future_date, '/', '-') < '1402-07-01'")
def jalali_string_range(spark: SparkSession, d: str) -> DataFrame:
    rows = posts(spark, d).select("post_id", F.replace("future_date", F.lit("/"), F.lit("-")).alias("future_day"))
    return S.jalali_range(rows, "future_day", "1401-01-01", "1402-07-01")


@query(f"SELECT tweet_id, {_strip('''replace(shdate, chr(0), '')''')} AS shdate FROM tweets_2 WHERE txtContent IS NOT NULL AND shdate IS NOT NULL")
def dropna_prepare(spark: SparkSession, d: str) -> DataFrame:
    return S.prepare(read(spark, d, "tweets_2"), EngineConfig(platform="x")).select("tweet_id", "shdate")


def _classified(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(read(spark, d, "documents").select("doc_id", "text", F.col("posted_at").alias("ts")))
    return M.classify(docs, "text", M.rule_classifier())


_CLASS = f"""c AS (SELECT doc_id, posted_at, {_clean('text')} AS clean_text FROM documents),
k AS (SELECT *, CASE WHEN len(list_filter(string_split(clean_text, ' '), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) >= 3 THEN 1 ELSE 0 END AS predicted_class FROM c),
f AS (SELECT *, predicted_class = 1 AND length(clean_text) > 2 AS ok FROM k)"""


@query(f"WITH {_CLASS} SELECT doc_id, predicted_class, ok::INTEGER AS passed FROM f")
def classifier_filter(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select("doc_id", "predicted_class", F.col("passed_filter").cast("int").alias("passed"))


@query(f"WITH {_CLASS} SELECT posted_at::DATE AS day, count(*) AS raw_count, count(*) FILTER (ok) AS kept_count FROM f GROUP BY 1")
def daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.daily_counts(_classified(spark, d))


@query(f"SELECT post_id, {_clean('txtContent')} AS clean_text FROM posts")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("post_id", T.clean_text(F.col("txtContent")).alias("clean_text"))


@query(f"SELECT post_id, {_norm('txtContent')} AS norm FROM posts")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("post_id", T.normalize_text(F.col("txtContent")).alias("norm"))


@query(
    f"""SELECT tweet_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(txtContent, '{_LONG_LINK}', ' ', 'g'), '@[\\p{{L}}\\p{{N}}_]+', ' ', 'g'),
  '[\\x{{10000}}-\\x{{10ffff}}]', '', 'g'), '{_BLANK}+', ' ', 'g')) AS message FROM (SELECT DISTINCT tweet_id, txtContent FROM tweets_2)"""
)
def clean_message(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "tweets_2").select("tweet_id", "txtContent").distinct()
    return rows.select("tweet_id", T.clean_message(F.col("txtContent")).alias("message"))


@query(f"SELECT post_id, array_to_string(list_sort({_set('location_entities')}), '|') AS names, len({_set('location_entities')}) AS n FROM posts")
def entity_set_split(spark: SparkSession, d: str) -> DataFrame:
    names = T.entity_set(F.col("location_entities"))
    return posts(spark, d).select("post_id", F.array_join(F.array_sort(names), "|").alias("names"), F.size(names).cast("long").alias("n"))


@query(f"SELECT post_id, array_to_string({_tokens(_norm('txtContent'))}, '|') AS words FROM posts WHERE txtContent IS NOT NULL")
def token_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = texts(spark, d).where(F.col("txtContent").isNotNull())
    return rows.select("post_id", F.array_join(T.tokens(T.normalize_text(F.col("txtContent"))), "|").alias("words"))


@query(f"WITH w AS (SELECT post_id, {_tokens(_norm('txtContent'))} AS w FROM posts WHERE txtContent IS NOT NULL) SELECT post_id, array_to_string({_pairs('w')}, '|') AS pairs FROM w")
def bigrams(spark: SparkSession, d: str) -> DataFrame:
    rows = texts(spark, d).where(F.col("txtContent").isNotNull()).select("post_id", T.tokens(T.normalize_text(F.col("txtContent"))).alias("w"))
    return rows.select("post_id", F.array_join(T.bigrams(F.col("w")), "|").alias("pairs"))


_TERMS = f"""w AS (SELECT channel_id, {_tokens(_norm('txtContent'))} AS w FROM posts),
t AS (SELECT channel_id, unnest(list_concat(w, {_pairs('w')})) AS term FROM w)"""


@query(f"WITH {_TERMS} SELECT channel_id, term, count(*) AS freq FROM t GROUP BY ALL HAVING count(*) >= 2")
def term_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.term_counts(spread(posts(spark, d).select("channel_id", "txtContent")), ["channel_id"], "txtContent")


@query(
    f"""WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(coalesce(text, ''), '{_BLANK}+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(0, greatest(len(w), 1), 200)) AS k FROM w)
SELECT doc_id, k // 200 + 1 AS chunk_no, CASE WHEN len(w) = 0 THEN ' ' ELSE array_to_string(w[k + 1 : k + 200], ' ') END AS chunk FROM c"""
)
def word_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", F.posexplode(T.word_chunks(F.col("text"))).alias("p", "chunk"))
    return rows.select("doc_id", (F.col("p") + 1).cast("long").alias("chunk_no"), "chunk")


@query("SELECT post_id, translate(txtContent, '۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩', '01234567890123456789') AS ascii FROM posts")
def digits_to_ascii(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("post_id", T.digits_to_ascii(F.col("txtContent")).alias("ascii"))


# ---- calendar


@query(f"WITH t AS (SELECT o_orderkey, {_jalali(_N.format('o_orderdate'))} AS j FROM orders) SELECT o_orderkey, {_FMT} AS jalali FROM t")
def gregorian_to_jalali(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", J.format_jalali(J.to_jalali(F.col("o_orderdate"))).alias("jalali"))


_PARTS = "p AS (SELECT post_id, TRY_CAST(split_part(future_date, '/', 1) AS INTEGER) AS y, TRY_CAST(split_part(future_date, '/', 2) AS INTEGER) AS m, TRY_CAST(split_part(future_date, '/', 3) AS INTEGER) AS d FROM posts)"
_VALID = f"m BETWEEN 1 AND 12 AND d BETWEEN 1 AND CASE WHEN m <= 6 THEN 31 WHEN m <= 11 THEN 30 WHEN {_LEAP.format('y')} THEN 30 ELSE 29 END"


@query(f"WITH {_PARTS} SELECT post_id, CASE WHEN {_VALID} THEN DATE '1970-01-01' + ({_jday('y', 'm', 'd')})::INTEGER END AS day FROM p")
def jalali_to_gregorian(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("post_id", J.parse_jalali(F.col("future_date")).alias("day"))


@query(
    f"""WITH t AS (SELECT o_orderkey, {_jalali(_N.format('o_orderdate'))} AS j, (o_orderkey % 40 - 20)::INTEGER AS k FROM orders),
u AS (SELECT o_orderkey, j.d AS d0, (j.y * 12 + j.m - 1 + k) // 12 AS y, (j.y * 12 + j.m - 1 + k) % 12 + 1 AS m FROM t)
SELECT o_orderkey, printf('%04d/%02d/%02d', y, m, least(d0, CASE WHEN m <= 6 THEN 31 WHEN m <= 11 THEN 30 WHEN {_LEAP.format('y')} THEN 30 ELSE 29 END)) AS moved FROM u"""
)
def jalali_add_months(spark: SparkSession, d: str) -> DataFrame:
    moved = J.add_months(J.to_jalali(F.col("o_orderdate")), (F.col("o_orderkey") % 40 - 20).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", J.format_jalali(moved).alias("moved"))


@query("SELECT o_orderkey, (dayofweek(o_orderdate) + 1) % 7 AS weekday FROM orders")
def jalali_weekday(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", J.weekday(F.col("o_orderdate")).cast("long").alias("weekday"))


@query(f"WITH {_PARTS} SELECT post_id, y, ({_LEAP.format('y')})::INTEGER AS leap FROM p WHERE y IS NOT NULL")
def jalali_leap(spark: SparkSession, d: str) -> DataFrame:
    y = F.split_part("future_date", F.lit("/"), F.lit(1)).try_cast("int")
    return posts(spark, d).select("post_id", y.alias("y")).where(F.col("y").isNotNull()).select("post_id", "y", J.is_leap(F.col("y")).cast("int").alias("leap"))


@query(
    f"""WITH {_PARTS}, a AS (SELECT 'posts' AS src, post_id::VARCHAR AS key, CASE WHEN {_VALID} THEN (DATE '1970-01-01' + ({_jday('y', 'm', 'd')})::INTEGER)::TIMESTAMP ELSE TIMESTAMP '1970-01-01' END AS at FROM p)
SELECT * FROM a UNION ALL SELECT 'predicted', id, coalesce(predicted_time, TIMESTAMP '1970-01-01') FROM predicted_events"""
)
def predicted_time_standardize(spark: SparkSession, d: str) -> DataFrame:
    a = posts(spark, d).select(F.lit("posts").alias("src"), F.col("post_id").cast("string").alias("key"), F.col("future_date").alias("t"))
    b = read(spark, d, "predicted_events").select(F.lit("predicted").alias("src"), F.col("id").alias("key"), F.col("predicted_time").cast("string").alias("t"))
    return a.unionByName(b).select("src", "key", J.standard_time(F.col("t")).alias("at"))


@query(
    f"""WITH {_PARTS}, q AS (SELECT p.post_id, {_jday('y', 'm', 'd')} AS day, date_diff('day', DATE '1970-01-01', s.ingested_at::DATE) AS anchor, s.future_date
  FROM p JOIN posts s ON s.post_id = p.post_id WHERE {_VALID}) SELECT post_id, future_date AS found FROM q WHERE day > anchor"""
)
def temporal_exact_dates(spark: SparkSession, d: str) -> DataFrame:
    """The grammar on texts that name a full date."""
    rows = posts(spark, d).select("post_id", F.concat(F.lit("مهلت تا "), "future_date", F.lit(" است")).alias("t"), F.col("ingested_at").cast("date").alias("at"))
    return temporal.future_dates(rows, "t", "at").select("post_id", F.col("future_date").alias("found"))


@query()
def temporal_relative(spark: SparkSession, d: str) -> DataFrame:
    rows = posts(spark, d).select("post_id", "txtContent", F.col("ingested_at").cast("date").alias("at"))
    return temporal.future_dates(rows, "txtContent", "at").select("post_id", "jalali_date", "future_date")


_FA_DAYS = ("شنبه", "یکشنبه", "دوشنبه", "سه شنبه", "چهارشنبه", "پنجشنبه", "جمعه")
_FA_MONTHS = ("فروردین", "اردیبهشت", "خرداد", "تیر", "مرداد", "شهریور", "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند")


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_MOVED = "CASE WHEN {m} <= 6 THEN 31 WHEN {m} <= 11 THEN 30 WHEN {y} % 33 IN (1, 5, 9, 13, 17, 22, 26, 30) THEN 30 ELSE 29 END"
_RULES = f"""q AS (SELECT post_id, post_id % 18 AS r, post_id // 18 % 29 + 1 AS n, post_id // 18 % 12 + 1 AS m, post_id // 18 % 7 AS k,
  date_diff('day', DATE '1970-01-01', ingested_at::DATE) AS a FROM posts WHERE ingested_at IS NOT NULL),
p AS (SELECT *, (a + 5) % 7 AS wd, {_jalali('(a + 135061)')} AS j FROM q),
t AS (SELECT *, j.y + (j.m + 1) // 12 AS y2, (j.m + 1) % 12 + 1 AS m2, j.y + 3 + (j.m + 5) // 12 AS y3, (j.m + 5) % 12 + 1 AS m3,
  least(j.d, {_MOVED.format(m='j.m', y='(j.y + 3)')}) AS d3 FROM p)"""
_SAID = f"""CASE r WHEN 0 THEN n || ' روز دیگر' WHEN 1 THEN n || ' هفته بعد' WHEN 2 THEN n || ' روز پیش' WHEN 3 THEN 'فردا می‌آییم' WHEN 4 THEN 'تا پس فردا صبر کنید'
  WHEN 5 THEN {_list(_FA_DAYS)}[k + 1] || ' آینده' WHEN 6 THEN {_list(_FA_DAYS)}[k + 1] || ' هفته آینده' WHEN 7 THEN 'روز ' || {_list(_FA_DAYS)}[k + 1] || ' می‌آییم'
  WHEN 8 THEN 'هفته آینده' WHEN 9 THEN 'روزهای آینده' WHEN 10 THEN 'از امروز تا فردا' WHEN 11 THEN 'آخر هفته' WHEN 12 THEN n || '/' || m
  WHEN 13 THEN 'در ' || n || ' ' || {_list(_FA_MONTHS)}[m] || ' ماه' WHEN 14 THEN 'اواخر ' || {_list(_FA_MONTHS)}[m] WHEN 15 THEN 'دو ماه دیگر'
  WHEN 16 THEN '3 سال و نیم بعد' ELSE 'بیست و یکم ' || {_list(_FA_MONTHS)}[m] END"""


@query(
    f"""WITH {_RULES} SELECT post_id, CASE r WHEN 0 THEN a + n WHEN 1 THEN a + 7 * n WHEN 2 THEN a - n WHEN 3 THEN a + 1 WHEN 4 THEN a + 2
  WHEN 5 THEN a + k - wd + CASE WHEN k <= wd THEN 7 ELSE 0 END WHEN 6 THEN a + k - wd + CASE WHEN k <= wd THEN 14 ELSE 7 END WHEN 7 THEN a + k - wd
  WHEN 8 THEN a + 7 WHEN 9 THEN a + 2 WHEN 10 THEN a + 1 WHEN 11 THEN a + (12 - wd) % 7 + 1 WHEN 12 THEN {_jday('j.y', 'm', 'n')} WHEN 13 THEN {_jday('j.y', 'm', 'n')}
  WHEN 14 THEN {_jday('j.y', 'm', '25')} WHEN 15 THEN {_jday('y2', 'm2', f"least(j.d, {_MOVED.format(m='m2', y='y2')})")}
  WHEN 16 THEN {_jday('y3', 'm3', f"least(d3, {_MOVED.format(m='m3', y='y3')})")} ELSE {_jday('j.y', 'm', '21')} END AS day,
  CASE r WHEN 3 THEN 'relative_word' WHEN 4 THEN 'relative_word' WHEN 10 THEN 'relative_word' WHEN 11 THEN 'relative_word' WHEN 7 THEN 'bare_weekday' WHEN 8 THEN 'relative_simple'
  WHEN 9 THEN 'relative_simple' WHEN 12 THEN 'exact_short' WHEN 13 THEN 'exact_full' WHEN 14 THEN 'exact_approx' WHEN 17 THEN 'exact_full' ELSE 'relative_complex' END AS kind FROM t"""
)
def temporal_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of the grammar, on sentences made from the numbers of each post."""
    said = (
        _SAID.replace("//", "DIV").replace("'آخر", "'آخر").replace(_list(_FA_DAYS), "array" + _list(_FA_DAYS).replace("[", "(").replace("]", ")"))
        .replace(_list(_FA_MONTHS), "array" + _list(_FA_MONTHS).replace("[", "(").replace("]", ")")).replace("[k + 1]", "[k]").replace("[m]", "[m - 1]")
    )
    rows = posts(spark, d).where(F.col("ingested_at").isNotNull()).selectExpr("post_id", "post_id % 18 AS r", "post_id div 18 % 29 + 1 AS n", "cast(post_id div 18 % 12 + 1 AS int) AS m", "cast(post_id div 18 % 7 AS int) AS k", "to_date(ingested_at) AS at")
    hit = temporal.temporal_day(F.expr(said), J.epoch_day(F.col("at")))
    return rows.withColumn("h", hit).select("post_id", F.col("h.day").cast("long").alias("day"), "h.kind")


# ---- vectors and candidates


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "embeddings")
    b = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return v.join(b, "vec_id").select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("next")), 6).alias("sim"))


@query(f"WITH {EDGES} SELECT day, src, dst, round(w, 6) AS weight FROM e")
def epsilon_edges(spark: SparkSession, d: str) -> DataFrame:
    e = G.similarity_edges(vec_messages(spark, d), "day", "msg_id", "vec", FIXTURE.similarity)
    return e.select("day", "src", "dst", F.round("weight", 6).alias("weight"))


@query(f"WITH RECURSIVE {MEMBER} SELECT msg_id, cluster FROM member")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    return epsilon_member(vec_messages(spark, d)).select("msg_id", "cluster")


@query(f"WITH {LABEL} SELECT day, i AS pos, round(centroid[i], 6) AS x FROM (SELECT day, centroid, unnest(range(1, len(centroid) + 1)) AS i FROM cen)")
def centroid(spark: SparkSession, d: str) -> DataFrame:
    m, member = by_label(spark, d)
    c = V.centroids(m.join(member.select("msg_id", "cluster"), "msg_id"), C.KEYS, "vec")
    return c.select("day", F.posexplode("centroid").alias("p", "x")).select("day", (F.col("p") + 1).cast("long").alias("pos"), F.round("x", 6).alias("x"))


_SIMS = f"{LABEL}, sims AS (SELECT vm.day, vm.msg_id, list_cosine_similarity(vm.vec, cen.centroid) AS sim FROM vm JOIN cen ON cen.day = vm.day)"


@query(f"WITH {_SIMS} SELECT day, count(*) AS n, round(quantile_cont(sim, 0.5), 6) AS median_sim, round(quantile_cont(sim, 0.25), 6) AS p25_sim, round(0.7 * quantile_cont(sim, 0.5) + 0.3 * quantile_cont(sim, 0.25), 6) AS cohesion FROM sims GROUP BY day")
def cohesion(spark: SparkSession, d: str) -> DataFrame:
    c = C.cohesion(C.similarities(*by_label(spark, d)), FIXTURE)
    return c.select("day", "n", *[F.round(x, 6).alias(x) for x in ("median_sim", "p25_sim", "cohesion")])


@query(f"WITH {_SIMS} SELECT day, round(avg(CASE WHEN sim >= 0.30 THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM sims GROUP BY day")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    return C.cohesion(C.similarities(*by_label(spark, d)), FIXTURE).select("day", F.round("coverage", 6).alias("coverage"))


_SPIKE = """h AS (SELECT event_type, ts::DATE AS day, hour(ts) AS h, count(*)::DOUBLE AS c FROM events GROUP BY ALL),
s AS (SELECT event_type, day, sum(c) AS t, sum(c * c) AS q, max(c) AS p FROM h GROUP BY ALL),
z AS (SELECT *, CASE WHEN p < 3 THEN 0.0 ELSE (p - t / 24) / (sqrt(greatest(q / 24 - (t / 24) * (t / 24), 0.0)) + 1.0) END AS z FROM s)"""


@query(f"WITH {_SPIKE} SELECT event_type, day, t::BIGINT AS total, p::BIGINT AS peak, round(z, 6) AS z_score, (z >= 1.5 AND p / t >= 0.20)::INTEGER AS is_spike FROM z")
def hourly_spike(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    s = C.hourly_spike(rows, ["event_type", "day"], "ts", FIXTURE)
    return s.select("event_type", "day", "total", "peak", F.round("z_score", 6).alias("z_score"), F.col("is_spike").cast("int").alias("is_spike"))


@query(
    """WITH q AS (SELECT month(execution_time) AS day, count(*) AS k, quantile_cont(cluster_size, 0.25) AS q1, quantile_cont(cluster_size, 0.75) AS q3 FROM candidate_clusters GROUP BY 1)
SELECT day, CASE WHEN k > 1 THEN round(q3 + 1.5 * (q3 - q1), 6) ELSE 1e18 END AS fence FROM q"""
)
def iqr_fence(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "candidate_clusters").select(F.month("execution_time").cast("long").alias("day"), F.col("cluster_size").alias("n"))
    fence = F.when(F.col("fence") == float("inf"), 1e18).otherwise(F.round("fence", 6))
    return C.iqr_fence(rows).select("day", fence.alias("fence"))


@query(
    """WITH c AS (SELECT ingested_at::DATE AS day, cluster_id, count(*) AS n FROM posts GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY day) AS total FROM c)
SELECT day, cluster_id, n, round(100.0 * n / total, 6) AS ratio FROM t WHERE cluster_id IS NOT NULL"""
)
def daily_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = posts(spark, d).select(F.to_date("ingested_at").alias("day"), "cluster_id")
    clusters = rows.where(F.col("cluster_id").isNotNull()).groupBy("day", "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    out = C.with_ratio(clusters, rows.groupBy("day").agg(F.count(F.lit(1)).alias("day_n")))
    return out.select("day", "cluster_id", "n", F.round("ratio", 6).alias("ratio"))


@query(
    f"""WITH RECURSIVE {MEMBER}, {CENTROID('member', 'cen')},
sims AS (SELECT m.day, m.cluster, m.msg_id, list_cosine_similarity(vm.vec, cen.centroid) AS sim FROM member m JOIN vm ON vm.msg_id = m.msg_id JOIN cen ON cen.cluster = m.cluster),
coh AS (SELECT day, cluster, count(*) AS n, quantile_cont(sim, 0.5) AS med, avg(CASE WHEN sim >= 0.30 THEN 1.0 ELSE 0.0 END) AS cov FROM sims GROUP BY ALL),
h AS (SELECT m.day, m.cluster, hour(vm.ts) AS h, count(*)::DOUBLE AS c FROM member m JOIN vm ON vm.msg_id = m.msg_id GROUP BY ALL),
s AS (SELECT day, cluster, sum(c) AS t, sum(c * c) AS q, max(c) AS p FROM h GROUP BY ALL),
z AS (SELECT day, cluster, CASE WHEN p < 3 THEN 0.0 ELSE (p - t / 24) / (sqrt(greatest(q / 24 - (t / 24) * (t / 24), 0.0)) + 1.0) END AS z FROM s),
f AS (SELECT day, CASE WHEN count(*) > 1 THEN quantile_cont(n, 0.75) + 1.5 * (quantile_cont(n, 0.75) - quantile_cont(n, 0.25)) ELSE 1e300 END AS fence FROM coh GROUP BY day),
d AS (SELECT day, count(*) AS day_n FROM vm GROUP BY day),
r AS (SELECT coh.day, coh.cluster, n, 100.0 * n / day_n AS ratio, z, med, cov, n > fence AS large, z >= 1.5 AS burst,
  100.0 * n / day_n > 2.0 AND med > 0.2 AND cov > 0.2 AS tight FROM coh JOIN z ON z.cluster = coh.cluster JOIN f ON f.day = coh.day JOIN d ON d.day = coh.day)
SELECT day, cluster, n, round(ratio, 6) AS ratio, round(z, 6) AS z_score, round(med, 6) AS median_sim, round(cov, 6) AS coverage,
  array_to_string(list_filter([CASE WHEN large THEN 'dominant' END, CASE WHEN burst THEN 'spike' END, CASE WHEN tight THEN 'cohesive' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM r WHERE (large OR burst OR tight) AND ratio > 0.7"""
)
def candidate_rules(spark: SparkSession, d: str) -> DataFrame:
    m = vec_messages(spark, d)
    out = C.apply_rules(C.statistics(m, epsilon_member(m), FIXTURE), FIXTURE)
    six = [F.round(c, 6).alias(c) for c in ("ratio", "z_score", "median_sim", "coverage")]
    return out.select("day", "cluster", "n", *six, F.array_join("reasons", ",").alias("reasons"))


@query(
    f"""WITH {_SIMS}, r AS (SELECT day, msg_id, count(*) OVER (PARTITION BY day) AS n, row_number() OVER (PARTITION BY day ORDER BY round(sim, 9) DESC, msg_id) AS near,
  row_number() OVER (PARTITION BY day ORDER BY msg_id) AS id FROM sims) SELECT day, msg_id, CASE WHEN n <= 35 THEN id ELSE near END AS rank FROM r WHERE CASE WHEN n <= 35 THEN id ELSE near END <= 35"""
)
def representative_topk(spark: SparkSession, d: str) -> DataFrame:
    return C.representatives(C.similarities(*by_label(spark, d)), FIXTURE).select("day", "msg_id", F.col("rank").cast("long").alias("rank"))


@query(
    f"""WITH {LABEL}, n AS (SELECT day, msg_id, vec, {_norm('text')} AS norm FROM vm), w AS (SELECT day, {_tokens('norm')} AS w FROM n),
t AS (SELECT day, unnest(list_concat(w, {_pairs('w')})) AS term FROM w), f AS (SELECT day, term, count(*) AS freq FROM t GROUP BY ALL HAVING count(*) >= 2),
x AS (SELECT f.day, f.term, f.freq, unnest(n.vec) AS x, generate_subscripts(n.vec, 1) AS i FROM f JOIN n ON n.day = f.day AND contains(n.norm, f.term)),
g AS (SELECT day, term, freq, list(x ORDER BY i) AS v FROM (SELECT day, term, freq, i, avg(x) AS x FROM x GROUP BY ALL) GROUP BY ALL),
s AS (SELECT g.day, term, freq, round(0.7 * list_cosine_similarity(v, centroid) + 0.3 * ln(1 + freq), 6) AS score FROM g JOIN cen ON cen.day = g.day),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, term) AS rank FROM s) SELECT * FROM r WHERE rank <= 10"""
)
def keyword_scores(spark: SparkSession, d: str) -> DataFrame:
    return C.keyword_scores(*by_label(spark, d), FIXTURE).select("day", "term", "freq", "score", F.col("rank").cast("long").alias("rank"))


@query(
    f"""WITH RECURSIVE {MEMBER}, {CENTROID('member', 'cen')}, near AS (SELECT a.cluster AS x, b.cluster AS y FROM cen a JOIN cen b ON a.day = b.day AND a.cluster <> b.cluster
  WHERE list_cosine_similarity(a.centroid, b.centroid) >= 0.35),
up AS (SELECT cluster AS node, cluster AS root FROM cen UNION SELECT near.y, up.root FROM up JOIN near ON near.x = up.node WHERE up.root < near.y)
SELECT m.msg_id, (SELECT min(root) FROM up WHERE up.node = m.cluster) AS cluster FROM member m"""
)
def cluster_merge(spark: SparkSession, d: str) -> DataFrame:
    m = vec_messages(spark, d)
    return C.merge_clusters(m, epsilon_member(m), FIXTURE).select("msg_id", "cluster")


@query()
def leiden(spark: SparkSession, d: str) -> DataFrame:
    m = vec_messages(spark, d)
    return G.communities(G.similarity_edges(m, "day", "msg_id", "vec", FIXTURE.similarity), "day")


@query(
    f"""WITH {EDGES}, s AS (SELECT day, sum(w) AS m, sum(CASE WHEN src % 3 = dst % 3 THEN w ELSE 0 END) AS inside FROM e GROUP BY day),
g AS (SELECT day, c, sum(w) AS d FROM (SELECT day, src % 3 AS c, w FROM e UNION ALL SELECT day, dst % 3, w FROM e) GROUP BY ALL)
SELECT s.day, round(inside / m - q / (4 * m * m), 6) AS modularity FROM s JOIN (SELECT day, sum(d * d) AS q FROM g GROUP BY day) g ON g.day = s.day"""
)
def modularity(spark: SparkSession, d: str) -> DataFrame:
    """Of the partition by the remainder of the id."""
    m = vec_messages(spark, d)
    edges = G.similarity_edges(m, "day", "msg_id", "vec", FIXTURE.similarity)
    member = m.select("day", F.col("msg_id").alias("node"), (F.col("msg_id") % 3).alias("community"))
    return G.modularity(edges, member, "day").select("day", F.round("modularity", 6).alias("modularity"))


@query(f"WITH {EDGES}, n AS (SELECT day, src AS node FROM e UNION SELECT day, dst FROM e) SELECT day, count(*) AS n_nodes, true AS no_worse FROM n GROUP BY day")
def leiden_quality(spark: SparkSession, d: str) -> DataFrame:
    """Every node is in one community, and the modularity is at least that of whole components."""
    edges = Scratch(spark, "quality").write(G.similarity_edges(vec_messages(spark, d), "day", "msg_id", "vec", FIXTURE.similarity))
    found = Scratch(spark, "quality").write(G.communities(edges, "day"))
    comps = found.join(G.connected_components(edges), "node").select("day", "node", F.col("component").alias("community"))
    both = G.modularity(edges, found, "day").join(G.modularity(edges, comps, "day").withColumnRenamed("modularity", "plain"), "day")
    nodes = found.groupBy("day").agg(F.count("node").alias("n_nodes"))
    return both.join(nodes, "day").select("day", "n_nodes", (F.col("modularity") >= F.col("plain") - 1e-9).alias("no_worse"))


# ---- key clusters

_ROWS = f"""rw AS (SELECT * FROM (SELECT post_id AS row_id, future_date, {_set('location_entities')} AS ls, {_set('event_entities')} AS es FROM posts
  WHERE future_date IS NOT NULL AND future_date <> 'None') WHERE len(ls) > 0 OR len(es) > 0)"""
_KEYED = {
    1: "list_reduce(list_transform(ls, lambda a: list_transform(es, lambda b: a || chr(1) || b)), lambda a, b: list_concat(a, b), []::VARCHAR[])",
    2: "ls",
    3: "es",
}


def _tier(k: int, rows: str) -> str:
    return f"""k{k} AS (SELECT row_id, future_date, unnest({_KEYED[k]}) AS k FROM {rows}),
s{k} AS (SELECT row_id AS a, min(row_id) OVER (PARTITION BY future_date, k) AS b, count(*) OVER (PARTITION BY future_date, k) AS n FROM k{k}),
y{k} AS (SELECT a, b FROM s{k} WHERE n > 1 AND a <> b UNION SELECT b, a FROM s{k} WHERE n > 1 AND a <> b),
r{k} AS (SELECT a AS node, a AS root FROM y{k} UNION SELECT y{k}.b, r{k}.root FROM r{k} JOIN y{k} ON y{k}.a = r{k}.node WHERE r{k}.root < y{k}.b),
c{k} AS (SELECT node AS row_id, min(root) AS component FROM r{k} GROUP BY node),
w{k} AS (SELECT * FROM {rows} WHERE row_id NOT IN (SELECT row_id FROM c{k}))"""


_T1, _T2, _T3 = f"{_ROWS}, {_tier(1, 'rw')}", f"{_ROWS}, {_tier(1, 'rw')}, {_tier(2, 'w1')}", f"{_ROWS}, {_tier(1, 'rw')}, {_tier(2, 'w1')}, {_tier(3, 'w2')}"


def _of_tier(spark: SparkSession, d: str, k: int) -> DataFrame:
    return K.tiers(K.entity_rows(posts(spark, d), "post_id")).where(F.col("tier") == k)


@query(f"WITH RECURSIVE {_T1} SELECT * FROM c1")
def tier1_components(spark: SparkSession, d: str) -> DataFrame:
    return K.components_by_key(K.entity_rows(posts(spark, d), "post_id"), "LocEvent")


@query(f"WITH RECURSIVE {_T2} SELECT * FROM c2")
def tier2_components(spark: SparkSession, d: str) -> DataFrame:
    return _of_tier(spark, d, 2).select("row_id", "component")


@query(f"WITH RECURSIVE {_T3} SELECT * FROM c3")
def tier3_components(spark: SparkSession, d: str) -> DataFrame:
    return _of_tier(spark, d, 3).select("row_id", "component")


_SOLO = "CASE WHEN len(ls) > 0 AND len(es) > 0 THEN 'LocEvent_Solo' WHEN len(ls) > 0 THEN 'Loc_Solo' ELSE 'Event_Solo' END"


@query(f"WITH RECURSIVE {_T3} SELECT row_id, {_SOLO} AS cluster_type FROM w3")
def solo_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _of_tier(spark, d, 4).select("row_id", "cluster_type")


@query(
    f"""WITH RECURSIVE {_T3}, t AS (SELECT c1.row_id, component, 1 AS tier, 'LocEvent' AS kind FROM c1 UNION ALL SELECT c2.row_id, component, 2, 'Loc' FROM c2
  UNION ALL SELECT c3.row_id, component, 3, 'Event' FROM c3 UNION ALL SELECT row_id, row_id, 4, {_SOLO} FROM w3),
u AS (SELECT t.*, rw.future_date FROM t JOIN rw ON rw.row_id = t.row_id),
n AS (SELECT *, dense_rank() OVER (ORDER BY future_date, tier, component) AS no FROM u)
SELECT row_id, 'Cluster_' || no || '_' || replace(future_date, '/', '') || '_' || kind AS cluster_id FROM n"""
)
def cluster_names(spark: SparkSession, d: str) -> DataFrame:
    return K.name_clusters(K.tiers(K.entity_rows(posts(spark, d), "post_id"))).select("row_id", "cluster_id")


_MED = f"""{VM}, u AS (SELECT day, msg_id, vec, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS uv FROM vm),
t AS (SELECT day, list(x ORDER BY i) AS total FROM (SELECT day, i, sum(x) AS x FROM (SELECT day, unnest(uv) AS x, generate_subscripts(uv, 1) AS i FROM u) GROUP BY ALL) GROUP BY day),
m AS (SELECT day, msg_id AS medoid, vec AS mv, rs FROM (SELECT u.day, u.msg_id, u.vec, round(list_dot_product(uv, total), 9) AS rs,
  row_number() OVER (PARTITION BY u.day ORDER BY round(list_dot_product(uv, total), 9) DESC, u.msg_id) AS rn FROM u JOIN t ON t.day = u.day) WHERE rn = 1),
q AS (SELECT vm.day, vm.msg_id, vm.msg_id = medoid AS own, list_cosine_similarity(vm.vec, mv) AS s FROM vm JOIN m ON m.day = vm.day)"""


def _medoid_rows(spark: SparkSession, d: str) -> DataFrame:
    m = vec_messages(spark, d)
    return m.select(F.col("msg_id").alias("row_id"), F.date_format("day", "yyyy-MM-dd").alias("cluster_id"), F.lit("all").alias("future_date"), "vec")


@query(f"WITH {_MED} SELECT strftime(day, '%Y-%m-%d') AS cluster_id, medoid AS row_id, round(rs, 6) AS row_sum FROM m")
def medoid(spark: SparkSession, d: str) -> DataFrame:
    return V.medoids(_medoid_rows(spark, d), ["cluster_id"], "row_id", "vec").select("cluster_id", "row_id", F.round("row_sum", 6).alias("row_sum"))


@query(f"WITH {_MED} SELECT msg_id AS row_id, CASE WHEN own OR s >= 0.0 THEN strftime(day, '%Y-%m-%d') END AS cluster_id FROM q WHERE own OR s <= 0.30")
def medoid_denoise(spark: SparkSession, d: str) -> DataFrame:
    return K.denoise(_medoid_rows(spark, d), FIXTURE).select("row_id", "cluster_id")


@query(f"WITH {_MED} SELECT strftime(day, '%Y-%m-%d') AS cluster_id, count(*) AS kept FROM q WHERE own OR s <= 0.15 GROUP BY 1")
def medoid_dedupe(spark: SparkSession, d: str) -> DataFrame:
    out = K.denoise(_medoid_rows(spark, d), FIXTURE.but(medoid_noise=-1.0, medoid_duplicate=0.15))
    return out.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("kept"))


@query(
    f"""WITH RECURSIVE {_MED}, near AS (SELECT a.day AS x, b.day AS y FROM m a JOIN m b ON a.day <> b.day WHERE list_cosine_similarity(a.mv, b.mv) >= 0.1),
up AS (SELECT day AS node, day AS root FROM m UNION SELECT near.y, up.root FROM up JOIN near ON near.x = up.node WHERE up.root < near.y),
g AS (SELECT node, min(root) AS root FROM up GROUP BY node) SELECT vm.msg_id AS row_id, strftime(g.root, '%Y-%m-%d') AS cluster_id FROM vm JOIN g ON g.node = vm.day"""
)
def medoid_merge(spark: SparkSession, d: str) -> DataFrame:
    return K.merge_by_medoid(_medoid_rows(spark, d), FIXTURE).select("row_id", "cluster_id")


def _mode(value: str, out: str) -> str:
    return f"""{out} AS (SELECT cluster_id, v AS {out} FROM (SELECT cluster_id, {value} AS v, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, {value}) AS rn
  FROM posts WHERE cluster_id IS NOT NULL AND {value} IS NOT NULL AND {_strip(value)} NOT IN ('', 'None') GROUP BY cluster_id, {value}) WHERE rn = 1)"""


@query(f"WITH {_mode('future_date', 'mode_date')} SELECT * FROM mode_date")
def mode_future_date(spark: SparkSession, d: str) -> DataFrame:
    return K.most_common(posts(spark, d).where(F.col("cluster_id").isNotNull()), "cluster_id", "future_date", "mode_date")


@query(f"WITH {_mode('location_entities', 'mode_place')} SELECT * FROM mode_place")
def mode_location(spark: SparkSession, d: str) -> DataFrame:
    return K.most_common(posts(spark, d).where(F.col("cluster_id").isNotNull()), "cluster_id", "location_entities", "mode_place")


@query(
    f"""WITH {_mode('future_date', 'predicted_time')}, {_mode('location_entities', 'predicted_location')},
z AS (SELECT cluster_id, count(*) AS size FROM posts WHERE cluster_id IS NOT NULL GROUP BY 1 HAVING count(*) > 2)
SELECT z.cluster_id, z.size, least(z.size, 15) AS n_messages, predicted_time, predicted_location FROM z
  LEFT JOIN predicted_time t ON t.cluster_id = z.cluster_id LEFT JOIN predicted_location l ON l.cluster_id = z.cluster_id"""
)
def verify_candidates_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = posts(spark, d).withColumnsRenamed({"post_id": "row_id", "txtContent": "text"})
    out = K.verify_candidates(rows, FIXTURE)
    return out.select("cluster_id", "size", F.size("messages").cast("long").alias("n_messages"), "predicted_time", "predicted_location")


# ---- verification and sinks


@query("SELECT id, total_messages > 5 AND title <> '' AS is_event, CASE WHEN id % 3 = 0 THEN 'No title' ELSE title END AS title, 'No summary' AS summary FROM detected_events WHERE id % 7 <> 0 UNION ALL SELECT id, false, NULL, NULL FROM detected_events WHERE id % 7 = 0")
def llm_json_parse(spark: SparkSession, d: str) -> DataFrame:
    """Replies with and without an opening brace, without a title, and unreadable ones."""
    e = read(spark, d, "detected_events")
    yes = ((F.col("total_messages") > 5) & (F.col("title") != "")).cast("string")
    title = F.when(F.col("id") % 3 != 0, F.concat(F.lit(', "title": "'), F.replace("title", F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise("")
    body = F.concat(F.lit('"is_event": '), yes, title, F.lit("} so it is"))
    reply = F.when(F.col("id") % 7 == 0, "no json here").when(F.col("id") % 2 == 0, body).otherwise(F.concat(F.lit("{"), body))
    return e.select("id", T.parse_reply(reply).alias("r")).select("id", "r.is_event", "r.title", "r.summary")


def _table_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "candidate_clusters")
    messages = F.from_json("sample_messages", "messages array<string>")["messages"]
    flags = [(F.col(x) == 1).alias(x) for x in ("is_large", "has_burst", "is_cohesive")]
    return c.select("id", F.col("id").cast("string").alias("cluster_id"), F.split("keywords", ", ").alias("keywords"), F.col("cluster_size").alias("size"), *flags, messages.alias("messages"), "execution_time")


_MSGS = "json_extract_string(sample_messages, '$.messages[*]')"


@query(f"SELECT id::VARCHAR AS cluster_id, len({_MSGS}) >= 3 AS is_event, least(len({_MSGS}), 10) || ' messages' AS summary FROM candidate_clusters WHERE len({_MSGS}) > 0")
def verified_events(spark: SparkSession, d: str) -> DataFrame:
    return M.verify(_table_candidates(spark, d), "cluster_id", "messages", EngineConfig()).select("cluster_id", "is_event", "summary")


@query("SELECT keywords, is_large, cluster_size, has_burst, is_cohesive, '' AS sentiment_polarity, 'pending' AS validation_status, to_json({'messages': json_extract_string(sample_messages, '$.messages[*]')[1:10]})::VARCHAR AS sample_messages FROM candidate_clusters")
def candidate_sink_rows(spark: SparkSession, d: str) -> DataFrame:
    return W.candidate_rows(_table_candidates(spark, d), F.current_timestamp()).drop("id", "execution_time")


@query(
    """SELECT e.title, coalesce(e.summary, '') AS summary, 'telegram' AS source, c.cluster_size AS total_messages,
  to_json({'messages': json_extract_string(c.sample_messages, '$.messages[*]')[1:10]})::VARCHAR AS sample_messages FROM detected_events e JOIN candidate_clusters c ON c.id = e.cluster_id"""
)
def event_sink_rows(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "detected_events").select(F.col("cluster_id").cast("string").alias("cluster_id"), "title", "summary")
    return W.event_rows(events, _table_candidates(spark, d), F.current_timestamp()).drop("id", "cluster_id", "execution_time")


@query("SELECT c.id, CASE WHEN c.id IN (SELECT cluster_id FROM detected_events) THEN 'confirmed' WHEN coalesce(json_extract_string(c.sample_messages, '$.messages[0]'), '') <> '' THEN 'rejected' ELSE 'pending' END AS validation_status FROM candidate_clusters c")
def status_update(spark: SparkSession, d: str) -> DataFrame:
    confirmed = read(spark, d, "detected_events").select(F.col("cluster_id").alias("id"))
    return W.update_status(read(spark, d, "candidate_clusters"), confirmed).select("id", "validation_status")


@query(
    f"""SELECT CASE WHEN coalesce({_strip('title')}, '') = '' THEN 'N/A' ELSE title END AS title, CASE WHEN coalesce({_strip('summary')}, '') = '' THEN 'N/A' ELSE summary END AS summary,
  coalesce(predicted_time, TIMESTAMP '1970-01-01') AS predicted_time, coalesce(predicted_location, '') AS predicted_location, execution_time, 'telegram' AS source,
  to_json({{'messages': json_extract_string(sample_messages, '$.messages[*]')[1:15]}})::VARCHAR AS sample_messages, created_at FROM predicted_events"""
)
def predicted_event_rows(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "predicted_events").withColumn("predicted_time", F.col("predicted_time").cast("string"))
    e = e.withColumn("messages", F.from_json("sample_messages", "messages array<string>")["messages"])
    return W.predicted_rows(e, F.col("execution_time"), F.col("created_at"))


@query("SELECT day, src, count(*) AS n FROM (SELECT ingested_at::DATE AS day, 'posts' AS src FROM posts UNION ALL SELECT ingested_at::DATE, 'tweets_2' FROM tweets_2) GROUP BY ALL")
def all_days_union(spark: SparkSession, d: str) -> DataFrame:
    part = lambda t: read(spark, d, t).select(F.to_date("ingested_at").alias("day"), F.lit(t).alias("src"))
    return W.combined(part("posts"), part("tweets_2")).groupBy("day", "src").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT post_id, row_number() OVER (ORDER BY ingested_at, post_id) - 1 AS row_no FROM posts")
def stable_order(spark: SparkSession, d: str) -> DataFrame:
    return S.in_order(posts(spark, d).select("ingested_at", "post_id"), "ingested_at", "post_id").select("post_id", "row_no")


@query(
    f"""WITH c AS (SELECT posted_at::DATE AS day, text IS NOT NULL AND length({_clean('text')}) > 2 AS ok FROM documents)
SELECT count(DISTINCT day) + max(CASE WHEN day IS NULL THEN 1 ELSE 0 END) AS days, count(*) AS raw, count_if(ok) AS kept, count_if(NOT ok) AS filtered, (SELECT count(*) FROM candidate_clusters) AS candidates,
  (SELECT count(*) FROM detected_events) AS verified FROM c"""
)
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("msg_id"), "text", F.col("posted_at").alias("ts"))
    counts = P.daily_counts(M.classify(docs, "text", lambda c: F.lit(1)))
    return P.run_totals(counts, read(spark, d, "candidate_clusters"), read(spark, d, "detected_events"))


@query()
def detection_pipeline(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("msg_id"), "text", F.col("posted_at").alias("ts"))
    out = P.detect(docs, EngineConfig())
    return out["candidate_rows"].drop("execution_time")


@query()
def prediction_pipeline(spark: SparkSession, d: str) -> DataFrame:
    rows = posts(spark, d).select(F.col("post_id").alias("msg_id"), F.col("txtContent").alias("text"), F.col("ingested_at").alias("ts"), "location_entities", "event_entities")
    cfg = EngineConfig().but(verify_above=1, medoid_noise=0.0, medoid_duplicate=1.0)
    models = P.Models(generator=M.rule_generator(2))
    return P.predict(rows, cfg, models)["predicted_rows"].drop("execution_time", "created_at")
