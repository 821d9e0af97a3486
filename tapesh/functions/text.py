"""Text functions as column expressions.

Patterns keep to what Java and RE2 read alike, so that SQL can check them:
blanks and words are spelt out as classes, since \\s and \\w differ between
engines. Null in, null out, unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blanks, words, emoji.
BLANKS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S, NS, W = f"[{BLANKS}]", f"[^{BLANKS}]", r"[\p{L}\p{N}_]"
_EMOJI_CLASS = r"[\x{1f1e6}-\x{1f1ff}\x{1f300}-\x{1faff}\x{2300}-\x{23ff}\x{2600}-\x{27bf}\x{2b05}-\x{2b55}\x{fe0f}\x{20e3}]"
EMOJI = rf"(?:{_EMOJI_CLASS}\x{{200d}}?)+"
URL = rf"https?://{NS}+|www\.{NS}+"
LONG_URL = rf"https?://{NS}+|www\.{NS}+|t\.me/{NS}+|twitter\.com/{NS}+|x\.com/{NS}+"
#: Runs between words: blanks and what is neither letter nor digit.
BETWEEN = r"[^\p{L}\p{N}_\x{0622}-\x{06cc}]+"
PERSIAN_DIGITS, ARABIC_DIGITS = "۰۱۲۳۴۵۶۷۸۹", "٠١٢٣٤٥٦٧٨٩"
# Persian function words that make no keyword.
STOP_WORDS = (
    "و", "در", "به", "از", "که", "این", "آن", "برای", "با", "را", "می", "است", "شد", "شود", "کرد", "کرده", "ها", "های", "یک", "تا",
    "اما", "اگر", "یا", "هم", "بر", "نه", "دیگر", "روی", "پس", "قبل", "بعد", "هر", "چه", "چرا", "چطور",
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{S}+|{S}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{S}+", " "))


def clean_text(c: Column) -> Column:
    """Without links, mentions, tags and emoji; the zero-width non-joiner becomes a blank. Null gives ''."""
    for pattern in (URL, f"[@#]{NS}+", EMOJI):
        c = F.regexp_replace(c, pattern, "")
    return F.coalesce(F.trim(F.regexp_replace(c, rf"[{BLANKS}\x{{200c}}]+", " ")), F.lit(""))


def normalize_text(c: Column) -> Column:
    """Persian letters for Arabic ones, words and blanks only."""
    c = F.translate(c, "يك", "یک")
    for pattern in (URL, f"[@#]{NS}+", BETWEEN):
        c = F.regexp_replace(c, pattern, " ")
    return F.trim(c)


def clean_message(c: Column) -> Column:
    """Without links, mentions and characters beyond the basic plane, for a verifier's prompt."""
    c = F.regexp_replace(F.regexp_replace(c, LONG_URL, " "), f"@{W}+", " ")
    return squeeze(F.regexp_replace(c, r"[\x{10000}-\x{10ffff}]", ""))


def digits_to_ascii(c: Column) -> Column:
    return F.translate(c, PERSIAN_DIGITS + ARABIC_DIGITS, "0123456789" * 2)


def tokens(normalized: Column) -> Column:
    """Words of more than two characters that are no stop words."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(F.split(normalized, " "), lambda x: (F.length(x) > 2) & ~F.array_contains(stop, x))


def bigrams(words: Column) -> Column:
    """Adjacent pairs of an array of words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda x: x.isNotNull())


def terms(words: Column) -> Column:
    return F.concat(words, bigrams(words))


def entity_set(c: Column) -> Column:
    """Names of a comma-joined string; null, blank and 'None' give an empty array."""
    names = F.filter(F.transform(F.split(c, "[،,]"), strip), lambda x: x != "")
    nothing = F.array().cast("array<string>")
    return F.when(c.isNull() | strip(c).isin("", "None"), nothing).otherwise(F.array_distinct(names))


def join_entities(c: Column) -> Column:
    """Sorted distinct names joined by the Arabic comma, null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(c)), "، "), F.lit(""))


def word_chunks(c: Column, size: int = 200) -> Column:
    """Pieces of so many words; a blank text gives a single ' '."""
    words = F.filter(F.split(squeeze(c), " "), lambda x: x != "")
    n = F.size(words)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(size)), lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.coalesce(n, F.lit(0)) > 0, cut).otherwise(F.array(F.lit(" ")))


def numbered(messages: Column) -> Column:
    """'[i] text' lines, from 1."""
    return F.array_join(F.transform(messages, lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x)), "\n")


def joined_with_note(messages: Column, most: int = 10) -> Column:
    """The first messages, and how many more there are."""
    more = F.size(messages) - most
    return F.concat(F.array_join(F.slice(messages, 1, most), " | "), F.when(more > 0, F.concat(F.lit(" | ... ("), more.cast("string"), F.lit(" more message(s))"))).otherwise(""))


def compact_date(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit(""))


def sample_json(messages: Column, most: int = 10) -> Column:
    """{"messages": [...]} of the first messages, characters as they are."""
    return F.to_json(F.struct(F.slice(F.coalesce(messages, F.array().cast("array<string>")), 1, most).alias("messages")))


REPLY_FIELDS = "is_event boolean, title string, summary string, confidence string"


def parse_reply(reply: Column) -> Column:
    """struct<parsed, is_event, title, summary, confidence> of a model's reply.

    A missing opening brace is put first; the text from the first brace to
    the last one is read as JSON. Missing fields get 'No title' and the like;
    what cannot be read has parsed false and no event.
    """
    opened = F.when(F.trim(reply).startswith("{"), reply).otherwise(F.concat(F.lit("{"), reply))
    body = F.regexp_extract(opened, r"(?s)\{.*\}", 0)
    v = F.try_parse_json(body)
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    field = lambda name, other: F.when(ok, F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(other)))
    return F.struct(
        ok.alias("parsed"),
        F.coalesce(F.try_variant_get(v, "$.is_event", "boolean"), F.lit(False)).alias("is_event"),
        field("title", "No title").alias("title"),
        field("summary", "No summary").alias("summary"),
        field("confidence", "No confidence").alias("confidence"),
    )
