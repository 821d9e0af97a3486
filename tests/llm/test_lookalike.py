import random

import pytest

from tapesh.llm import lookalike as L

SAME = [
    ("Hello world", "Ｈｅｌｌｏ ｗorld"), ("café", "café"), ("Moscow", "Mоѕcоw"), ("fine flow", "ﬁne ﬂow"),
    ("آب", "آب"), ("سلام", "س​ل⁠ام"), ("سلام", "سﻻم"),
    ("كتاب علي", "کتاب علی"), ("١٢٣", "۱۲۳"), ("a b", "a b"), ("a b", "a　b"),
    ("ok", "o­k﻿"), ("No", "Νο"), ("⚡", "⚡️"), ("ë", "ё"),
]
OTHER = [
    ("Hello", "hello"), ("cafe", "café"), ("می‌شود", "میشود"), ("a b", "a  b"), ("a b", "a\nb"), ("a b", "a\tb"), ("a.", "a"),
    ("۴", "٤"), ("\U0001f468‍\U0001f469", "\U0001f468\U0001f469"), ("a²", "a2"), ("1", "l"),
]


@pytest.mark.parametrize("size", [0, 50])
def test_forms(size):
    words = [(w, i + 1) for i, w in enumerate(sorted({w for pair in SAME + OTHER for t in pair for w in t.split()}))][:size]
    canonical = L.canonizer(words)
    for a, b in SAME:
        assert canonical(a) == canonical(b), (a, b)
    for a, b in OTHER:
        assert canonical(a) != canonical(b), (a, b)
    assert canonical("") == ""


def test_the_vocabulary_gives_the_spelling():
    canonical = L.canonizer([("كتاب", 9), ("کتاب", 2), ("x", 1)])
    assert canonical("کتاب") == canonical("\u06a9\u200b\u062a\u0627\u0628") == "كتاب"
    assert canonical("علي") == "علی"


def test_weighted_edits():
    trie = L.Trie([("book", 5), ("boot", 9), ("cat", 1)], L.Look())
    assert trie.find("b\u043eok") == "book"
    assert trie.find("boox") is None
    assert trie.find("boox", 1) == "boot"
    assert trie.find("bok", 1) == "book"
    assert trie.find("books", 1) == "book"
    assert trie.find("xyz", 2) is None


def test_pairs(spark):
    texts = ["abc", "ａbc", "abc", "abd", None, "", "а" * 3000, "a" * 3000, "​", "خ ي", "خ ی"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "abc", 1, "x"), (1, "\uff41bc", 1, "x")]
    df = spark.createDataFrame(rows, "post_id bigint, txt string, c1 int, r string")
    got = sorted(tuple(r) for r in L.look_alike_pairs(df, "post_id", "txt").collect())
    assert got == [(0, 1), (1, 2), (5, 8), (6, 7), (9, 10)]
    assert L.look_alike_pairs(df.limit(0), "post_id", "txt").count() == 0


def test_canonical_text_is_stable(spark):
    df = spark.createDataFrame([(1, "\uff48\uff49 there"), (2, None)], "i int, t string")
    out = {r["i"]: r["c"] for r in L.canonical_text(df, "t", "c").collect()}
    assert out == {1: "hi there", 2: None}


def test_random_disguises_are_undone():
    rng = random.Random(1)
    back = {}
    for a, b in L.LOOK_ALIKES.items():
        back.setdefault(b, []).append(a)
    canonical = L.canonizer([("hello", 3), ("Xavier", 2)])
    for _ in range(300):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCXYی۱") for _ in range(rng.randrange(1, 12)))
        other = "".join(rng.choice(back.get(c, [c])) + rng.choice(["", "", "\u200b", "\u2060"]) for c in word)
        assert canonical(word) == canonical(other)


def test_the_table_of_confusables(spark):
    table = L.confusables(spark)
    for a, b in zip("αρυᎪ", "apuA", strict=True):
        assert L.units_of(a, table) == L.units_of(b, table), (a, b)
    assert L.units_of("κ", table) == L.units_of("к", table)
    assert table.items() >= L.LOOK_ALIKES.items()
    for same in ("σο", "ıi", "Il", "O0", "aA"):
        assert L.units_of(same[0], table) != L.units_of(same[1], table)
    for a, b in (("𝐀", "A"), ("ⅼ", "l"), ("Ⅷ", "VIII"), ("ɡ", "g")):
        assert L.units_of(a) == b


def test_every_word_is_in_the_vocabulary(spark):
    """Spellings come from the whole column, dealt to many shards, broadcast or joined."""
    rows = [(i, f"w{i}ي كتاب{i}") for i in range(300)] + [(300 + i, f"w{i}ی\xa0 کتاب{i}") for i in range(300)] + [(600 + i, f"w{i}ي {'ي' * 101}") for i in range(5)] + [(700, None), (701, "")]
    df = spark.createDataFrame(rows, "i int, t string")
    one = {r["i"]: r["c"] for r in L.canonical_text(df, "t", "c").collect()}
    assert one == {r["i"]: r["c"] for r in L.canonical_text(df, "t", "c", words_per_task=20).collect()}
    assert one == {r["i"]: r["c"] for r in L.canonical_text(df, "t", "c", most=0, words_per_task=20).collect()}
    assert one[0] == one[300].replace("  ", " ") and one[300].startswith("w0ي") and one[700] is None and one[701] == ""
    assert one[600] == f"w0ي {'ي' * 101}"


def test_the_trie_finds_what_the_table_would_not():
    """The spelling comes from the walk: without the word the table decides."""
    with_word, without = L.canonizer([("علي", 3)]), L.canonizer([])
    assert with_word("عل\u200bی") == "علي" and without("عل\u200bی") == "علی"


def test_long_tokens_and_shared_beginnings():
    words = ["a" * 200_000, "ab" * 5_000, "ab" * 5_000 + "c", "ab", "abc", "a"]
    trie = L.Trie([(w, 1) for w in words], L.Look())
    for w in words:
        assert trie.find(w.replace("a", "\u0430")) == w
    assert trie.find("ab" * 4_000) is None


def test_classes(spark):
    df = spark.createDataFrame([(i, "abc" if i % 2 else "\u0430bc") for i in range(60)] + [(100, "xyz"), (101, "xyz")], "post_id bigint, t string")
    members = L.look_classes(df, "post_id", "t").collect()
    assert {(r["class_id"], r["n"]) for r in members} == {(0, 60)} and len(members) == 60
    assert L.look_alike_pairs(df, "post_id", "t").count() == 900
