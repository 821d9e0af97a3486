import os
import random

import pytest

from tapesh.llm import bpe as B

pytestmark = pytest.mark.skipif(not os.path.exists(B.VOCABULARY_PATH), reason="no vocabulary file")


@pytest.fixture(scope="module")
def ranks():
    return B.load_ranks()


def slow(word, ranks):
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_match_the_plain_algorithm(ranks):
    rng = random.Random(4)
    for _ in range(400):
        word = bytes(rng.choice(b"abcdefgh the \xd8\xb3\xd9\x84aaa") for _ in range(rng.randrange(1, 60)))
        assert B.merge(word, ranks) == slow(word, ranks)


def test_ids_match_a_public_library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    enc = tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    encode = B.encoder(ranks)
    for _ in range(300):
        text = "".join(rng.choice(" ab\n\tc'sdé١سلامthe<|>xyz0👍") for _ in range(rng.randrange(0, 200)))
        assert encode(text) == enc.encode_ordinary(text)
    assert encode("<|endoftext|>") == enc.encode_ordinary("<|endoftext|>")


def test_round_trip_and_long_words(ranks):
    back = {i: t for t, i in ranks.items()}
    for text in ("", "سلام دنیا", "a" * 30_000, "ab" * 9_000 + " x"):
        assert b"".join(back[i] for i in B.encoder(ranks)(text)).decode() == text


def test_columns(spark):
    df = spark.createDataFrame([(1, "hi there", "x"), (2, "", "x"), (3, None, "x"), (1, "hi there", "x")], "doc_id bigint, text string, n_tokens string")
    assert {r["doc_id"]: r["ids"] for r in B.encode_texts(df, "text").collect()} == {1: [5303, 612], 2: [], 3: None}
    assert sorted((r["doc_id"], r["n"]) for r in B.count_tokens(df, "text", "n").collect()) == [(1, 2), (1, 2), (2, 0), (3, None)]
    assert B.encode_texts(df.limit(0), "text").count() == 0


def test_texts_are_decoded_again(spark):
    texts = ["", None, "Hello  world\n", "سلام دنیا", "\U0001f468\u200d\U0001f469", "<|endoftext|>", "a" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = B.decode_texts(B.encode_texts(df, "t", "ids"), "ids", "back").collect()
    assert [r["back"] for r in sorted(out, key=lambda r: r["i"])] == texts
