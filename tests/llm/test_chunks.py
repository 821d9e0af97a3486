import math
import random
import time
from collections import Counter

import pytest

from tapesh.llm import chunks as C


def check(text, limit=800, overlap=80):
    out = C.pieces(text, limit, overlap)
    whole = ""
    for k, (a, b, n) in enumerate(out):
        assert b - a <= limit and 0 <= n <= overlap
        assert n == 0 if k == 0 else text[a : a + n] == text[out[k - 1][1] - n : out[k - 1][1]]
        whole += text[a + n : b]
    assert whole == text
    return out


def test_round_trip_of_random_texts():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["word", " ", ". ", "\n", "، ", "x" * 50, "\u00e9", "e\u0301", "\u200c", "\U0001f468\u200d\U0001f469", "! "]) for _ in range(rng.randrange(0, 900)))
        check(text)
        check(text, 100, 20)


@pytest.mark.parametrize("text", ["", "a", "a" * 800, " " * 900, "x" * 5000, "\n" * 3000, "e\u0301" * 2000])
def test_extremes(text):
    out = check(text)
    assert len(out) == 1 if len(text) <= 800 else len(out) > 1


def test_cuts_at_sentences_where_there_are_any():
    text = " ".join(f"This is sentence number {i} of a long text about many things." for i in range(60))
    for a, b, n in check(text)[:-1]:
        assert text[:b].rstrip().endswith(".")
        assert b - a > 300
    for a, _, n in check(text)[1:]:
        assert n == 0 or text[a - 1] == " "


def test_cuts_where_the_topic_changes():
    cats = " ".join("The cat chased the mouse and the cat slept." for _ in range(12))
    tax = " ".join("Parliament raised income tax rates for firms." for _ in range(12))
    text = cats + " " + tax
    assert check(text)[0][1] == len(cats) + 1


def test_very_long_text_is_quick():
    assert len(check("سلام دنیا. " * 20_000)) > 250


def plain_depths(text, spans, block):
    """By definition: blocks summed anew at every gap, peaks found by walking."""
    bags = [Counter(C._TOKEN.findall(text[a:b].lower())) for a, b in spans]
    sims = []
    for i in range(1, len(bags)):
        left, right = sum(bags[max(0, i - block) : i], Counter()), sum(bags[i : i + block], Counter())
        norm = math.sqrt(sum(v * v for v in left.values()) * sum(v * v for v in right.values()))
        sims.append(sum(n * right[w] for w, n in left.items()) / norm if norm else 0.0)
    out = []
    for i, s in enumerate(sims):
        peaks = []
        for side in (sims[i + 1 :], sims[:i][::-1]):
            top = s
            for x in side:
                if x < top:
                    break
                top = x
            peaks.append(top)
        out.append(sum(peaks) - 2 * s)
    return out


def test_depths_are_those_of_the_definition():
    rng = random.Random(4)
    for _ in range(60):
        text = ". ".join(" ".join(rng.choice(["cat", "dog", "sun", "tax", "law", "sea", ""]) for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(1, 40)))
        spans = C.units(text, 60)
        for block in (1, 3):
            assert C.depths(text, spans, block) == pytest.approx(plain_depths(text, spans, block))


@pytest.mark.parametrize("text", ["".join(f"w{i} goes to x{i}. " for i in range(300_000)), "." * 1_000_000 + "x", "x" * 5_000_000, "e" + "\u0301" * 1_000_000, "a b; " * 400_000])
def test_time_grows_as_the_length(text):
    start = time.time()
    check(text)
    assert time.time() - start < 40


def test_marks_stay_with_their_letter_however_many():
    for a, b, n in check("z" * 700 + ("q" + "\u0301" * 30) * 40)[:-1]:
        assert b == len("z" * 700) or (b - 700) % 31 == 0


def test_split_texts(spark):
    df = spark.createDataFrame([(1, "short", 5), (2, "word. " * 400, 5), (3, None, 5), (4, "", 5), (2, "word. " * 400, 5)], "post_id bigint, t string, piece int")
    rows = C.split_texts(df, "post_id", "t").collect()
    assert {r["post_id"] for r in rows} == {1, 2, 4}
    assert [r["piece"] for r in rows if r["post_id"] == 1] == ["short"]
    assert all(len(r["piece"]) <= 800 for r in rows)
    assert C.split_texts(df.limit(0), "post_id", "t").count() == 0
