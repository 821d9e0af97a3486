import pytest

from tapesh.llm import language as L

EN = ["the council said that the road is closed for the winter", "we have been told that the market will open again soon", "nobody from the school has answered our questions so far", "please stay away from the old bridge because of the storm"]
DE = ["der rat sagte dass die straße im winter gesperrt ist", "uns wurde gesagt dass der markt bald wieder geöffnet wird", "niemand von der schule hat bisher unsere fragen beantwortet", "bitte meidet die alte brücke wegen des starken sturms"]
FA = ["شورای شهر گفت که این جاده در زمستان بسته است", "به ما گفته شد که بازار به زودی دوباره باز می‌شود", "هنوز کسی از مدرسه به پرسش‌های ما پاسخ نداده است", "لطفاً به خاطر طوفان از رفتن به پل قدیمی خودداری کنید"]


@pytest.fixture(scope="module")
def model():
    return L.Centroids(EN + DE + FA, ["en"] * 4 + ["de"] * 4 + ["fa"] * 4, k=2)


def langs(text, model):
    return [p["lang"] for p in L.parts_of(text, model)]


def test_parts(model):
    assert langs("The council said that the market is closed because of the storm.", model) == ["en"]
    assert langs("The council said that the market is closed. Niemand hat uns gesagt dass die brücke gesperrt ist.", model) == ["en", "de"]
    assert langs("شورای شهر گفت که پل قدیمی بسته است the road is closed because of the storm", model) == ["fa", "en"]
    assert langs("شورای شهر گفت که جاده Silvholm le Haut در زمستان بسته است. #closed https://the.road/is", model) == ["fa"]
    assert langs("بازار باز است. The old road. جاده در زمستان به خاطر طوفان بسته است.", model) == ["fa"]
    for empty in ("", "  ", "12:30 - 18:45", "🎉🎉", "#tag @you"):
        assert langs(empty, model) == []


def test_parts_cover_the_text(model):
    text = "The council said that the market is closed.\nNiemand hat uns gesagt dass die brücke gesperrt ist!\nxx " * 50
    parts = L.parts_of(text, model)
    assert parts[0]["start"] == 0 and parts[-1]["end"] == len(text)
    assert all(a["end"] == b["start"] for a, b in zip(parts, parts[1:]))
    assert all(0 <= p["confidence"] <= 1 for p in parts)


def test_far_texts_are_rejected(model):
    assert model.classify(L.words_of("zzqx vvkj wwpq xxzv kkqj zzvx"))[0] is None


def test_labels(spark):
    labels = ["fa-IR", "FA", "per", "Persian", " en_GB ", "deu", "Türkçe", "und", "", None, "??", "es"]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    got = [r[0] for r in df.select(L.label_language(df["x"])).collect()]
    assert got == ["fa", "fa", "fa", "fa", "en", "de", "tr", "", "", "", "", "es"]


def test_languages(spark, model):
    en, de = EN[0] + ".", DE[0] + "."
    rows = [(1, en, "en"), (2, en, "DE"), (3, en, None), (4, f"{en} {de}", "eng"), (5, None, "en"), (6, "", None), (7, "1 2 3", None), (8, f"{de} " * 2000, "de-DE"), (2, en, "DE")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, words int")
    out = L.languages(df, "doc_id", "text", "lang", model)
    assert sorted((r["doc_id"], r["lang"]) for r in out.where("is_wrong or n_langs > 1").collect()) == [(2, "en"), (2, "en"), (3, "en"), (4, "de"), (4, "en")]
    assert out.where("doc_id = 8").count() == 1
    assert sorted((r["doc_id"], r["lang"], r["confidence"], r["n_langs"]) for r in out.where("lang is null").collect()) == [(5, None, 0.0, 0), (6, None, 0.0, 0), (7, None, 0.0, 0)]
    assert L.languages(df.limit(0), "doc_id", "text", "lang", model).count() == 0


def test_no_length_counts(model):
    """No word, sentence or text is cut."""
    word = "a" * 41
    assert len(L.grams_of(word)) == 3 * 43 - 5 and len(L.grams_of("b" * 2000)) == 3 * 2002 - 5
    assert L.parts_of("z" * 300_000 + ". " + EN[0], model)[0]["words"] == 12
    long = " ".join(EN * 20_000)
    assert langs(long, model) == ["en"]


def test_batches_score_like_single_parts(model):
    texts = [" ".join(x) for x in (EN[:1], DE[:2], FA[:3], EN[1:3] + DE[1:3])]
    alone = [L.parts_of(t + ".", model) for t in texts]
    together = [[p[2:4] for p in parts] for parts in L.parts_of_all([t + "." for t in texts], model)]
    assert [[(p["lang"], p["confidence"]) for p in parts] for parts in alone] == together


def test_short_sentences(model):
    assert langs("شورای شهر گفت که پل قدیمی بسته است. The market is closed.", model) == ["fa", "en"]
    assert langs("شورای شهر گفت که پل قدیمی بسته است. Silvholm le Haut Ova.", model) == ["fa"]


def test_fit_and_widen(spark):
    samples = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(EN + DE + FA, ["en"] * 4 + ["de"] * 4 + ["fa"] * 4, strict=True))], "i bigint, t string, l string")
    docs = spark.createDataFrame([(1, EN[1] + " and the harbour is quiet.", "EN"), (2, DE[1] + ".", "en"), (3, None, "fa")], "d bigint, t string, l string")
    first = L.fit(samples, "i", "t", "l")
    wide = L.widen(first, docs, "d", "t", "l")
    assert wide.knows("harbour") and not first.knows("harbour")
    assert wide.classify(L.words_of(DE[2]))[0] == "de"
    none = L.fit(samples.limit(0), "i", "t", "l")
    assert L.parts_of("some words of any language at all", none) == []
