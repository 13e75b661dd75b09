"""Labels of unequal training texts, headers, many letters and no labels."""

from __future__ import annotations

import random

import pytest

from daylake.llm import common
from daylake.llm.language import fit_language_model, keep_identified, language_model, predict

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def english(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en' and length(text) > 200").orderBy("doc_id")
    return [r["text"].lower() for r in rows.select("text").limit(190).collect()]


@pytest.mark.parametrize("tiny", ["e", "ea", "eau", "eaust", "in the", "o rato roeu a roupa do rei de roma e a rainha com raiva resolveu remendar"])
def test_a_label_of_one_short_row_does_not_win(english, tiny):
    model = language_model({"en": [t[:150] for t in english[:128]], "xx": [tiny]})
    names, _ = predict(model, [t[:512] for t in english[130:]])
    assert names.count("en") >= len(names) - 1


def test_a_label_of_one_row_is_found(english):
    row = "o rato roeu a roupa do rei de roma e a rainha com raiva resolveu remendar o que o rato tinha estragado na roupa nova que ele vestia"
    model = language_model({"en": [t[:150] for t in english[:128]], "xx": [row]})
    assert predict(model, ["a rainha do rei de roma com a roupa nova que o rato roeu", row])[0] == ["xx", "xx"]


def test_rare_letters_of_a_large_alphabet_count():
    rng = random.Random(4)
    one, two = ([chr(at + i) for i in range(600)] for at in (0x4E00, 0xAC00))
    texts = {k: ["".join(rng.choice(own) for _ in range(150)) for _ in range(60)] for k, own in (("ko", two), ("zh", one))}
    texts["en"] = ["the quick brown fox jumps over the lazy dog"]
    model = language_model(texts)
    assert all(model.symbol[ord(c)] != model.symbol[0x9FA5] for t in texts["zh"] for c in t)
    rarest = {k: sorted(set("".join(texts[k])), key="".join(texts[k]).count)[:80] for k in ("ko", "zh")}
    names, _ = predict(model, ["".join(rarest["zh"]), "".join(rarest["ko"]), "the brown dog"])
    assert names == ["zh", "ko", "en"]


def test_a_narrow_table_parses_like_a_wide_one():
    rng = random.Random(5)
    texts = {k: ["".join(rng.choice("abcdefgh ") for _ in range(400))] for k in "xyz"}
    probe = ["".join(rng.choice("abcdefghi ") for _ in range(rng.randint(1, 700))) for _ in range(60)]
    narrow, wide = (predict(language_model(texts, n), probe) for n in (3, 200))
    assert narrow[0] == wide[0] and narrow[1] == pytest.approx(wide[1])


def test_shared_headers_do_not_make_the_sample(spark, english):
    header = "0123 shared header of one hot source " * 5
    docs = spark.createDataFrame(
        [(i, header + t * 8, "en") for i, t in enumerate(english)]
        + [(1000 + i, f"{i:04} " * 200 + "der hund lief weg", "de") for i in range(20)],
        "doc_id long, text string, lang string",
    )
    model = fit_language_model(docs)
    assert len(model.tables[model.languages.index("en")]) > 5000
    assert len(model.tables[model.languages.index("de")]) > 5


def test_documents_stay_where_no_label_is_known(spark):
    common.ship_package(spark)
    rows = [(1, "some words", None), (2, None, None), (3, "12 - 34", None), (4, "日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in keep_identified(docs, fit_language_model(docs)).collect()) == [1, 4]
