"""Lexicons whose terms other texts hold as well, and inflected ones."""

from __future__ import annotations

import random

from daylake.llm import common
from daylake.llm.toxicity import FEATURES, _scanner, fit_toxicity_model, score_toxicity

WORDS = [a + b + c for a in ("ba", "ko", "mi", "tu", "re") for b in ("lan", "dor", "ves") for c in ("ta", "ni", "go")]


def _fit(spark, rows):
    """A model from (text, toxic)."""
    common.ship_package(spark)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return fit_toxicity_model(docs, labels, modulus=10_000)


def _filler(rng, n=8):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def _scores(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["score"] for r in score_toxicity(docs, model).orderBy("doc_id").collect()]


def test_terms_of_a_rare_class_stay_when_one_other_text_holds_them(spark):
    rng = random.Random(5)
    rows = [(f"{_filler(rng)} zwuqqer {_filler(rng)}", 1) for _ in range(40)]
    rows += [(f"{_filler(rng)} {_filler(rng)}", 0) for _ in range(600)] + [(f"zwuqqer {_filler(rng)}", 0)]
    model = _fit(spark, rows)
    assert "zwuqqer" in model.terms
    bad, good = _scores(spark, model, [f"{_filler(rng)} zwuqqer", _filler(rng)])
    assert bad > 0.5 > good


def test_noisy_labels_do_not_empty_the_lexicon(spark):
    rng = random.Random(6)
    terms = ["zwuqqer", "fxolpe", "gryzzin"]
    rows = [(f"{_filler(rng)} {rng.choice(terms)} {_filler(rng)}", int(i % 20 > 0)) for i in range(300)]
    rows += [(f"{_filler(rng)} {_filler(rng)}", 0) for _ in range(300)]
    model = _fit(spark, rows)
    found = {*model.terms, *model.stems}
    assert all(any(t.startswith(u) for u in found) for t in terms)
    scores = _scores(spark, model, [*(f"{_filler(rng)} {t} {_filler(rng)}" for t in terms), _filler(rng)])
    assert min(scores[:3]) > 0.5 > scores[3]


def test_terms_that_clean_texts_quote_are_judged_by_their_context(spark):
    rng = random.Random(7)
    rows = [(f"{_filler(rng)} zwuqqer {_filler(rng)}", 1) for _ in range(150)]
    rows += [(f'{_filler(rng)} "zwuqqer" {_filler(rng)}', 0) for _ in range(15)]
    rows += [(f"{_filler(rng)} {_filler(rng)}", 0) for _ in range(300)]
    model = _fit(spark, rows)
    assert "zwuqqer" in model.terms
    plain, quoted = _scores(spark, model, [f"{_filler(rng)} zwuqqer {_filler(rng)}", f'{_filler(rng)} "zwuqqer" {_filler(rng)}'])
    assert plain > 0.5 > quoted


def _inflected(spark, rng, quoted=0):
    forms = [a + b for a in ("zwuqqer", "gryzzin") for b in ("", "s", "ed", "ing")]
    rows = [(f"{_filler(rng)} {rng.choice(forms)} {_filler(rng)}", 1) for _ in range(240)]
    rows += [(f'{_filler(rng)} "{rng.choice(forms)}" {_filler(rng)}', 0) for _ in range(quoted)]
    rows += [(f"{_filler(rng)} {_filler(rng)}", 0) for _ in range(240)]
    return _fit(spark, rows)


def test_misspellings_inside_a_stem_are_found(spark):
    rng = random.Random(8)
    model = _inflected(spark, rng)
    assert model.stems
    wrong = ["zwqqer", "gryzin", "zwuqqrs", "gyzzined"]
    scores = _scores(spark, model, [*(f"{_filler(rng)} {w}" for w in wrong), _filler(rng)])
    assert min(scores[:4]) > 0.5 > scores[4]


def test_quoted_stems_are_told_from_plain_ones(spark):
    rng = random.Random(9)
    model = _inflected(spark, rng)
    assert model.stems
    x = _scanner(model).features(["so zwuqqering now", 'so "zwuqqering" now'])
    at = FEATURES.index("stems"), FEATURES.index("quoted_stems")
    assert x[:, at].tolist() == [[1.0, 0.0], [0.0, 1.0]]
    model = _inflected(spark, rng, quoted=16)
    plain, quoted = _scores(spark, model, [f"{_filler(rng)} zwuqqering now", f'{_filler(rng)} "zwuqqering" now'])
    assert plain > 0.5 > quoted
