"""Faults that were found in earlier rounds: clashing names, hot ids, long keys, quoting."""

from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

from daylake.llm import common
from daylake.llm.common import held_out, read_table
from daylake.llm.contamination import drop_contaminated
from daylake.llm.labelled import labelled_sample
from daylake.llm.language import fit_language_model, keep_identified
from daylake.llm.secrets import find_secrets, is_secret
from daylake.llm.simhash import drop_near_duplicates
from daylake.llm.toxicity import beside, build_automaton, fit_toxicity_model, score_toxicity

SF = "/root/testdata/sf0.1"


def _clashing(spark):
    common.ship_package(spark)
    text = "the cat sat on the mat and the dog ran off to see the world again today"
    rows = [(1, text, 7, 8, 9, "a"), (2, text, 7, 8, 9, "b"), (2, text, 7, 8, 9, "b"), (3, "other words here now", 1, 1, 1, "c")]
    rows += [(None, "no id at all but words", 1, 1, 1, "d"), (4, None, 1, 1, 1, "e"), (3, "not alike in any way", 1, 1, 1, "f")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, _kept_hash long, _bad_hash long, _bad_id long, _text_hash string"
    )


@pytest.mark.parametrize("sent", [0, 1000])
def test_helper_columns_may_have_any_name_and_both_joins_agree(spark, sent):
    docs = _clashing(spark)
    kept = drop_near_duplicates(docs, sent_rows=sent)
    assert kept.columns == docs.columns
    got = sorted([(r.doc_id, r._text_hash) for r in kept.collect()], key=repr)
    assert got == sorted([(1, "a"), (3, "c"), (3, "f"), (4, "e"), (None, "d")], key=repr)
    items = spark.createDataFrame([(1, "sat on the mat and the dog")], "item_id long, text string")
    clean = drop_contaminated(docs, items, sent_rows=sent)
    assert clean.columns == docs.columns
    assert sorted(r._text_hash for r in clean.collect()) == ["c", "d", "e", "f"]


def test_texts_are_not_shuffled_to_drop_a_few(spark):
    plan = drop_near_duplicates(_clashing(spark).where("doc_id <> 2"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_sample_is_bounded_in_rows(spark):
    docs = spark.range(50_000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.union(spark.range(6, 40).select("id", F.lit("same")))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    sample = labelled_sample(docs, labels, "toxic", rows=100, modulus=1000, remainder=999, rows_per_id=3).collect()
    assert sum(r.doc_id == 5 for r in sample) == 3 and len(sample) == 3 + 34


def _random(rng, letters, n):
    return "".join(rng.choices(letters, k=n))


def test_a_placeholder_suppresses_its_neighbourhood_only():
    rng = random.Random(4)
    signs = string.ascii_letters + string.digits
    key = _random(rng, signs, 200) + "xxxx" + _random(rng, signs, 200)
    assert is_secret(key)
    assert not is_secret("wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY")
    assert not is_secret("xxxx" + _random(rng, signs, 16) + "xxxx")
    assert ("entropy", 4, 4 + len(key)) in find_secrets(f"see {key} there")


def test_random_letters_are_keys_and_names_are_not():
    rng = random.Random(4)
    found = sum(is_secret(_random(rng, string.ascii_letters, 32)) for _ in range(400))
    assert found > 340
    for name in ("AbstractSingletonProxyFactoryBean", "someVeryLongCamelCaseNameOfAThing", "snake_case_names_of_many_words", "Donaudampfschifffahrtsgesellschaft"):
        assert not is_secret(name)


def test_two_models_give_two_results(spark):
    common.ship_package(spark)
    docs = spark.createDataFrame(
        [(1, "the house and the garden", None, 1.0), (2, "das haus und der garten", "xx", 2.0), (3, "123", "en", 3.0), (4, None, "en", 4.0)],
        "doc_id long, text string, lang string, score double",
    )
    learnt = [("en", "the house and the garden are there " * 9), ("de", "das haus und der garten sind da " * 9)]
    frame = lambda rows: spark.createDataFrame([(9, t, x) for x, t in rows], "doc_id long, text string, lang string")
    swapped = [("de", learnt[0][1]), ("en", learnt[1][1])]
    for rows, want in ((learnt, {1: "en", 2: "de"}), (swapped, {1: "de", 2: "en"})):
        kept = keep_identified(docs, fit_language_model(frame(rows)))
        assert kept.columns == docs.columns
        assert {r.doc_id: r.lang for r in kept.collect()} == want


def test_terms_that_are_exact_have_no_errors():
    automaton = build_automaton(["clowns", "stupid"], [], exact=frozenset(["clowns"]))
    assert set(automaton.symbols) == set("clownstupid")
    from daylake.llm.toxicity import Scanner

    hits = [(w, k) for _, w, k, _ in Scanner(automaton, frozenset()).hits(["clowns clowms stupid stupld"])]
    assert hits == [("clowns", 1), ("stupid", 1), ("stupld", 3)]


def test_terms_beside_other_words():
    words = ["xdiot", "stupd", "clownss", "losre", "cl0wm"]
    assert beside(["idiot", "stupid", "clown", "clowns", "loser"], words) == {"idiot", "stupid", "clowns", "clown"}


def test_toxicity_by_class_and_quotation(spark):
    common.ship_package(spark)
    docs, labels = read_table(spark, SF, "documents").select("doc_id", "text"), read_table(spark, SF, "labels")
    model = fit_toxicity_model(docs, labels)
    scored = score_toxicity(docs, model).where(held_out(5, 0)).join(labels, "doc_id").where("toxic is not null")
    right = (F.col("score") >= 0.5) == (F.col("toxic") == 1)
    share = {r.toxic: r.right for r in scored.groupBy("toxic").agg(F.avg(right.cast("int")).alias("right")).collect()}
    assert share[1] >= 0.88 and share[0] >= 0.99
    texts = ["you clown", 'he said "you clown"', "you clowm", "nothing of the kind"]
    shown = score_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    plain, quoted, misspelt, none = [r.score for r in shown.orderBy("doc_id").collect()]
    assert plain > 0.5 > quoted and misspelt > 0.5 > none
