"""Near copies among rows that share ids."""

from __future__ import annotations

from daylake.llm import common
from daylake.llm.simhash import drop_near_duplicates

A = "the cat sat on the mat and the dog ran off into the woods"
B = "prices of copper rose again while traders waited for new figures"
C = "ein alter mann ging langsam durch den regen nach hause"


def _kept(spark, rows):
    common.ship_package(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()), key=str)


def test_different_texts_of_one_id_all_stay(spark):
    assert _kept(spark, [(1, A), (1, B), (2, B), (1, B)]) == sorted([(1, A), (1, B)], key=str)


def test_a_copy_does_not_stay_by_its_ids_other_text(spark):
    assert _kept(spark, [(1, A), (2, A), (2, B)]) == sorted([(1, A), (2, B)], key=str)


def test_rows_without_ids(spark):
    rows = [(None, A), (None, A), (None, B), (3, B), (None, C), (None, None), (None, "")]
    kept = _kept(spark, rows)
    assert len(kept) == 4 and {(None, A), (3, B), (None, C)} <= set(kept)
