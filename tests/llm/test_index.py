"""One stored index of the documents serves any test set, in any number of blocks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daylake.llm import common, contamination as operator
from daylake.llm.contamination import build_index, contamination, find_in_index, words_of


def _texts(seed: int, n: int, most: int) -> list[str | None]:
    rng = random.Random(seed)
    texts = [" ".join(rng.choices("abcde", k=rng.randint(0, most))) for _ in range(n)]
    return [*texts, None, "", "...", "É é É a"]


def _brute(docs: list, items: list, size: int) -> dict:
    """Hit places and items of each document, window by window."""
    found = {}
    for doc_id, text in docs:
        words = words_of(text.encode() if text else None)
        hit, names = set(), set()
        for item, raw in items:
            own = words_of(raw.encode() if raw else None)
            n = min(size, len(own))
            for start in range(len(own) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == own[start : start + n]:
                        hit |= set(range(at, at + n))
                        names.add(item)
        found[doc_id] = (len(words), sorted(hit), sorted(names))
    return found


@pytest.mark.parametrize("block_words", [10_000, 7])
def test_one_index_answers_several_test_sets(spark, block_words):
    common.ship_package(spark)
    docs = list(enumerate(_texts(1, 60, 40)))
    index = build_index(
        spark.createDataFrame(docs, "doc_id long, text string")
        .repartition(3)
        .select(F.col("doc_id").alias("row"), "doc_id", "text")
    )
    for seed, size in ((2, 4), (3, 3)):
        items = list(enumerate(_texts(seed, 6, 9)))
        frame = spark.createDataFrame(items, "item_id long, text string")
        got = {
            r.doc_id: (r.n_words, [p for s in r.spans for p in range(s.start, s.stop)], r["items"])
            for r in find_in_index(index, frame, window=size, block_words=block_words).collect()
        }
        assert got == _brute(docs, items, size)


def test_documents_are_read_once_for_any_number_of_blocks(spark, monkeypatch):
    common.ship_package(spark)
    built = []
    monkeypatch.setattr(operator, "build_index", lambda docs: built.append(1) or build_index(docs))
    docs = spark.createDataFrame(list(enumerate(_texts(4, 10, 20))), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(_texts(5, 6, 9))), "item_id long, text string")
    plan = contamination(docs, items, block_words=3)._jdf.queryExecution().executedPlan().toString()
    assert built == [1] and plan.count("FileScan parquet") > 1 and "ExistingRDD" not in plan
