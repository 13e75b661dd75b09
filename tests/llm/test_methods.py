"""The methods against brute force, on random and on the given small tables."""

from __future__ import annotations

import random
from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from daylake.llm import common, packing, simhash
from daylake.llm.components import connected_components, local_roots
from daylake.llm.contamination import contamination, contamination_report
from daylake.llm.embeddings import near_vectors
from daylake.llm.language import SuffixAutomaton, language_model, predict
from daylake.llm.quality import FEATURES, statistics
from daylake.llm.boosting import fit_trees
from daylake.llm.queries import QUERIES
from daylake.llm.secrets import best_entropy
from daylake.llm.tokens import WordTokenizer, default_tokenizer
from daylake.llm.toxicity import Scanner, build_automaton

SF = "/root/testdata/sf0.001"


def test_word_tokenizer_equals_the_library():
    encoder = WordTokenizer(default_tokenizer(), max_words=40)
    texts = ["", "  ", "Hello<|endoftext|> x", "ΣΑΣ", "don't we'll 12½", "a\x0bb\x1cc", "İ ŉ", "x" * 900, "日本 's'tx"]
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(pa.array([t.encode() for t in texts] + [None], pa.large_binary()))
        want = [e.ids for e in encoder.full.encode_batch([*texts, ""], add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_without_gaps(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(np.minimum(256, rng.lognormal(3.5 + seed / 2, 1.2, 3000).astype(int) + 1))
    bars = Counter(lengths.tolist())
    plan = packing.packing_plan(dict(bars), 256)
    ranks = np.concatenate([np.arange(bars[n]) for n in sorted(bars)])
    sequence, offset = plan.place(lengths, ranks)
    ends = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist())):
        assert o == ends.get(s, 0)
        ends[s] = o + n
    assert max(ends.values()) <= 256 and len(ends) == plan.sequences
    assert plan.sequences <= 1.02 * -(-lengths.sum() // 256) + 1 or seed == 3


def test_slightly_wasteful_patterns_serve_where_no_piece_is_short():
    lengths, counts = np.unique(np.random.default_rng(1).integers(600, 1500, 20_000), return_counts=True)
    bars = dict(zip(lengths.tolist(), counts.tolist()))
    exact, chosen = packing.packing_plan(bars, 2048, 0), packing.packing_plan(bars, 2048)
    least = packing.least_sequences(bars, 2048)
    assert least <= chosen.sequences < exact.sequences and chosen.sequences <= 1.02 * least


def test_fitted_counts_come_near_the_histogram():
    lengths = np.array([20, 30, 50, 80])
    triples = packing.patterns(lengths, 100, 0)
    bars = np.array([100.0, 10.0, 60.0, 90.0])
    x = packing.fit_counts(triples, bars, 500)
    used = sum(np.bincount(triples[:, k], x, minlength=5)[:4] for k in range(3))
    assert (x >= 0).all() and np.abs(used - bars)[[0, 2, 3]].max() < 2


def test_suffix_automaton_accepts_exactly_the_substrings():
    text = [random.Random(1).randrange(3) for _ in range(60)]
    automaton = SuffixAutomaton(text)
    whole = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 5) + 1)}
    for n in range(1, 6):
        for code in range(3**n):
            word = tuple(code // 3**k % 3 for k in range(n))
            state = 0
            for c in word:
                state = automaton.after[state].get(c) if state is not None else None
            assert (state is not None) == (word in whole)


def test_phrases_equal_a_plain_cross_parsing():
    model = language_model({"a": ["abracadabra banana"], "b": ["the quick brown fox jumps"]})
    texts = ["abra banana cada", "quick fox the jumps q", "zzz abra"]

    def phrases(text, source):
        n, at = 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in source:
                size += 1
            n, at = n + 1, at + size
        return n

    names, _ = predict(model, texts)
    costs = [
        {k: phrases(t + " ", s + "  ") * log2(len(s) + 1) for k, s in (("a", "abracadabra banana"), ("b", "the quick brown fox jumps"))}
        for t in texts
    ]
    assert names == [min(c, key=c.get) for c in costs]


def test_trees_learn_and_traverse():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > -0.1)).astype(float)
    model = fit_trees(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    row = x[5]
    total = model.base
    for f, t, v in zip(model.feature, model.threshold, model.value):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + int(row[f[node]] > t[node])
        total += v[node - len(f)]
    assert model.score(x[5:6])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert len(statistics(b"a b | c\n\nd")) == len(statistics(None)) == len(FEATURES)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    terms, stems = ["idiot", "moron", "morose", "scum"], ["lowei"]
    scanner = Scanner(build_automaton(terms, stems), frozenset())
    rng = random.Random(2)
    words = set()
    for word in [*terms, *stems, "loweiab"]:
        for _ in range(600):
            x = list(word)
            for _ in range(rng.randint(0, 2)):
                k, p = rng.randint(0, 2), rng.randrange(len(x))
                x[p : p + (k != 2)] = [] if k == 1 and len(x) > 1 else rng.choice("diotmrn")
            words.add("".join(x))
    words = sorted(words)
    got = {w: kind for _, w, kind, _ in scanner.hits(words)}
    for w in words:
        near = min(_distance(w, t) for t in terms if len(t) >= 5)
        want = 1 if w in terms else 2 if w.startswith("lowei") else 3 if near == 1 else 0
        assert got.get(w, 0) == want, w


def test_quotation_is_seen():
    scanner = Scanner(build_automaton(["idiot"], []), frozenset())
    texts = ['he wrote "what an idiot" again', "you idiot", "she called him idiot once", 'an "old" idiot and "more"']
    assert [q for _, _, _, q in scanner.hits(texts)] == [True, False, True, False]


@pytest.mark.parametrize("bits", [14, 30])
def test_gray_index_finds_all_pairs(bits):
    rng = np.random.default_rng(bits)
    prints = np.unique(rng.integers(0, 1 << bits, 900).astype(np.uint64) << np.uint64(20))
    ordered = prints[np.argsort(simhash.gray_rank(prints))]
    found = {tuple(sorted(p)) for a, b in simhash.linked_pairs(ordered) for p in zip(a.tolist(), b.tolist())}
    near = np.bitwise_count(ordered[:, None] ^ ordered[None, :]) <= 2
    assert found == {(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def test_fingerprints_by_definition():
    for text in ("a", "A b", "the Cat sat\ton the cat sat", "", None, "é ü\x0bx y z"):
        words = (text or "").replace("A", "a").replace("C", "c").replace("\t", " ").replace("\x0b", " ").split(" ")
        words = [w for w in words if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text.encode() if text is not None else None) == want


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("max_group", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, max_group):
    common.ship_package(spark)
    rng = np.random.default_rng(5)
    prints = set()
    for _ in range(30):
        base = int(rng.integers(0, 1 << 63))
        prints.add(base)
        for _ in range(8):
            base ^= 1 << int(rng.integers(0, 64))
            prints.add(base)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.links(table, max_group).collect()
    brute = [
        (a, b) for a in signed for b in signed if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2
    ]
    assert _roots(signed, [(r["u"], r["v"]) for r in links]) == _roots(signed, brute)


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2), (200, 201)]
    links = spark.createDataFrame(pairs, "u long, v long")
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    nodes = sorted({n for p in pairs for n in p})
    assert found == _roots(nodes, pairs)
    assert connected_components(links.limit(0)).count() == 0
    a, b = np.array(pairs[:40]).T
    assert (local_roots(41, a, b) == 0).all()


@pytest.mark.parametrize("block", [512, 4])
def test_vectors_against_brute_force(spark, block):
    common.ship_package(spark)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = centres[i % 12] + rng.normal(size=16) * (0.12 if i % 3 else 0.0)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: r for r in near_vectors(table, block=block).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = sum(r["n_links"] for r in found.values())
    assert all(found[i]["n_links"] <= near[i].sum() for i in range(240))
    assert got >= 0.9 * near.sum() > 0


def test_window_entropy_equals_counting_anew():
    rng = random.Random(4)
    for size in (0, 5, 20, 21, 70):
        text = "".join(rng.choice("abcdef0123") for _ in range(size))
        windows = [text[i : i + 20] for i in range(max(1, size - 19))]
        want = max(
            (-sum(c / len(w) * log2(c / len(w)) for c in Counter(w).values()) for w in windows if w), default=0
        )
        assert best_entropy(text) == pytest.approx(want)


def test_sql_of_decontamination(spark):
    import duckdb

    from daylake.llm.queries import ORACLES

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(ORACLES["op3_decontamination"]).fetchall()
    got = [tuple(r) for r in QUERIES["op3_decontamination"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    for name, label in (("op4_quality", "quality"), ("op5_toxicity", "toxic")):
        rows = QUERIES[name](spark, sf).collect()
        known = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
        held = [r for r in rows if r["held_out"] and r["doc_id"] in known]
        assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.9
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in QUERIES["op2_language_id"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.95


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    report = contamination_report(contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert report.where("contaminated").count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]
