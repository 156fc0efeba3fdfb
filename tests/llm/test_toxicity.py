"""The toxicity grammar: transducers, learning, held-out accuracy."""

import zlib

import numpy as np
import pytest

from touchline.llm import queries, toxicity


@pytest.fixture
def matcher():
    return toxicity.Matcher(toxicity.lexicon(["zorp"]))


@pytest.mark.parametrize(
    "text, patterns",
    [
        ("", {}),
        ("nothing here", {}),
        ("an idiot", {("I", False, False, False): 1}),
        ("You are an IDIOT, scum!", {("I", False, False, True): 1, ("I", False, False, False): 1}),
        ("you are not an idiot", {("I", True, False, True): 1}),
        ("not a b c idiot", {("I", False, False, False): 1}),
        ("he said she is stupid", {("I", False, True, True): 1}),
        ("he said it. Stupid.", {("I", False, False, False): 1}),
        ("we will kill you", {("T", False, False, False): 1}),
        ("you: zorp *zorp*", {("L", False, False, False): 2}),
        ("worthlessness idioty", {}),
        ("idiot " * 1000, {("I", False, False, False): 1000}),
    ],
)
def test_clauses(matcher, text, patterns):
    assert {toxicity.PATTERNS[k]: n for k, n in matcher.counts(text).items()} == patterns


@pytest.mark.parametrize(
    "text, patterns",
    [
        ("idiot/loser", {("I", False, False, False): 2}),
        ("a moron-like man", {("I", False, False, False): 1}),
        ("you idiot's friend", {("I", False, False, True): 1}),
        ("some_zorp-word", {("L", False, False, False): 1}),
        ("you don't idiot", {("I", True, False, True): 1}),
        ("'you're' an idiot", {("I", False, False, True): 1}),
        ("don'ts idiot", {("I", False, False, False): 1}),
    ],
)
def test_words_inside_words(matcher, text, patterns):
    assert {toxicity.PATTERNS[k]: n for k, n in matcher.counts(text).items()} == patterns


def test_composition_equals_one_after_the_other():
    symbols = [(kind, False, False, False) for kind in "ILTYNRO"]
    draw = np.random.default_rng(1)
    parts = [toxicity._negation, toxicity._reported, toxicity._aimed]
    table = toxicity.GRAMMAR.table(symbols)
    for _ in range(50):
        line = [symbols[i] for i in draw.integers(0, len(symbols), 12)]
        state, composed = toxicity.GRAMMAR.start, []
        for symbol in line:
            state, out = table[state, symbol]
            composed.append(out)
        for step in parts:
            at, out = 0, []
            for symbol in line:
                at, marked = step(at, symbol)
                out.append(marked)
            line = out
        assert composed == line


def test_fit_separates_and_stays_finite():
    weights = toxicity.fitted([({}, 0)] * 90 + [({0: 1}, 1)] * 10 + [({4: 1}, 0)] * 5 + [({}, 1)] * 4)
    chance = lambda counts: 1 / (1 + np.exp(-(toxicity.features(counts) @ weights[:-1] + weights[-1])))
    assert np.isfinite(weights).all()
    assert chance({0: 1}) > 0.7 > 0.2 > chance({}) and chance({4: 1}) < 0.5
    assert toxicity.fitted([]).tolist() == [0] * (len(toxicity.PATTERNS) + 1)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op5_toxicity(spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    lang = {row["doc_id"]: row["lang"] for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = found.collect()
    assert len(rows) == len(lang)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.7) for row in rows)
    held = [(labels[row["doc_id"]], row["predicted"]) for row in rows
            if row["held_out"] and row["doc_id"] in labels and lang[row["doc_id"]] == "en"]
    # About a tenth of the English texts marked toxic have had all their words replaced by junk.
    hits = sum(t and p for t, p in held)
    assert hits >= 0.85 * sum(t for t, _ in held) and hits >= 0.98 * sum(p for _, p in held)


def test_edge_rows(spark, rows):
    texts = [(i, f"you idiot {i}") for i in range(0, 60)] + [(i, f"fine words {i}") for i in range(60, 200)]
    texts += [(None, None), (300, ""), (1, "you idiot 1"), (301, None)]
    frame = spark.createDataFrame([(*row, "s", 0.5) for row in texts], "doc_id LONG, text STRING, toxic STRING, score DOUBLE")
    known = [(i, int(i < 60), "t") for i in range(0, 200)] + [(5, None, "t"), (None, 1, "t"), (999, 1, "t")]
    labels = spark.createDataFrame(known, "doc_id LONG, toxic INT, text STRING")
    scored = toxicity.score(frame.select("doc_id", "text", "toxic"), labels).collect()
    assert len(scored) == len(texts)
    assert all((row["score"] >= 0.7) == (row["doc_id"] is not None and row["doc_id"] < 60) for row in scored)
    kept = toxicity.clean(frame.select("doc_id", "text"), labels)
    assert kept.columns == ["doc_id", "text"] and kept.count() == 140 + 3
    none = labels.limit(0)
    assert {row["score"] for row in toxicity.score(frame.select("doc_id", "text"), none).collect()} == {0.5}
    assert toxicity.score(frame.select("doc_id", "text").limit(0), labels).collect() == []
