"""The language model against one written with dictionaries."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.llm import language_model, queries

KEPT, DELETED, UNSEEN = language_model.KEPT, language_model.DELETED, language_model.UNSEEN


def tokens_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        folded = folded.replace(blank, " ")
    return [*(word for word in folded.split(" ") if word), None]


def events(tokens, order):
    line = ["<s>"] * order + tokens
    for i in range(order, len(line)):
        yield [tuple(line[i - n : i + 1]) for n in range(order)], [tuple(line[i - n : i]) for n in range(1, order)]


def count(texts, order):
    counts = Counter()
    for tokens in texts:
        for grams, contexts in events(tokens, order):
            counts.update(grams)
        for n in range(1, order):
            counts[("<s>",) * n] += 1
    return counts


class Brute:
    def __init__(self, texts, order):
        self.order, self.counts = order, count(texts, order)
        self.n = sum(map(len, texts))
        self.v = len({token for tokens in texts for token in tokens})

    def parts(self, tokens):
        for grams, contexts in events(tokens, self.order):
            c = self.counts[grams[0]]
            estimates = [(c + 0.1) / (self.n + 0.1 * (self.v + 1)), c / max(1, self.n)]
            bucket = 0
            for n, context in enumerate(contexts, 1):
                seen = self.counts[context]
                estimates.append(self.counts[grams[n]] / max(1, seen))
                if seen:
                    bucket = n * 64 + math.frexp(seen)[1]
            yield c, bucket, estimates


def expected(rows, order):
    role = {}
    texts = [(doc_id, tokens_of(text), kind) for doc_id, text, kind in rows]
    kept = Brute([t for _, t, kind in texts if kind == KEPT], order)
    full = Brute([t for _, t, kind in texts if kind != UNSEEN], order)
    weights = [[1 / (2 + b // 64)] * (2 + b // 64) + [0] * (order - 1 - b // 64) for b in range(64 * order)]
    held = [(b, p) for _, t, kind in texts if kind == DELETED for _, b, p in kept.parts(t)]
    for _ in range(language_model.ROUNDS):
        sums = {}
        for b, p in held:
            shares = [w * x for w, x in zip(weights[b], p)]
            total = sums.setdefault(b, [0.0] * (order + 1))
            for i, share in enumerate(shares):
                total[i] += share / sum(shares)
        for b, total in sums.items():
            total = [t + 0.5 * (i < 2 + b // 64) for i, t in enumerate(total)]
            weights[b] = [t / sum(total) for t in total]
    out = []
    for doc_id, tokens, kind in texts:
        base = score = known = 0
        for c, b, p in full.parts(tokens):
            known += c > 0
            base += math.log10(p[0])
            score += math.log10(sum(w * x for w, x in zip(weights[b], p)))
        out.append((doc_id, kind == UNSEEN, len(tokens), known, full.n, base, score))
    return out


def agree(found, want):
    key = lambda row: repr((*row[:5], round(row[5], 6), round(row[6], 6)))
    found, want = sorted(map(tuple, found), key=key), sorted(want, key=key)
    assert [row[:5] for row in found] == [row[:5] for row in want]
    for a, b in zip(found, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order, unit", [(1, 300), (2, 60), (3, 40)])
def test_small(spark, monkeypatch, order, unit):
    monkeypatch.setattr(language_model, "UNIT", unit)
    draw = random.Random(order)
    words = ["a", "B", "b", "c", "dé", "e.", "longer"]
    rows = [(i % 40, " ".join(draw.choices(words, [5, 3, 3, 2, 1, 1, 1], k=draw.choice([0, 1, 4, 40]))), draw.choice([0, 0, 1, 2]))
            for i in range(60)]
    rows += [(None, None, 2), (3, " \n", 0), (4, None, 1), (5, "new words only", 2)]
    frame = spark.createDataFrame([(*row, "x", 7) for row in rows], "doc_id LONG, text STRING, kind INT, score STRING, row INT")
    found = language_model.score(frame.repartition(3), F.col("kind"), order)
    agree(found.collect(), expected(rows, order))


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id LONG, text STRING")
    found = language_model.score(frame, F.lit(UNSEEN)).first()
    assert found["n_tokens"] == 3 and found["n_known"] == 0 and found["train_tokens"] == 0 and found["score"] <= 0
    assert language_model.score(frame.limit(0), F.lit(KEPT)).collect() == []
    with pytest.raises(ValueError):
        language_model.score(frame, F.lit(KEPT), 5)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d, t, {0: UNSEEN, 1: DELETED}.get(zlib.crc32(str(d).encode()) % 10, KEPT)) for d, t in table]
    found = queries.op10_language_model(spark, sf).collect()
    agree(found, expected(rows, 2))
    unseen = [row for row in found if row["held_out"]]
    assert sum(row["score"] for row in unseen) > sum(row["base_score"] for row in unseen)


def test_contexts_of_the_unit_before_are_named_without_going_through_all_names(monkeypatch):
    """Names are made distinct once; the few contexts that only the unit before counts are looked up in them."""
    import numpy as np
    import zstandard

    monkeypatch.setattr(np, "setdiff1d", lambda *_: pytest.fail("all names are made distinct once more"))
    parts = [b"a b a", b" c a b", b""]
    pieces = [
        {"size": len(parts[0]), "begins": True, "ends": False, "before": b""},
        {"size": len(parts[1]), "begins": False, "ends": True, "before": b"x y z"},
        {"size": 0, "begins": True, "ends": True, "before": b""},
    ]
    packed = zstandard.ZstdCompressor().compress(b"".join(parts))
    for order in (1, 2, 3, 4):
        tokens = language_model.Tokens(pieces, packed, order, language_model._Hashes())
        leads = set(np.concatenate([tokens.names[:0], *tokens.lead]).tolist())
        own = set(np.concatenate([*tokens.keys, *(lead[tokens.fresh] for lead in tokens.lead)]).tolist())
        assert tokens.names.tolist() == sorted(own | leads)
        assert [bool(n) for n in tokens.counts] == [name in own for name in tokens.names.tolist()]
        for n in range(1, order):
            assert tokens.names[tokens.contexts(n)][tokens.heads].tolist() == tokens.lead[n - 1].tolist()
