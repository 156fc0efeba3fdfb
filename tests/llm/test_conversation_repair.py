"""Repairs against a plain dynamic program over whole audits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import conversation_repair, queries
from touchline.llm.conversation_repair import Grammar, Matrix

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, fault INT, at STRING"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def digest_key(role, text):
    """The documented order of rows of one turn: by role, then by a hash of both."""
    return role, hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()


def damage(conversations):
    """(conv_id, turn, role, text) after damage, and all ids."""
    out = []
    for conv_id, turn, role, text in conversations:
        key = ":".join(" " if value is None else str(value) for value in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out, {row[0] for row in conversations}


def repair(rows):
    """The least (cost, audit) and the repaired lines, trying every edit of every row from every state."""
    best = {0: (0, "", ())}
    for role, text, fault in [*rows, (None, None, None)]:
        for _ in range(3):  # inserts before the row, or at the end
            for i, (cost, audit, lines) in list(best.items()):
                for new in "ua":
                    if i in NEXT[new]:
                        name = {"u": "user", "a": "assistant"}[new]
                        value = cost + 5, audit + "I", (*lines, f"{name}:")
                        j = NEXT[new][i]
                        if j not in best or value[:2] < best[j][:2]:
                            best[j] = value
        if role is None:
            break
        found = {}
        for i, (cost, audit, lines) in best.items():
            moves = [(i, 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if i in NEXT.get(role[:1], {}):
                    moves.append((NEXT[role[:1]][i], extra, "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new != role and i in NEXT[new[0]]:
                        moves.append((NEXT[new[0]][i], 1 + extra, "R", (*lines, f"{new}:{text}")))
            for j, more, edit, after in moves:
                value = cost + more, audit + edit, after
                if j not in found or value[:2] < found[j][:2]:
                    found[j] = value
        best = found
    return min((best[j] for j in (0, 3) if j in best), key=lambda value: value[:2])


def expected(rows, ids):
    out = []
    for conv_id in ids:
        own = [row for row in rows if row[0] == conv_id]
        own.sort(key=lambda row: (row[1] is not None, row[1] or 0, *digest_key(row[2], row[3])))
        seen, marked, counts, illegal = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}, 0
        for at, (_, _, role, text) in enumerate(own):
            signs = WORD.findall(text)
            fault = "blank" if not signs else "duplicate" if (role, text) in seen else None
            if fault is None and signs[-1] not in ".!?":
                fault = "truncated"
            if fault:
                counts[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault))
            if at and own[at - 1][2][:1] + role[:1] not in ("su", "ua", "au"):
                illegal += 1
        turns = [row[1] for row in own if row[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = repair(marked)
        out.append((conv_id, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query(spark, rows):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = rows(queries.op13_conversation_repair(spark, sf), *COLUMNS)
    assert found == expected(*damage([tuple(row) for row in table.collect()]))
    assert {sign for row in found for sign in row[7]} == set("KRD")  # deleting a row is always cheaper than an insert


def case(seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "usher", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "Yes. ", None, "\x0b.", "é", "[a]?"]
    out = [
        (draw.choice([*range(12), None]), draw.choice([None, *range(-3, 9)]), draw.choice(roles), draw.choice(texts))
        for _ in range(260)
    ]
    out += [(99, i, draw.choice(roles[:5]), draw.choice([f"text {i}.", f"text {i}", "Yes."])) for i in range(3000)]
    out += [(98, None, "user", "the same.")] * 300 + [(97, 1, "user", "long " * 50_000 + "end.")]
    dropped = next(i for i in range(10**6, 10**7) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return out + [(dropped, 0, "user", "gone.")]


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("bits", [2, 12])
def test_against_brute_force(spark, rows, monkeypatch, seed, bits):
    """NULLs, odd roles, ties, copies, long texts and conversations, a lost one; whole and in many segments."""
    monkeypatch.setattr(conversation_repair, "SEGMENT_BITS", bits)
    monkeypatch.setattr(conversation_repair, "BLOCK", 500)
    conversations = case(seed)
    df = spark.createDataFrame([(*row, 7, "x") for row in conversations], SCHEMA).repartition(5)
    found = conversation_repair.report(queries.damaged(df), F.col("present"))
    assert rows(found, *COLUMNS) == expected(*damage(conversations))


def test_repaired_rows(spark, rows):
    df = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "tool", "cut"), (1, 2, "user", "Why?")],
                               "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    assert rows(conversation_repair.repaired(df)) == [(1, 0, "R", "user", "Hello."), (1, 1, "R", "assistant", "Why?")]
    assert rows(conversation_repair.report(df), "cost", "audit") == [(4, "RDR")]


def test_empty_table(spark, rows):
    df = spark.createDataFrame([], SCHEMA)
    assert rows(conversation_repair.report(df)) == []


def test_grammar_matrices_are_those_of_the_plain_product():
    """Symbols shared by sequences, ropes of all entries, long sequences in few rules."""
    draw = random.Random(5)
    sequences = ["".join(draw.choices("uadUAsxX", [9, 9, 2, 1, 1, 1, 1, 1], k=draw.choice([1, 2, 5, 40]))) for _ in range(80)]
    sequences += ["ua" * 2000, "s" + "ua" * 1500 + "x", "d" * 500, "u"]
    grammar = Grammar(sequences)
    assert sum(map(len, grammar.sequences)) < sum(map(len, sequences)) / 5
    for signs, compressed in zip(sequences, grammar.sequences):
        matrix, audits = grammar.evaluated(compressed)
        plain = {(i, i): (0, "") for i in range(4)}
        for sign in signs[:60] if len(signs) > 100 else signs:
            step = Matrix.of_sign(sign)
            best = {}
            for (i, k), (cost, audit) in plain.items():
                for (k2, j), more in step.cost.items():
                    if k == k2:
                        value = cost + more, audit + step.audits[k2, j]
                        best[i, j] = min(value, best.get((i, j), value))
            plain = best
        if len(signs) <= 100:
            assert {key: (matrix.cost[key], audits[key]) for key in matrix.cost} == plain
        else:
            assert {len(audit.replace("I", "")) for audit in audits.values()} == {len(signs)}
