"""Conversation structure repair against enumeration and brute force."""

from __future__ import annotations

import random

import brute
import pytest

from ledgerlake.llm import queries, repair

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def _solved(symbols, grammar):
    v = repair.BEGIN
    for m in grammar.compress([bytes(symbols)])[:-1].tolist():
        v = repair._row(*v, grammar.matrices[m])
    return repair.closed(v)


def _marked(symbols):
    return [("suax"[s // 3], "", s % 3 == 2, s % 3 == 1) for s in symbols]


def test_cheapest_edits_equal_enumeration():
    rng = random.Random(1)
    for _ in range(400):
        symbols = [rng.randrange(12) for _ in range(rng.randrange(1, 5))]
        want = brute.every_repair(_marked(symbols))
        assert _solved(symbols, repair.Grammar()) == want
        assert brute.cheapest(_marked(symbols))[:2] == want


def test_compressed_equals_plain():
    """Rules, runs and ropes change nothing; long sequences, many ties."""
    rng = random.Random(2)
    grammar = repair.Grammar()
    grammar.add([(3, 6), (4, 4), (7, 8)])
    grammar.add([(12, 12), (13, 13), (6, 14)])
    grammar.add([(15, 15), (16, 12)])
    for k in range(200):
        pool = [(3, 6), (3, 3, 4), (4, 6, 7, 8), range(12)][k % 4]
        symbols = [rng.choice(list(pool)) for _ in range(rng.randrange(1, 120))]
        assert _solved(symbols, grammar) == _solved(symbols, repair.Grammar()) \
            == brute.cheapest(_marked(symbols))[:2]


def _query_rows(spark, monkeypatch, df):
    monkeypatch.setattr(queries, "table", lambda *a: df)
    return {r.conv_id: tuple(r[c] for c in COLUMNS)
            for r in queries.op13_conversation_repair(spark, "").collect()}


def test_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS)
           for r in queries.op13_conversation_repair(spark, sf_dir).collect()}
    assert got == brute.repairs(rows)


@pytest.mark.parametrize("segment", [4096, 3])
def test_odd_rows(spark, monkeypatch, segment):
    """NULLs, blanks, unknown roles, ties, repeated rows, gaps, a long conversation."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rng = random.Random(3)
    texts = ["A b.", "A b", " \t", "", None, "x!  ", "é?", "y\x0b", "long " * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "u"]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts))
            for c in [None, *range(40)] for _ in range(rng.randrange(9))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
    rows += [(98, t % 9, "user", "again.") for t in range(700)]
    rows += [(97, None, None, None), (96, -(1 << 40), "user", "a."), (96, 1 << 40, "assistant", "b.")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                               SCHEMA + ", n int, `first` int, deal int").repartition(5)
    assert _query_rows(spark, monkeypatch, df) == brute.repairs(rows)


def test_empty(spark, monkeypatch):
    df = spark.createDataFrame([], SCHEMA)
    assert _query_rows(spark, monkeypatch, df) == {}
    assert repair.repair(df).count() == 0
    gone = next(i for i in range(1000) if brute.damage([(i, 0, "user", "a")]) == [])
    df = spark.createDataFrame([(gone, 0, "user", "a")], SCHEMA)
    assert _query_rows(spark, monkeypatch, df) == brute.repairs([(gone, 0, "user", "a")])


def test_grammar_is_shared_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(repair, "MAX_RULES", 5)
    monkeypatch.setattr(repair, "ROUND_RULES", 2)
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(30) for t in range(2 + c % 12)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = repair.faults(df)
    grammar = repair.learn(repair.segments(found))
    assert 0 < len(grammar.matrices) - repair.N_SYMBOLS <= 5
    want = brute.repairs(rows, damaged=False)
    got = {r.conv_id: r for r in repair.repair(df).collect()}
    assert {c: (r.cost, r.audit) for c, r in got.items()} == {c: w[5:7] for c, w in want.items()}
    turns = repair.repaired(df, repair.repair(df)).collect()
    assert [r.position for r in turns if r.conv_id == 5] == list(range(len([r for r in turns if r.conv_id == 5])))
