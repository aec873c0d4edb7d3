"""Benchmark decontamination against brute force."""

from __future__ import annotations

import random

import brute
import pytest

from ledgerlake.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string, n int, items int, uid int", "item_id long, text string, block int, piece int"


def _rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ß", "x" * 300, "a", "b", "7"]

    def text(n, sep=" "):
        return sep.join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 30, 200]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, " .,! "), (None, text(15)), (None, "nameless thing"), (103, items[5][1]),
              (5, text(12)), (104, "a"), (105, "A-B"), (106, " ".join(["x" * 300] * 12)), (107, "same " * 40)]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "a"), (4, "b.A,b"), (5, items[0][1].upper()), (6, text(5000)),
            (7, "same " * 9), (8, "same-" * 10), (9, "x" * 299 + " " + "x" * 300)]
    for k, (_, t) in enumerate(items):
        w = (t or "").split()
        for cut in (0, 1, 3):                              # whole, and short of words at both ends
            docs.append((100 + 3 * k + cut // 2 + cut % 2, f"{text(20)}\n{' ,'.join(w[cut:len(w) - cut])}!{text(5)}"))
    docs += [(i + 1000, text(rng.randrange(60))) for i in range(60)]
    docs += [(5000, " ".join(t or "" for _, t in items) + " " + text(30_000)), (5000, "a b"), (5001, "nameless thing")]
    return list({i: (i, t) for i, t in docs}.values()), items


def _found(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, list(r["items"])) for r in df.collect()}


@pytest.mark.parametrize("block, piece, group", [(8 << 20, 5000, 8 << 20), (4000, 13, 2000)])
def test_odd_rows(spark, monkeypatch, block, piece, group):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", group)
    docs, items = _rows()
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS).repartition(3)
    out = decontaminate.decontaminate(d, b)
    want = brute.contaminated(docs, items)
    assert sum(w[1] > 0 for w in want.values()) > 30
    assert _found(out) == want
    for r in out.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
    assert (decontaminate.blocks(b, 10)[1] > 1) == (block == 4000)


def test_windows_of_other_lengths(spark):
    docs, items = _rows()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for window in (1, 4):
        assert _found(decontaminate.decontaminate(d, b, window)) == brute.contaminated(docs, items, window)


def test_empty_tables(spark):
    docs, items = _rows()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.decontaminate(d.where("false"), b).count() == 0
    assert all(v[1:] == (0, 0, []) for v in _found(decontaminate.decontaminate(d, b.where("false"))).values())


def test_rows_of_one_id_and_documents_stay_in_place(spark):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(7, "one two three"), (7, "one two"), (None, "x one two three")],
                                 "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit) for r in decontaminate.decontaminate(docs, items).collect() if r.doc_id)
    assert got == [(7, 2, 0), (7, 3, 3)]
    plan = decontaminate.decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan                          # one block: no shuffle of documents


def test_shifts_skip():
    """A text without the strings' blocks is passed in steps of m - B + 1."""
    index = decontaminate.Index([("1", b" alpha beta gamma delta epsilon zeta eta theta iota kappa ")], 10)
    c = index.classes[0]
    assert c.m - c.b + 1 > 40
    assert (c.shift == c.m - c.b + 1).mean() > 0.9 and c.shift.min() == 0
    assert len(c.places(decontaminate._loads(b"z" * 100_000), 99_992)) == 0
