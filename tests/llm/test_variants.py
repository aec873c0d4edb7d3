"""Spelling variants against all pairs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from ledgerlake.llm import queries, variants

SMALL = "/root/testdata/sf0.001"


def _found(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    n = brute.vocabulary(docs)
    got = _found(queries.op12_vgram_spelling_variants(spark, SMALL))
    assert got == brute.variants(n) and any(v[2] for v in got.values())


def _words(seed, alphabet, count, sizes):
    """Random words with chains of edits, and repeats within words."""
    rng = random.Random(seed)
    out = set()
    for _ in range(count):
        w = [rng.choice(alphabet) for _ in range(rng.choice(sizes))]
        for _ in range(rng.randrange(5)):
            out.add("".join(w))
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = rng.choice(alphabet) * rng.randrange(2)
    return {w: rng.choice([2, 3, 20, 31, 250, 2600]) for w in out if w}


@pytest.mark.parametrize("seed, alphabet, sizes, share, carried", [
    (1, "ab", (7, 8, 9), 0.002, 256), (2, "abcdé", (7, 9, 12), 0.05, 256), (3, "ab", (1, 2, 3, 4), 0.002, 256),
    (4, "abcdefghij", (7, 30, 60), 0.0, 256), (5, "xyz", (7, 9, 12, 20), 0.9, 9), (6, "😀aЖ", (5, 8), 0.01, 6)])
def test_near_words_of_any_shape(spark, monkeypatch, seed, alphabet, sizes, share, carried):
    """Every pair one edit apart is found once, whatever the dictionary holds."""
    monkeypatch.setattr(variants, "SHARE", share)
    monkeypatch.setattr(variants, "CARRIED", carried)
    n = _words(seed, alphabet, 150, sizes)
    df = spark.createDataFrame([(w, k, 1, 2) for w, k in n.items()], "word string, n long, key int, place int")
    assert _found(variants.group(df.repartition(3))) == brute.variants(n)


def test_odd_rows(spark):
    long = "a" * 700
    docs = [(0, None), (1, ""), (2, "!?"), (None, "Straße-ÀÉÎÕÜÝÞ straße ÀÉÎÕÜÝÞ"), (3, "×÷×÷×÷× ×÷×÷×÷×"),
            (4, "Ördnung ördnung Łódźłódź 漢字漢字漢字漢字"), (5, f"{long} {long}b {long[1:]}"), (6, f"{long} {long}b {long[1:]}"),
            *[(k, "CHARACTER character charactər chaaracter charcter") for k in range(10, 80)], (7, "charakter charakter")]
    docs += [docs[-1]] * 3
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, word int, n int").repartition(4)
    want = brute.variants(brute.vocabulary(docs))
    assert _found(variants.group(variants.vocabulary(df, typo=31))) == want
    assert want["charakter"][2] == "character" and len(want) > 5
    assert variants.group(variants.vocabulary(df.where("false"))).count() == 0
    plain = brute.variants(brute.vocabulary(docs, typo=1 << 40))
    assert _found(variants.group(variants.vocabulary(df))) == plain


def test_grams_vary_and_affected_ones_are_left_out():
    words = ["station", "nations", "rations", "portion"]
    hashes = {}
    for _, m in variants._by_length(words):
        for q in (2, 3):
            for row, h in zip(m, variants._grams(m, q)):
                for p, x in enumerate(h.tolist()):
                    hashes[tuple(row[p:p + q].tolist())] = x
    frequent = np.sort(np.array([hashes[tuple(map(ord, g))] for g in ("ti", "tio", "io")], np.uint64))
    (_, m), = variants._by_length(["station"])
    _, length = variants.decompose(m, frequent)
    assert length[0].tolist() == [2, 2, 2, 2, 4, 3, 2, 2]  # ^s st ta at tion ion on n$
    points, _ = variants.keys(m, frequent)
    other = variants.keys(next(variants._by_length(["stbtion"]))[1], frequent)[0]
    assert (points == other)[0].nonzero()[0].tolist() == [2]
    gaps = variants.keys(next(variants._by_length(["sttion"]))[1], frequent)[1]
    assert gaps[0, 2] == points[0, 2]
