"""Scores of the trained models against their definitions, in plain Python."""

from __future__ import annotations

import math
import re

import brute
import numpy as np

from ledgerlake.llm import langid, queries, secrets, toxicity
from ledgerlake.llm.common import table

SF = "/root/testdata/sf0.01"


def test_factorization_machine_is_the_sum_over_pairs(spark):
    """Every document's score: bias, weights and each pair's inner product."""
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"), queries.fold("id", 3) != 1)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    known = np.flatnonzero(np.abs(model.w) + np.abs(model.v).sum(axis=1))
    assert len(known) > 5
    for r in docs.select("doc_id", "text").collect():
        ids = [i for i in toxicity.terms((r.text or "").encode(), model.bits).tolist() if i in set(known.tolist())]
        z = model.w0 + sum(model.w[i] for i in ids)
        z += sum(float(model.v[a] @ model.v[b]) for k, a in enumerate(ids) for b in ids[k + 1:])
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_markov_ratio_of_every_token(spark):
    """The random spans are the long tokens beside base spans whose mean ratio
    per bigram reaches the threshold."""
    docs = table(spark, SF, "documents")
    model = secrets.train(docs)
    k, at = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    got = {r.doc_id: r.extra for r in secrets.scan(docs, model).select(
        "doc_id", secrets.listed("random").alias("extra")).collect()}
    tokens = 0
    for r in docs.select("doc_id", "text").collect():
        text = list(r.text or "")
        for span in filter(None, brute.secret_base(r.text)[3].split(",")):
            _, a, b = span.split(":")
            text[int(a):int(b)] = " " * (int(b) - int(a))
        want = []
        for m in re.finditer(f"{secrets.TOKEN}{{{secrets.TOKEN_CHARS},}}", "".join(text)):
            t = m.group()
            score = sum(model[at[a] * k + at[b]] for a, b in zip(t, t[1:])) / (len(t) - 1)
            tokens += 1
            if score >= secrets.RATIO:
                want.append(f"random:{m.start()}:{m.end()}")
        assert got[r.doc_id] == ",".join(want)
    assert tokens > 100


def test_label_probabilities_of_whole_texts_equal_enumeration():
    """Mean marginals of short texts over all label sequences, cut into chains."""
    from itertools import product

    model = langid.fit([(["the", "of", "and"], "en"), (["der", "und", "das"], "de"), (["le", "et"], "fr")] * 3)
    texts = ["the und le", "of der das et the", "xq zz the the und der"]
    chain, langid.CHAIN = langid.CHAIN, 2
    try:
        got = langid.label(texts, langid._Emissions(model))
    finally:
        langid.CHAIN = chain
    for text, p in zip(texts, got):
        words = langid.letters(text)
        e, total, own = model.emissions(words), 0.0, np.zeros(3)
        for path in product(range(3), repeat=len(words)):
            w = math.exp(sum(e[i, c] for i, c in enumerate(path)) + sum(model.t[a, b] for a, b in zip(path, path[1:])))
            total += w
            own += w * np.bincount(path, minlength=3) / len(words)
        assert np.allclose(p, own / total)
