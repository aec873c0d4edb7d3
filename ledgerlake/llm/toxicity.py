"""Toxicity: a factorization machine over hashed terms.

    score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)

over the distinct terms i of a text, hashed to ``2**bits`` buckets.  The
latent vectors v learn pairwise interactions (an insult together with a
mention of a group) that additive weights miss; the pair sum costs one pass
over the terms: half of (sum v)^2 - sum v^2.

Trained on a bounded sample of the labelled rows (``per_class`` documents of
each label, chosen by a seeded hash of the id at a rate from the label
counts).  Executors turn texts into term buckets; the driver fits the weights.
The model (a few MB, whatever the input) is broadcast for scoring.

Defined results: NULL and empty texts have no terms and get the score of the
intercept; repeated rows are scored one by one; an id with several labels
gives one training row each; NULL labels are not used; without labels of
both kinds all weights are 0 and every score is the share of label 1 (0.5
without any); texts of any length are scored whole; equal scores need no order,
as nothing is ranked; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches

#: Documents of each label in the training sample, about; at most.
PER_CLASS = 4000
#: Terms carry weight if they are in this many sample documents and their share
#: of the two labels differs by this many standard errors.
LEAST_DOCS, LEAST_Z = 3, 4.5

#: ASCII other than letters and digits separates terms.
_TABLE = bytes(c if c >= 128 or chr(c) in string.ascii_letters + string.digits else 32
               for c in range(256))


def terms(text: bytes, bits: int) -> np.ndarray:
    """Distinct term buckets of a text, sorted."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, text.lower().translate(_TABLE).split()), np.uint64)
    return np.unique(h >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Model:
    bits: int
    w0: float
    w: np.ndarray        # (buckets,)
    v: np.ndarray        # (buckets, factors)

    def score(self, ids: np.ndarray) -> float:
        v = self.v[ids]
        z = self.w0 + self.w[ids].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: list[np.ndarray], y: np.ndarray, bits: int, factors: int = 8, epochs: int = 25,
        batch: int = 128, rate: float = 0.02, decay: float = 1e-4, least_z: float = LEAST_Z, seed: int = 11) -> Model:
    """Logistic loss by Adam over mini-batches; labels weigh alike."""
    size = 1 << bits
    model = Model(bits, 0.0, np.zeros(size), np.zeros((size, factors)))
    if not len(y):
        return model
    share = y.mean()
    if share in (0, 1):
        model.w0 = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return model
    df = np.bincount(np.concatenate([*docs, np.zeros(0, np.int64)]), minlength=size)
    toxic = np.bincount(np.concatenate([*(d for d, t in zip(docs, y) if t), np.zeros(0, np.int64)]),
                        minlength=size)
    rest = (df - toxic) / (len(y) - y.sum())
    z = np.abs(toxic / y.sum() - rest) / np.sqrt(
        np.maximum(df, 1) / len(y) * (1 - df / (len(y) + 1)) * (1 / y.sum() + 1 / (len(y) - y.sum())))
    vocabulary = np.flatnonzero((df >= LEAST_DOCS) & (z >= least_z))
    at = np.full(size, -1)
    at[vocabulary] = np.arange(len(vocabulary))
    docs = [(a := at[d])[a >= 0] for d in docs]
    rng = np.random.default_rng(seed)
    n = len(vocabulary)
    # one parameter matrix: column 0 the linear weights, the others the factors
    p = np.zeros((n, factors + 1))
    p[:, 1:] = rng.normal(0, 0.01, (n, factors))
    bias, mb, vb = 0.0, 0.0, 0.0
    m1, m2 = np.zeros_like(p), np.zeros_like(p)
    weigh = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            own = order[k:k + batch]
            ids = np.concatenate([docs[i] for i in own])
            row = np.repeat(np.arange(len(own)), [len(docs[i]) for i in own])
            x = p[ids]
            total = np.zeros((len(own), factors + 1))
            np.add.at(total, row, x)
            square = np.bincount(row, (x[:, 1:] ** 2).sum(axis=1), len(own))
            z = bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - square)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) * weigh[own] / len(own)
            g = e[row, None] * np.concatenate(
                [np.ones((len(ids), 1)), total[row, 1:] - x[:, 1:]], axis=1)
            uniq, inverse = np.unique(ids, return_inverse=True)
            grad = np.zeros((len(uniq), factors + 1))
            np.add.at(grad, inverse, g)
            grad += decay * p[uniq]
            step += 1
            m1[uniq] = 0.9 * m1[uniq] + 0.1 * grad
            m2[uniq] = 0.999 * m2[uniq] + 0.001 * grad ** 2
            p[uniq] -= rate * (m1[uniq] / (1 - 0.9 ** step)) / (np.sqrt(m2[uniq] / (1 - 0.999 ** step)) + 1e-6)
            mb, vb = 0.9 * mb + 0.1 * e.sum(), 0.999 * vb + 0.001 * e.sum() ** 2
            bias -= rate * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.999 ** step)) + 1e-6)
    model.w0 = float(bias)
    model.w[vocabulary], model.v[vocabulary] = p[:, 0], p[:, 1:]
    return model


def _features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [terms(t, bits) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))],
                                         ["y", "ids"])


def train(docs: DataFrame, labels: DataFrame, where: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS,
          bits: int = 18) -> Model:
    """Fits on the labelled rows for which ``where`` (over ``id``) holds."""
    bounded_batches(docs.sparkSession)
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
            .where(F.col("y").isin(0, 1) & where))
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    rate = F.lit(0.0)
    for y, n in counts.items():
        rate = F.when(F.col("y") == y, F.lit(min(1.0, per_class / n))).otherwise(rate)
    # at most about 2 * per_class rows of two numbers: bounded, so it may be broadcast
    sample = rows.where(F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 20)) < rate * (1 << 20))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    got = (docs.select(F.col(id_col).alias("id"), text.alias("t"))
           .join(F.broadcast(sample), "id").select("y", "t")
           .mapInArrow(lambda it: _features(it, bits), "y int, ids array<long>").toArrow())
    ids = [np.array(x, np.int64) for x in got.column("ids").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i].tobytes(), got.column("y")[i].as_py()))
    return fit([ids[i] for i in order], np.array([got.column("y")[i].as_py() for i in order]), bits)


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = model.value
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        scores = [m.score(terms(t or b"", m.bits)) for t in text.cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                         [*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score``."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).alias("scored_text")).mapInArrow(
        lambda it: _score(it, shared), schema + ", score double")


def _clean(batches: Iterator[pa.RecordBatch], model, at: int, least: float) -> Iterator[pa.RecordBatch]:
    m = model.value
    for batch in batches:
        texts = batch.column(at).cast(pa.binary()).to_pylist()
        yield batch.filter(pa.array([m.score(terms(t or b"", m.bits)) < least for t in texts], pa.bool_()))


def clean(docs: DataFrame, model: Model, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``least``, with all their columns."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _clean(it, shared, at, least), docs.schema)
