"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; a vector passes it if its inner product with the
direction reaches a threshold, that is, if it lies in a cap of the sphere.
Near vectors share caps.  The directions are a random product code: after a
random rotation the space is cut into ``BLOCKS`` blocks with ``CODEWORDS``
random unit vectors each, and every combination of one codeword per block is a
direction.  So ``CODEWORDS ** BLOCKS`` filters need a small table only, and a
vector is list-decoded: partial sums that cannot reach the threshold any more
are dropped block by block, so the cost follows the filters found.

A vector is listed in all filters it passes and probes with its best one.  A
pair is found where one probes a filter that lists the other, and verified by
the cosine in double precision.

Equal vectors are one class with a count.  Filters with many members are cut
into chunks of ``CHUNK`` probes and ``CHUNK`` listed vectors; each pair of
chunks is one matrix product, which returns link counts and a spanning forest
of the links, never the links themselves.  A pair that both sides find is
counted where each probes; one that only one side finds is counted for both
there, so every found pair counts once for each.

Defined results: vectors that are NULL, zero or have NULL or non-finite
components, or whose label is NULL, link with nothing; vectors of unlike
dimension too; a NULL id links with nothing and has a NULL component; repeated
rows are vectors of their own; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, worker_cache, written

BLOCKS, CODEWORDS = 2, 256
#: Threshold in standard deviations of a random inner product, 1 / sqrt(dim).
CAP = 3.0
#: Below this dimension the threshold is what a link's partner must still reach.
LOW_DIM = 48
#: Probes and listed vectors of a filter that are compared at once.
CHUNK = 2048


class Code:
    """The filters of one dimension.

    In few dimensions caps of ``CAP`` deviations would be smaller than the
    distance from a vector to its best filter.  If x has the product b with its
    best filter f and cos(x, y) >= c, then <f, y> is c b plus sqrt(1 - c^2) times
    the product of f with a unit vector orthogonal to x, which is sqrt(1 - b^2) at
    most, and seldom over three deviations of that.  The threshold takes the b that
    one random vector in a thousand falls short of.  There are fewer filters, too:
    their number follows the dimension.
    """

    def __init__(self, dim: int, seed: int = 5, least: float = 0.98):
        rng = np.random.default_rng((seed, dim))
        blocks = min(BLOCKS, dim)
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = [dim * b // blocks for b in range(blocks + 1)]
        self.words = []
        self.n = CODEWORDS if dim >= 32 else 4 * dim
        for a, b in zip(self.cuts, self.cuts[1:]):
            c = rng.normal(size=(self.n, b - a))
            self.words.append(c / np.linalg.norm(c, axis=1, keepdims=True) / blocks ** 0.5)
        self.threshold = CAP / dim ** 0.5
        if dim < LOW_DIM:
            best = self.scores(_unit(rng.normal(size=(4000, dim)))).max(axis=2).sum(axis=1)
            b = np.quantile(best, 0.001)
            away = min(1.0, CAP / max(dim - 1, 1) ** 0.5) * ((1 - least ** 2) * max(1 - b * b, 0.0)) ** 0.5
            self.threshold = min(self.threshold, least * b - away)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(vectors, blocks, codewords) of unit vectors."""
        y = x @ self.rotation
        return np.stack([y[:, a:b] @ c.T for a, b, c in zip(self.cuts, self.cuts[1:], self.words)], 1)

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Filters that one vector, (blocks, codewords), passes."""
        most = np.append(np.cumsum(scores.max(axis=1)[::-1])[::-1], 0.0)
        f, total = np.zeros(1, np.int64), np.zeros(1)
        for b, s in enumerate(scores):
            total = total[:, None] + s[None]
            i, j = np.nonzero(total + most[b + 1] >= self.threshold)
            f, total = f[i] * self.n + j, total[i, j]
        return f

    def best(self, scores: np.ndarray) -> np.ndarray:
        """Best filter of each vector."""
        f = np.zeros(len(scores), np.int64)
        for b in range(scores.shape[1]):
            f = f * self.n + scores[:, b].argmax(axis=1)
        return f

    def at(self, scores: np.ndarray, filters: np.ndarray) -> np.ndarray:
        """(vectors, filters) inner products."""
        out, rest = 0.0, filters
        for b in range(scores.shape[1] - 1, -1, -1):
            out = out + scores[:, b][:, rest % self.n]
            rest = rest // self.n
        return out


def code(dim: int, least: float) -> Code:
    cache = worker_cache()
    if ("code", dim, least) not in cache:
        cache["code", dim, least] = Code(dim, least=least)
    return cache["code", dim, least]


def _unit(vectors: list) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)         # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _filters(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(rep, filter, best): the filters each vector is listed in."""
    for batch in batches:
        vectors = batch.column(1).to_pylist()
        dims = np.array([len(v) for v in vectors])
        of, filters, best = [], [], []
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            c = code(int(dim), least)
            scores = c.scores(_unit([vectors[i] for i in own]))
            for i, s, top in zip(own, scores, c.best(scores)):
                f = c.decode(s)
                f = np.append(f[f != top], top)
                of.append(np.full(len(f), i))
                filters.append(f)
                best.append(f == top)
        if of:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.concatenate(of))), pa.array(np.concatenate(filters)),
                 pa.array(np.concatenate(best))], ["rep", "filter", "best"])


def _compare(x: list, y: list, least: float) -> tuple[list, list, list]:
    """(a, b, links) rows of one chunk: x probes, y listed, both lists of
    (rep, copies, own best filter, vector).  Links of a, with b NULL; edges
    a - b, with links 0."""
    u, v = _unit([r[3] for r in x]), _unit([r[3] for r in y])
    xi, yi = np.array([r[0] for r in x]), np.array([r[0] for r in y])
    link = (u @ v.T >= least) & (xi[:, None] != yi[None])
    if not link.any():
        return [], [], []
    rows, cols = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    link, xi, yi = link[np.ix_(rows, cols)], xi[rows], yi[cols]
    c = code(u.shape[1], least)
    xf, yf = np.array([x[i][2] for i in rows]), np.array([y[i][2] for i in cols])
    back = (c.at(c.scores(u[rows]), yf) >= c.threshold) | (xf[:, None] == yf[None])
    copies_x = np.array([x[i][1] for i in rows], np.int64)
    copies_y = np.array([y[i][1] for i in cols], np.int64)
    n_x = link @ copies_y
    n_y = copies_x @ (link & ~back)
    root_x, root_y = xi.copy(), yi.copy()
    top = np.iinfo(np.int64).max
    while True:                                            # least id reachable in the chunk
        new_x = np.minimum(root_x, np.where(link, root_y[None], top).min(axis=1))
        new_y = np.minimum(root_y, np.where(link, new_x[:, None], top).min(axis=0))
        if (new_x == root_x).all() and (new_y == root_y).all():
            break
        root_x, root_y = new_x, new_y
    a = np.concatenate([xi, yi])
    root, n = np.concatenate([root_x, root_y]), np.concatenate([n_x, n_y])
    edge = np.flatnonzero(a != root)
    some = np.flatnonzero(n)
    return ([*a[some].tolist(), *a[edge].tolist()], [*[None] * len(some), *root[edge].tolist()],
            [*n[some].tolist(), *[0] * len(edge)])


def _chunks(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Compares chunk by chunk; rows come sorted by chunk (the first column)."""
    key, x, y = None, [], []

    def done():
        a, b, n = _compare(x, y, least) if x and y else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
            ["a", "b", "links"])

    for batch in batches:
        for k, probe, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key is not None:
                    yield done()
                key, x, y = k, [], []
            (x if probe else y).append(row)
    if key is not None:
        yield done()


def dedup(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id",
          vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row."""
    e = F.col("embedding")
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast("array<double>").alias("embedding"),
                       F.col(label_col).alias("label"))
    fine = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size(e) > 0)
            & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
            & F.exists(e, lambda c: c != 0))
    v = v.withColumn("fine", F.coalesce(fine, F.lit(False)))
    same = [F.when(F.col("fine"), F.xxhash64(F.lit(s), "label", "embedding")).alias(f"k{s}") for s in (1, 2)]
    v = written(v.select("*", *same), "caps-vectors")
    classes = (v.where("fine").groupBy("k1", "k2")
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    classes = written(
        v.where("fine").select("vec_id", "label", "embedding", "k1", "k2").join(classes, ["k1", "k2"])
        .where("vec_id = rep").dropDuplicates(["k1", "k2"])
        .select("k1", "k2", F.monotonically_increasing_id().alias("id"), "rep", "copies", "label", "embedding"),
        "caps-classes")

    listed = (classes.select("id", "embedding").mapInArrow(lambda it: _filters(it, least), "rep long, filter long, best boolean")
              .withColumnRenamed("rep", "id"))
    listed = listed.join(classes.select("id", "copies", F.col("label"), F.size("embedding").alias("dim")), "id")
    listed = written(listed, "caps-filters")
    cell = ["label", "dim", "filter"]
    probes = listed.where("best")
    sizes = probes.groupBy(*cell).agg(F.count("*").alias("probes"))
    held = listed.join(sizes, cell, "left_semi")            # filters that nobody probes fall away
    sizes = held.groupBy(*cell).agg(F.count("*").alias("held"), F.count_if("best").alias("probes"))
    # one vector alone in its filter has nothing to meet
    sizes = sizes.where("held > 1").selectExpr(
        *cell, f"cast(ceil(held / {CHUNK}) AS int) AS nh", f"cast(ceil(probes / {CHUNK}) AS int) AS np")
    held = held.join(sizes, cell)
    held = held.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    rows = (held.withColumn("probe", F.lit(False)).withColumn("c", F.expr("part % nh"))
            .withColumn("d", F.explode(F.expr("sequence(0, np - 1)")))
            .unionByName(held.where("best").withColumn("probe", F.lit(True))
                         .withColumn("d", F.expr("part % np"))
                         .withColumn("c", F.explode(F.expr("sequence(0, nh - 1)")))))
    best = probes.select("id", F.col("filter").alias("own"))
    rows = rows.join(best, "id").join(classes.select("id", "rep", "embedding"), "id")
    chunk = F.concat_ws("/", *cell, "c", "d")
    found = (rows.select(chunk.alias("chunk"), "probe", "id", "copies", "own", "embedding")
             .repartition("chunk").sortWithinPartitions("chunk")
             .mapInArrow(lambda it: _chunks(it, least), "a long, b long, links long"))
    found = written(found, "caps-found")

    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    rep = classes.select("id", "rep")
    edges = (found.where("b IS NOT NULL").join(rep.selectExpr("id AS a", "rep AS x"), "a")
             .join(rep.selectExpr("id AS b", "rep AS y"), "b").selectExpr("x AS a", "y AS b"))
    part = components(edges, "caps").withColumnRenamed("id", "of")
    result = (classes.join(counts, classes.id == counts.a, "left").join(part, classes.rep == part.of, "left")
              .selectExpr("k1", "k2", "coalesce(links, 0) + copies - 1 AS n_links",
                          "coalesce(component_id, rep) AS component_id"))
    return (v.select("vec_id", "k1", "k2").join(result, ["k1", "k2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
