"""Helpers shared by the operators: word splitting, sequence hashes, written
intermediate tables and connected components."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import lake_root

#: A word is a maximal run of characters other than space and TAB..CR.
SPACES = r"[\x20\x09-\x0D]+"


#: Texts are read, and go to Python workers, in batches of bounded size: by default
#: a batch holds 4,096 rows of a file or 10,000 (up to 64 MB) on the way to Python,
#: often a task's whole text, in the heap, beside it and in the worker.
TEXT_CONF = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def bounded_batches(spark: SparkSession) -> None:
    """Sets TEXT_CONF on the session, for the plans that are run from now on."""
    for k, v in TEXT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text (NULL: no words)."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(spaced, " "), "")     # one plain character: no regex split


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{lake_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (models, tokenizers)."""
    name = "_ledgerlake_worker_cache"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


# -- sequence hashes (numpy, inside tasks) -----------------------------------

#: Odd, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 64-bit integers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word; ``bytes.split()`` splits on exactly SPACES."""
    if seed:
        return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in text.split()], np.uint64)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text.split()), np.uint64)


class SequenceHash:
    """Hashes of any runs of a hashed word sequence, by prefix sums mod 2**64."""

    def __init__(self, h: np.ndarray):
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * _powers(_BASE, len(h)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(h) + 1)

    def runs(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` words from each ``start``."""
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start])

    def windows(self, k: int) -> np.ndarray:
        """Hash of every run of k words, in order."""
        n = len(self.sums) - k
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n])


# -- connected components ----------------------------------------------------

def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component_id): smallest id reachable over undirected ``edges`` (a, b).

    Large-star / small-star contraction: each round links every vertex to the
    smallest neighbour, by one ``min`` aggregate and one join, so a vertex with
    any number of neighbours is never gathered into one row.  The edge table is
    written each round (shared folder), which cuts the lineage.  Ids that occur
    in no edge are not returned.
    """
    def least(sym: DataFrame) -> DataFrame:
        return sym.groupBy("a").agg(F.min("b").alias("m"))

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(F.struct("a", "b"),
                                          F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.*")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                     F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), name)
    seen = state(cur)
    while seen[0]:
        # the minima are written, so the joins below are of plain tables and a
        # vertex with very many neighbours can be split over tasks
        # large star: neighbours above a vertex link to the least of its neighbourhood
        sym = both(cur)
        m = written(least(sym).select("a", F.least("a", "m").alias("m")), name + "-least")
        large = written(sym.where("b > a").join(m, "a")
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name + "-large")
        # small star: a vertex and its smaller neighbours link to the least of them
        m = written(least(large), name + "-least")
        small = (large.join(m, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        cur = written(small.union(m.select("a", F.col("m").alias("b"))).distinct(), name)
        before, seen = seen, state(cur)
        if seen == before:
            break
    m = cur.groupBy("a").agg(F.min("b").alias("m"))
    roots = cur.select(F.col("b").alias("id")).distinct()
    return (m.select(F.col("a").alias("id"), F.col("m").alias("component_id"))
            .union(roots.join(m, roots.id == m.a, "left_anti")
                   .select("id", F.col("id").alias("component_id"))))
