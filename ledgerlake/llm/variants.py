"""Spelling variant grouping by a variable-length gram index.

1. Words.  Runs of letters are counted in every task before they are shuffled.
2. Gram dictionary.  Grams of ``Q_MIN`` to ``Q_MAX - 1`` code points (a word's
   beginning and end are code points too) are counted over all words; the ones
   in more than ``SHARE`` of the words are frequent.  Rare ones are pruned: a
   gram is only ever extended while it is frequent.
3. Decomposition.  Every place of a word gives one gram: the shortest one there
   that is not frequent, or ``Q_MAX`` code points.
4. Affected grams.  Which gram a place gives depends on that gram's code points
   alone.  So an edit at a place can only change the grams that hold it, and
   words one edit apart share all others, at the same distance from the
   beginning (left of the edit) or from the end (right of it).
5. List merging.  The bound of 4 is taken per word and place: all lists of the
   grams that an edit there leaves alone are merged at once, by a join on one
   hash of those grams, so no long list of a single gram is ever read.  A word
   has a key per code point (one deleted or replaced) and per gap (one inserted).
6. Verification.  The words of a key are compared directly around the place,
   which must be the first where they differ: each pair is found once.

At scale: words that share a key differ in at most ``Q_MAX`` neighbouring code
points, so a key's words are bounded by the alphabet, not by the number of
words, and so are a word's near words.  The dictionary has at most ``MOST_GRAMS``
entries.  Keys carry the word itself up to ``CARRIED`` code points, else a hash
that is joined back.

Defined results: NULL and empty texts have no words; texts of any length are
whole; a NULL doc_id counts as empty text; equally frequent near words: the
least in code-point order; repeated rows count again; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import mix, written

Q_MIN, Q_MAX = 2, 4
#: A gram in more than this share of the words is frequent; frequent grams kept at most.
SHARE, MOST_GRAMS = 0.002, 1 << 18
#: Code points of a word that its keys carry.
CARRIED = 256
#: Words that a counting task holds before it hands them on.
HELD = 1 << 19
#: a-z, U+00C0 to U+00FF make words; A-Z are lower-cased; all else separates.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_START, _END = 0x110000, 0x110001


# -- words -------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch], least: int, typo: int | None) -> Iterator[pa.RecordBatch]:
    """(word, n) of (doc_id as text, text); one in ``typo`` runs loses a code point."""
    held: dict[bytes, int] = defaultdict(int)

    def result():
        words = [w.decode("latin-1") for w in held]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            # one byte per code point; what Latin-1 lacks becomes "?", which separates
            runs = [r for r in text.encode("latin-1", "replace").translate(LETTERS).split() if len(r) >= least]
            if typo is None:
                for r in runs:
                    held[r] += 1
                continue
            begin = zlib.crc32(f"{i}:".encode())
            for r in runs:
                h = zlib.crc32(r if r.isascii() else r.decode("latin-1").encode(), begin)
                if h % typo == 0:
                    at = h % len(r)
                    r = r[:at] + r[at + 1:]
                    if len(r) < least:
                        continue
                held[r] += 1
            if len(held) > HELD:
                yield result()
                held.clear()
    if held:
        yield result()


def vocabulary(docs: DataFrame, least_length: int = 7, least_n: int = 2, typo: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): lower-cased runs of letters and how often they occur.

    ``typo``: seeded misspellings, for trials: of a run whose crc32 with its
    document's id is divisible by it, one code point is deleted."""
    d = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return (d.mapInArrow(lambda it: _count(it, least_length, typo), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


# -- grams -------------------------------------------------------------------

def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, code points with _START and _END as a matrix) per length."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        for own in np.array_split(rows, max(1, len(rows) * n >> 20)):
            c = np.frombuffer("".join(words[i] for i in own.tolist()).encode("utf-32-le"), "<u4")
            m = np.empty((len(own), n + 2), np.uint64)
            m[:, 0], m[:, -1] = _START, _END
            m[:, 1:-1] = c.reshape(len(own), n)
            yield own, m


def _grams(m: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q code points from every place that has as many."""
    h = m[:, :m.shape[1] - q + 1] + np.uint64(q)
    for k in range(1, q):
        h = h * _BASE + m[:, k:m.shape[1] - q + 1 + k]
    return mix(h)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): hashes of the grams that may be extended."""
    for batch in batches:
        found = [np.unique(_grams(m, q).ravel(), return_counts=True)
                 for _, m in _by_length(batch.column(0).to_pylist()) for q in range(Q_MIN, Q_MAX)]
        for h, n in found:
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))],
                                             ["gram", "n"])


def dictionary(words: DataFrame) -> np.ndarray:
    """Sorted hashes of the frequent grams, at most ``MOST_GRAMS``."""
    over = int(words.count() * SHARE)
    rows = (words.select("word").mapInArrow(_count_grams, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > over)
            .orderBy(F.desc("n"), "gram").limit(MOST_GRAMS).collect())
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def _held(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(x.shape, bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)] == x


def decompose(m: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, length) of the gram at every place but the last of the matrix."""
    gram = _grams(m, Q_MIN)
    length = np.full(gram.shape, Q_MIN)
    grows = _held(frequent, gram)
    for q in range(Q_MIN + 1, Q_MAX + 1):
        if m.shape[1] < q:
            break
        longer = _grams(m, q)
        grows = grows[:, :longer.shape[1]]
        gram[:, :longer.shape[1]][grows] = longer[grows]
        length[:, :longer.shape[1]][grows] = q
        grows = grows & _held(frequent, longer)
    return gram, length


def keys(m: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the grams that an edit leaves alone: per code point (deleted or
    replaced) and per gap (inserted before it)."""
    n = m.shape[1] - 2
    gram, length = decompose(m, frequent)
    places = np.arange(n + 1)                              # of grams; code point e stands at e + 1
    left = np.zeros((len(m), n + 3), np.uint64)            # left[:, e]: sum over grams that end before e
    weight = mix(places.astype(np.uint64) + np.uint64(1))
    for q in range(Q_MIN, Q_MAX + 1):
        if n + 2 - q < 0:
            continue
        at = places[:n + 3 - q]                            # these end at at + q <= n + 2
        left[:, at + q] += np.where(length[:, at] == q, gram[:, at] * weight[at], np.uint64(0))
    left = np.cumsum(left, axis=1, dtype=np.uint64)
    right = np.zeros((len(m), n + 2), np.uint64)           # right[:, p]: sum over grams from p on
    back = mix((n - places).astype(np.uint64) + np.uint64(1 << 32))
    right[:, :n + 1] = np.cumsum((gram * back)[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    e = np.arange(n + 1)
    place = mix(e.astype(np.uint64) + np.uint64(1 << 40))
    # code point e is at e + 1 of the matrix: grams left of it end at e + 1 at the latest
    gaps = mix(left[:, e + 1] + right[:, e + 1] * _BASE + place)
    e = e[:n]
    return mix(left[:, e + 1] + right[:, e + 2] * _BASE + place[:n]), gaps


def _post(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, place, gap, word, id, n) of (word, id, n)."""
    names = ["key", "place", "gap", "word", "id", "n"]
    for batch in batches:
        words = batch.column(0).to_pylist()
        for own, m in _by_length(words):
            size = m.shape[1] - 2
            step = max(1, (1 << 19) // (2 * size + 1))
            for at in range(0, len(own), step):
                points, gaps = keys(m[at:at + step], frequent)
                for k, gap in ((points, False), (gaps, True)):
                    of = pa.array(np.repeat(own[at:at + step], k.shape[1]))
                    word = batch.column(0).take(of) if size <= CARRIED else pa.nulls(len(of), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k.ravel().view(np.int64)),
                         pa.array(np.tile(np.arange(k.shape[1], dtype=np.int32), len(k))),
                         pa.array(np.full(len(of), gap)), word, batch.column(1).take(of),
                         batch.column(2).take(of)], names)


#: Two words of a key, x with a gap or a code point at the place, y with a code point.
VERIFIED = """
CASE WHEN gap THEN length(y) = length(x) + 1 AND substring(x, place + 1) = substring(y, place + 2)
              AND substring(x, place + 1, 1) <> substring(y, place + 1, 1)
     ELSE length(y) = length(x) AND substring(x, place + 2) = substring(y, place + 2)
          AND substring(x, place + 1, 1) < substring(y, place + 1, 1) END
AND substring(x, 1, place) = substring(y, 1, place)"""


def links(words: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(x, nx, y, ny): every pair of words one edit apart, once."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)
    w = words.select("word", F.xxhash64("word").alias("id"), "n")

    def met(some: DataFrame) -> DataFrame:
        posts = some.mapInArrow(lambda it: _post(it, shared.value),
                                "key long, place int, gap boolean, word string, id long, n long")
        a = posts.select("key", "place", "gap", F.col("word").alias("x"), F.col("id").alias("ix"),
                         F.col("n").alias("nx"))
        b = posts.where("NOT gap").select(F.col("key").alias("k"), F.col("place").alias("p"),
                                          F.col("word").alias("y"), F.col("id").alias("iy"), F.col("n").alias("ny"))
        return a.join(b, F.expr("key = k AND place = p"))

    found = met(w.where(F.length("word") <= CARRIED)).where(VERIFIED).select("x", "nx", "y", "ny")
    # words too long to carry (and those just not): strings are joined back
    long = w.where(F.length("word") >= CARRIED)
    apart = (met(long).where("(x IS NULL OR y IS NULL) AND (gap OR ix <> iy)")
             .select("place", "gap", "ix", "nx", "iy", "ny"))
    back = (apart.join(long.select(F.col("word").alias("x"), F.col("id").alias("i")), F.expr("ix = i"))
            .join(long.select(F.col("word").alias("y"), F.col("id").alias("j")), F.expr("iy = j"))
            .where(VERIFIED).select("x", "nx", "y", "ny"))
    return found.unionByName(back)


# -- groups ------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms (word, form) lead to.

    Every form is more frequent than its word, so paths end; each round joins
    the paths with themselves, so they double."""
    cur = written(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        step = cur.select(F.col("word").alias("w"), F.col("root").alias("further"))
        cur = written(cur.join(step, F.col("root") == F.col("w"), "left")
                      .select("word", F.coalesce("further", "root").alias("root"),
                              F.col("further").isNotNull().alias("moved")), "variants-roots")
        if cur.where("moved").isEmpty():
            return cur.select("word", "root")


def group(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word, n): a word's form is its
    most frequent near word if that is ``ratio`` times as frequent."""
    words = written(words, "variants-words")
    found = written(links(words, dictionary(words)), "variants-links")
    side = F.explode(F.array(F.struct(F.col("x").alias("of"), F.col("y").alias("near"), F.col("ny").alias("m")),
                             F.struct(F.col("y").alias("of"), F.col("x").alias("near"), F.col("nx").alias("m"))))
    near = (found.select(side.alias("e")).select("e.*").groupBy("of")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best")))
    has = -F.col("best.m") >= ratio * F.col("n")
    out = written(words.join(near, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n")), "variants-forms")
    last = roots(out.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return (out.join(last, F.col("word") == F.col("of"), "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
