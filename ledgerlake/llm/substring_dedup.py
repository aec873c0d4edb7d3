"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed relative to one reference: all documents, each at an
address of its own in one 64-bit space (a hash of its id and text; the word i
of a document lies i further on).  The reference is indexed in blocks that are
cut by content, so equal passages are cut equally wherever they stand: of each
run of ``length`` words (a window) the k-gram with the least hash is its
anchor, and the neighbouring windows with one anchor form a block, the words
they cover.

1. Index.  Blocks are counted by anchor; a block whose anchor occurs nowhere
   else ends there.  This is one aggregate over about 2 / (length - k + 2) of
   the words.  With the count go the least and greatest address, so every block
   found again has a reference that is not itself.
2. Parse.  A document reads as its sequence of blocks, each with its reference.
   A block that continues the reference of the one before it extends the
   current factor; otherwise the next factor begins after the words it covers.
   The index keeps one reference of a block, not all, so a passage held by many
   documents may read as several factors in a row; the words covered are the same.
3. Factor boundaries.  A block that shares its anchor but not all its words
   is where a factor ends (or another begins), and a factor may reach into it:
   there, and only there, windows are looked up one by one, against the
   windows of all blocks with that anchor.
4. The words of all factors, which match for ``length`` words or more, are the
   duplicate spans; they go.

Equal blocks are counted before they are shuffled and one of them stands for
all, so thousands of copies cost as much as two.  The joins are on keys with one
row on the index's side, which knows how many rows meet it: a key with more than
one in ``HEAVY`` of them is dealt over ``SALTS`` tasks, and there are fewer than
``HEAVY`` such keys whatever the input.  Hashes that decide have 128 bits.

Defined results: NULL or empty text and texts under ``length`` words lose
nothing (the hash of no words is that of the empty string); repeated rows are
duplicates of each other, at one address; rows with NULL ids are parsed as the
others; texts of any length are parsed whole, by one task each; of equal passages
none is spared, and of several references the least address counts, so there are
no ties; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SequenceHash, mix, word_hashes, written

#: Words of the k-gram that anchors a block.
ANCHOR_WORDS = 8
#: A join key with more than one in HEAVY of the rows is dealt over SALTS tasks.
HEAVY, SALTS = 1024, 32


def _anchors(h: np.ndarray, length: int, k: int):
    """Anchor position of each window, leftmost least hash, and k-gram hashes."""
    seq = SequenceHash(h)
    grams = seq.windows(k)
    n = len(grams)
    low = np.uint64((1 << 32) - 1)                 # hash above, position below
    key = (grams & ~low) | np.arange(n, dtype=np.uint64)
    m, width, span = key, 1, length - k + 1
    while width * 2 <= span:                       # minima of runs of 2, 4, 8, ...
        m, width = np.minimum(m[:-width], m[width:]), width * 2
    if width < span:
        m = np.minimum(m[:len(m) - (span - width)], m[span - width:])
    return (m & low).astype(np.int64), grams, seq


def _blocks(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, anchor, block, place, count): the blocks of each text."""
    for batch in batches:
        parts = []
        base = batch.column(0).to_numpy()
        for i, text in enumerate(batch.column(2).to_pylist()):
            h = word_hashes(text)
            if len(h) < length:
                continue
            at, grams, seq = _anchors(h, length, k)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            count = np.diff(first, append=len(at))
            anchor = at[first]
            inside = ((count + length).astype(np.uint64) << np.uint64(32)) | (anchor - first).astype(np.uint64)
            block = mix(seq.runs(first, count + length - 1) ^ mix(inside))
            parts.append((np.full(len(first), i), grams[anchor], block, base[i:i + 1] + first, count))
        if not parts:
            continue
        of, anchor, block, place, count = (np.concatenate(c) for c in zip(*parts))
        of = pa.array(of)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), batch.column(1).take(of), pa.array(anchor.view(np.int64)),
             pa.array(block.view(np.int64)), pa.array(place), pa.array(count.astype(np.int32))],
            ["k1", "k2", "anchor", "block", "place", "count"])


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, place, once, w1, w2): windows of the listed blocks."""
    for batch in batches:
        parts = []
        base, lists = batch.column(0).to_numpy(), batch.column(3)
        for i, text in enumerate(batch.column(2).to_pylist()):
            h = word_hashes(text)
            a, b = SequenceHash(h), SequenceHash(mix(h))
            place, count, once = (x.to_numpy(zero_copy_only=False) for x in lists[i].values.flatten())
            for first, n, o in zip((place - base[i:i + 1]).tolist(), count.tolist(), once.tolist()):
                s = np.arange(first, first + n)
                parts.append((np.full(n, i), base[i:i + 1] + s, np.full(n, o),
                              a.runs(s, length), b.runs(s, length)))
        if not parts:
            continue
        of, place, once, w1, w2 = (np.concatenate(c) for c in zip(*parts))
        of = pa.array(of)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), batch.column(1).take(of), pa.array(place),
             pa.array(once.astype(bool)), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64))],
            ["k1", "k2", "place", "once", "w1", "w2"])


def parse(first: np.ndarray, count: np.ndarray, shift: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Factors (start, end, shift) of one document, in order: runs of ``count``
    windows from ``first`` that the reference holds ``shift`` further on.

    A run that goes on where the last one ends, by the same shift, extends its
    factor; another one's factor begins after the words already covered.
    """
    out: list[list[int]] = []
    for i in np.argsort(first, kind="stable").tolist():
        a, end, by = int(first[i]), int(first[i] + count[i]) + length - 1, int(shift[i])
        if out and a <= out[-1][1] and (by == out[-1][2] or end <= out[-1][1]):
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([max(a, out[-1][1]) if out else a, end, by])
    return [tuple(x) for x in out]


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_removed, spans, factors, kept): spans are removed."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    factor = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("reference", pa.int64())]))
    for batch in batches:
        n_words, n_removed, spans, found, kept = [], [], [], [], []
        base, runs = batch.column(1).to_numpy(), batch.column(3)
        for i, text in enumerate(batch.column(2).to_pylist()):
            w = text.split()
            own, out, done, factors = [], [], 0, []
            if runs[i].is_valid:
                place, count, ref = (x.to_numpy() for x in runs[i].values.flatten())
                factors = parse(place - base[i:i + 1], count, ref - place, length)
            for a, b, _ in factors:
                if own and a <= own[-1][1]:
                    own[-1][1] = b
                else:
                    own.append([a, b])
            for a, b in own:
                out += w[done:a]
                done = b
            out += w[done:]
            n_words.append(len(w))
            n_removed.append(len(w) - len(out))
            spans.append([{"start": a, "end": b} for a, b in own])
            start, end, by = np.array(factors, np.int64).reshape(-1, 3).T
            found.append([{"start": a, "length": n, "reference": at} for a, n, at in zip(
                start.tolist(), (end - start).tolist(), (base[i] + start + by).tolist())])
            kept.append(b" ".join(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(spans, span), pa.array(found, factor), pa.array(kept, pa.binary())],
            ["doc_id", "n_words", "n_removed", "spans", "factors", "kept"])


def _salted(left: DataFrame, index: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``left`` (with ``place``) joined to ``index``, unique by ``keys``, whose
    ``n`` says how many rows meet a key: those of heavy keys are dealt over tasks."""
    index = written(index, name)
    total = index.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") * HEAVY > F.lit(total)              # true of fewer than HEAVY keys
    marks = index.where(heavy).select([F.col(k).alias(f"heavy_{k}") for k in keys])
    met = [F.col(k) == F.col(f"heavy_{k}") for k in keys]
    salt = F.when(F.col(f"heavy_{keys[0]}").isNull(), F.lit(0)) \
        .otherwise(F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
    left = left.join(F.broadcast(marks), met, "left").withColumn("salt", salt).drop(*marks.columns)
    dealt = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(index.withColumn("salt", F.explode(dealt)).drop("n"), [*keys, "salt"]).drop("salt")


def runs(docs: DataFrame, length: int = 35, k: int = ANCHOR_WORDS) -> DataFrame:
    """(k1, k2, place, count, ref): runs of windows that start elsewhere too, and
    one address where they do.

    ``docs`` has (k1, k2, text as binary); k1 and k2 tell rows apart, and k1 is
    a document's address.
    """
    other = F.expr("IF(place = at, until, at) AS ref")
    ends_of = [F.min("place").alias("at"), F.max("place").alias("until")]
    blocks = docs.mapInArrow(
        lambda it: _blocks(it, length, k),
        "k1 long, k2 long, anchor long, block long, place long, count int")
    # the index: anchors that occur more than once, and whether always in one block
    shared = (blocks.groupBy("anchor")
              .agg(F.count("*").alias("n"), F.min("block").alias("lo"), F.max("block").alias("hi"), *ends_of)
              .where("n > 1").selectExpr("anchor", "n", "lo < hi AS differs", "at", "until"))
    blocks = written(_salted(blocks, shared, ["anchor"], "rlz-anchors")
                     .select("k1", "k2", "anchor", "block", "place", "count", "differs", other), "rlz-blocks")
    whole = blocks.where("NOT differs").select("k1", "k2", "place", "count", "ref")
    # where blocks of an anchor differ: those found twice extend factors, the rest are boundaries
    mixed = blocks.where("differs").drop("differs", "ref")
    kinds = written(mixed.groupBy("anchor", "block")
                    .agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "place", "count")],
                         *ends_of), "rlz-kinds")
    twice = _salted(mixed, kinds.where("n > 1").select("anchor", "block", "n", "at", "until"),
                    ["anchor", "block"], "rlz-twice")
    whole = whole.unionByName(twice.select("k1", "k2", "place", "count", other))
    open_ = (kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
             .where("least = 1").select("anchor", F.col("kinds").alias("n")))
    ends = (_salted(kinds.select("anchor", "k1", "k2", "place", "count", (F.col("n") == 1).alias("once")),
                    open_, ["anchor"], "rlz-open")
            .groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "count", "once")).alias("blocks")))
    windows = written(
        docs.join(ends, ["k1", "k2"]).select("k1", "k2", "text", "blocks")
        .mapInArrow(lambda it: _windows(it, length),
                    "k1 long, k2 long, place long, once boolean, w1 long, w2 long"), "rlz-windows")
    # a window of a block that stands for several is found elsewhere already
    again = (windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.every("once").alias("o"), *ends_of)
             .where("n > 1 OR NOT o").select("w1", "w2", "n", "at", "until"))
    part = _salted(windows.where("once"), again, ["w1", "w2"], "rlz-again") \
        .select("k1", "k2", "place", F.lit(1).alias("count"), other)
    return whole.unionByName(part)


def dedup(docs: DataFrame, length: int = 35, k: int = ANCHOR_WORDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, factors, kept): the word spans [start,
    end) that factors cover, the factors with their reference's address, and the
    words left, joined by one space (binary)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")) \
        .select("doc_id", F.xxhash64("doc_id", "text").alias("k1"),
                F.xxhash64("text", "doc_id").alias("k2"), F.col("text").cast("binary").alias("text"))
    found = (runs(d.drop("doc_id"), length, k).groupBy("k1", "k2")
             .agg(F.collect_set(F.struct("place", "count", "ref")).alias("runs")))
    kind = d.schema["doc_id"].dataType.simpleString()
    return (d.join(found, ["k1", "k2"], "left")
            .select("doc_id", "k1", "text", "runs")
            .mapInArrow(lambda it: _cut(it, length),
                        f"doc_id {kind}, n_words long, n_removed long, "
                        "spans array<struct<start:bigint,end:bigint>>, "
                        "factors array<struct<start:bigint,length:bigint,reference:bigint>>, kept binary"))
