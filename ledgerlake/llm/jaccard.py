"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document is the set of its distinct word n-grams (hashed to 64 bits).  Two
sets with Jaccard similarity J >= t share an n-gram among the first
``n - ceil(t n) + 1`` of each, in any one order of all n-grams; with rare ones
first, few sets meet there.

* Equal sets are one class; its least id stands for it.
* Order: document frequencies of all n-grams of all documents are counted in a
  table of ``2**TABLE_BITS`` hashed counters (fixed size, so it may be
  broadcast).  A counter is at least the frequency; the order is (logarithmic
  class of the counter, hash), the same for all documents, so the join stays
  exact whatever the table's precision.
* Prefix n-grams are joined on their hash.  Candidates pass the length filter,
  the positional filter (the place of the shared n-gram bounds the rest) and
  the suffix filter (sizes of ``BINS`` hash bins of both sets bound the
  overlap), and are verified on the whole sets.
* Hot groups.  Only links that tell classes apart matter for components, so a
  prefix n-gram's group is first compared with its least member only (as many
  candidates as members), and the links found are contracted.  Of the pairs
  left, only those in different components are joined; all others are linked
  already.  A group of thousands of near copies thus costs thousands of
  candidates, not their square, and no link between components is lost.
* Links.  All links lie inside components, so they are counted there: every two
  classes of a component are compared once, on their whole sets, weighted by
  their copies.  A component is dealt by hash into chunks of about ``CHUNK``
  classes and ``CHUNK_GRAMS`` n-grams; each pair of chunks is one block, which
  returns counts, never the links themselves.

``n_links`` counts the other rows with an id whose sets are similar enough,
copies included.

Defined results: NULL or empty text has the empty set and links with nothing;
fewer words than n make one n-gram of the whole sequence; rows that share an
id are one vertex; rows with NULL id link with nothing and get a NULL
component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SequenceHash, bounded_batches, components, mix, word_hashes, written

#: Counters of the frequency table, and counters in one of its blocks.
TABLE_BITS, BLOCK_BITS = 20, 10
#: Hash bins of the suffix filter.
BINS = 64
#: Ids up to which the set of documents to verify is broadcast (16 bytes each).
BROADCAST_IDS = 500_000
#: Classes and n-grams of a chunk of a component, and n-grams multiplied at once.
CHUNK, CHUNK_GRAMS, STEP = 512, 2_000_000, 4096


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; ``bytes.lower`` is A-Z only."""
    h = word_hashes(text.lower())
    if not len(h):
        return h
    if len(h) < n:
        whole = SequenceHash(h).runs(np.zeros(1, np.int64), len(h))
        return mix(whole ^ np.uint64(len(h)))
    return np.unique(SequenceHash(h).windows(n))


def _signature(g: np.ndarray) -> tuple[int, int]:
    return (int(mix(g).sum(dtype=np.uint64).view(np.int64)),
            int(mix(g ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)))


def _signatures(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, sig1, sig2) of each text, and the partition's counters in
    blocks (block, counts) at its end."""
    counts = np.zeros(1 << TABLE_BITS, np.uint32)
    kind = None
    for batch in batches:
        size, s1, s2 = [], [], []
        kind = batch.column(0).type
        for text in batch.column(1).to_pylist():
            g = shingles(text, n)
            np.add.at(counts, (g >> np.uint64(64 - TABLE_BITS)).astype(np.int64), 1)
            size.append(len(g))
            for out, own in zip((s1, s2), _signature(g)):
                out.append(own)
        k = len(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int32()), pa.array(s1, pa.int64()),
             pa.array(s2, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
            ["doc_id", "n", "sig1", "sig2", "block", "counts"])
    if kind is not None:
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        full = np.flatnonzero(blocks.any(axis=1))
        k = len(full)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, kind), *[pa.nulls(k, t) for t in (pa.int32(), pa.int64(), pa.int64())],
             pa.array(full, pa.int32()), pa.array([blocks[i].tobytes() for i in full], pa.binary())],
            ["doc_id", "n", "sig1", "sig2", "block", "counts"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up counter blocks as they stream by; a block in full is 8 KB."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = np.frombuffer(c, np.uint32)
            total[b] = total.get(b, 0) + c.astype(np.uint64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()),
         pa.array([_classes(c).tobytes() for c in total.values()], pa.binary())],
        ["block", "classes"])


def _classes(counts: np.ndarray) -> np.ndarray:
    """Counters as quarter-octave classes of one byte."""
    return np.floor(4 * np.log2(1.0 + counts)).astype(np.uint8)


def _prefixes(batches: Iterator[pa.RecordBatch], n: int, percent: int, table) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, bins, prefix) of each text with a word."""
    classes = np.frombuffer(table.value, np.uint8)
    for batch in batches:
        of, size, bins, prefix = [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            g = shingles(text, n)
            if not len(g):
                continue
            c = classes[(g >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
            order = np.argsort(c, kind="stable")          # g is sorted: ties by hash
            keep = len(g) - -(-percent * len(g) // 100) + 1
            of.append(i)
            size.append(len(g))
            bins.append(np.bincount((g & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
                        .astype(np.uint32).tobytes())
            prefix.append(g[order[:keep]].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(of, pa.int64())), pa.array(size, pa.int32()),
             pa.array(bins, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
            ["doc_id", "n", "bins", "prefix"])


def _suffix_filter(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose bins allow the overlap that their sizes need."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, BINS)
                for c in (2, 3))
        most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        total = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
        ok = (100 + percent) * most >= percent * total
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingles(t, n).tobytes() for t in batch.column(1).to_pylist()],
                                       pa.binary())], ["id", "grams"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose sets are similar enough."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]) \
            .filter(pa.array(ok, pa.bool_()))


def _links(pairs: DataFrame, docs: DataFrame, small: DataFrame, n: int, percent: int,
           name: str) -> DataFrame:
    """The distinct ``pairs`` (a, b) that are links, written."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ab = f"a {kind}, b {kind}"
    bins = small.select("doc_id", "bins")
    near = (pairs.join(bins.selectExpr("doc_id AS a", "bins AS x"), "a")
            .join(bins.selectExpr("doc_id AS b", "bins AS y"), "b").select("a", "b", "x", "y")
            .mapInArrow(lambda it: _suffix_filter(it, percent), ab))
    near = written(near, name + "-pairs")
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = written(ids, name + "-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = (docs.join(ids, F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text")
            .mapInArrow(lambda it: _sets(it, n), f"id {kind}, grams binary"))
    sets = written(sets, name + "-sets")
    links = (near.join(sets.selectExpr("id AS a", "grams AS x"), "a")
             .join(sets.selectExpr("id AS b", "grams AS y"), "b").select("a", "b", "x", "y")
             .mapInArrow(lambda it: _verify(it, percent), ab))
    return written(links.distinct(), name + "-links")


def _overlaps(x: list, y: list) -> np.ndarray:
    """(x, y) sizes of the intersections of two lists of sets."""
    nx, ny = [len(g) for g in x], [len(g) for g in y]
    gx, gy = np.concatenate(x), np.concatenate(y)
    _, col, seen = np.unique(np.concatenate([gx, gy]), return_inverse=True, return_counts=True)
    cx, cy = col[:len(gx)], col[len(gx):]
    both = np.zeros(len(seen), bool)                       # n-grams that both sides hold
    both[cx] = True
    held = np.zeros(len(seen), bool)
    held[cy] = True
    both &= held
    at = np.cumsum(both) - 1
    parts = []
    for c, sizes in ((cx, nx), (cy, ny)):
        own = np.repeat(np.arange(len(sizes)), sizes)[both[c]]
        c = at[c[both[c]]]
        order = np.argsort(c, kind="stable")
        parts.append((own[order], c[order]))
    out = np.zeros((len(x), len(y)), np.int64)
    for first in range(0, int(both.sum()), STEP):
        dense = []
        for (own, c), rows in zip(parts, (len(x), len(y))):
            a, b = np.searchsorted(c, [first, first + STEP])
            width = min(STEP, int(both.sum()) - first)
            m = np.zeros((rows, width), np.float32)        # sums up to STEP are exact
            m[own[a:b], c[a:b] - first] = 1
            dense.append(m)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def _block_links(x: dict, y: dict, percent: int) -> list[tuple[int, int, int]]:
    """(sig1, sig2, links) of the classes of one block, dicts of
    {(sig1, sig2): (copies, set)}; ``y`` is empty where a chunk meets itself."""
    if not x or (not y and len(x) < 2):
        return []
    same = not y
    y = y or x
    both = _overlaps([s for _, s in x.values()], [s for _, s in y.values()])
    nx, ny = (np.array([len(s) for _, s in v.values()], np.int64) for v in (x, y))
    link = 100 * both >= percent * (nx[:, None] + ny[None] - both)
    if same:
        np.fill_diagonal(link, False)
    wx, wy = (np.array([c for c, _ in v.values()], np.int64) for v in (x, y))
    out = [(*k, int(m)) for k, m in zip(x, link @ wy) if m]
    return out if same else out + [(*k, int(m)) for k, m in zip(y, wx @ link) if m]


def _count_links(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Counts block by block; rows (block, own, other, sig1, sig2, copies, text)
    come sorted by block."""
    key, x, y, pair = None, {}, {}, True

    def done():
        # a block of two chunks one of which is empty has no pairs
        rows = _block_links(x, y, percent) if not pair or (x and y) else []
        cols = list(zip(*rows)) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          ["sig1", "sig2", "links"])

    for batch in batches:
        for k, own, other, s1, s2, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key is not None:
                    yield done()
                key, x, y, pair = k, {}, {}, own != other
            g = shingles(text, n)
            if _signature(g) == (s1, s2):                  # not another row of the same id
                (x if own <= other else y)[s1, s2] = (copies, g)
    if key is not None:
        yield done()


def _class_links(classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(sig1, sig2, links): for the ``classes`` (sig1, sig2, rep, n, copies,
    component_id) that link, the rows of other classes that each links with."""
    sizes = (classes.groupBy("component_id").agg(F.count("*").alias("c"), F.sum("n").alias("grams"))
             .where("c > 1").selectExpr(
                 "component_id",
                 f"cast(ceil(greatest(c / {CHUNK}, grams / {CHUNK_GRAMS})) AS int) AS chunks"))
    members = (classes.join(sizes, "component_id")
               .withColumn("own", F.expr("cast(pmod(xxhash64(sig1, sig2), chunks) AS int)")))
    members = written(members.select("component_id", "rep", "sig1", "sig2", "copies", "chunks", "own"),
                      "jaccard-members")
    if members.count() <= BROADCAST_IDS:
        members = F.broadcast(members)
    rows = (docs.join(members, F.col("doc_id") == F.col("rep"))
            .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
            .withColumn("block", F.concat_ws("/", "component_id", F.least("own", "other"),
                                             F.greatest("own", "other"))))
    counts = (rows.select("block", "own", "other", "sig1", "sig2", "copies", "text")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(lambda it: _count_links(it, n, percent), "sig1 long, sig2 long, links long"))
    return written(counts.groupBy("sig1", "sig2").agg(F.sum("links").alias("links")), "jaccard-counts")


def join(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id",
         text_col: str = "text", count_links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id): one row per input row.

    Without ``count_links`` there is no ``n_links``; the components are the same.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    first = written(d.mapInArrow(
        lambda it: _signatures(it, n),
        f"doc_id {kind}, n int, sig1 long, sig2 long, block int, counts binary"), "jaccard-sets")
    rows = first.where("block IS NULL").select("doc_id", "n", "sig1", "sig2")
    sums = (first.where("block IS NOT NULL").select("block", "counts").repartition("block")
            .mapInArrow(_sum_blocks, "block int, classes binary")).collect()   # 2**TABLE_BITS bytes
    table = np.zeros((1 << (TABLE_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    for r in sums:
        table[r.block] = np.frombuffer(r.classes, np.uint8)
    shared = spark.sparkContext.broadcast(table.tobytes())

    # one class per set; its least id stands for it
    reps = (rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig1", "sig2")
            .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies")))
    reps = written(reps, "jaccard-reps")
    small = written(
        d.mapInArrow(lambda it: _prefixes(it, n, percent, shared),
                     f"doc_id {kind}, n int, bins binary, prefix array<bigint>")
        .join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "jaccard-prefixes")

    postings = small.select("doc_id", "n", F.posexplode("prefix").alias("pos", "h")).repartition("h")
    groups = (postings.groupBy("h").agg(F.count("*").alias("m"), F.min("doc_id").alias("hub"))
              .where("m > 1").select("h", "hub"))
    met = written(postings.join(groups, "h"), "jaccard-met")

    # every member with the least of its group, then what is still apart
    star = met.where("doc_id <> hub").selectExpr("hub AS a", "doc_id AS b").distinct()
    links = _links(star, d, small, n, percent, "jaccard-star")
    part = components(links, "jaccard-part")
    part = part.withColumnRenamed("id", "of")
    labelled = (met.join(part, met.doc_id == part.of, "left")
                .withColumn("part", F.coalesce("component_id", "doc_id")).drop("of", "component_id"))
    labelled = (labelled.join(part, labelled.hub == part.of, "left")
                .withColumn("hub_part", F.coalesce("component_id", "hub")).drop("of", "component_id"))
    labelled = written(labelled.where("doc_id <> hub"), "jaccard-parts")
    left = labelled.where("part <> hub_part")
    cols = ["h", "doc_id", "n", "pos", "part"]
    x = left.select([F.col(c).alias(f"x_{c}") for c in cols])
    y = labelled.select([F.col(c).alias(f"y_{c}") for c in cols])
    # the shared n-gram of a pair that comes first bounds the overlap by what follows it
    most = "least(x_n - x_pos, y_n - y_pos)"
    apart = (x.join(y, F.expr(f"""x_h = y_h AND x_part <> y_part
                AND 100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)
                AND {100 + percent} * {most} >= {percent} * (x_n + y_n)"""))
             .selectExpr("least(x_doc_id, y_doc_id) AS a", "greatest(x_doc_id, y_doc_id) AS b").distinct())
    links = links.union(_links(apart, d, small, n, percent, "jaccard-apart"))
    found = components(links, "jaccard").withColumnRenamed("id", "of")

    class_of = reps.join(found, reps.rep == found.of, "left") \
        .select("sig1", "sig2", "rep", "n", "copies", F.coalesce("component_id", "rep").alias("component_id"))
    links = F.lit(None).cast("long")
    if count_links:
        class_of = written(class_of, "jaccard-classes")
        class_of = class_of.join(_class_links(class_of, d, n, percent), ["sig1", "sig2"], "left")
        links = F.expr("copies - 1 + coalesce(links, 0)")
    class_of = class_of.select(F.col("sig1").alias("s1"), F.col("sig2").alias("s2"), "component_id",
                               links.alias("links"))
    in_class = F.col("n") > 0
    out = (rows.join(class_of, F.expr("sig1 = s1 AND sig2 = s2 AND n > 0"), "left")
           .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                   F.when(in_class & F.col("doc_id").isNotNull(), F.col("links"))
                   .otherwise(F.lit(0)).cast("long").alias("n_links"),
                   F.when(F.col("doc_id").isNull(), None)
                   .when(in_class, F.col("component_id")).otherwise(F.col("doc_id"))
                   .alias("component_id")))
    return out if count_links else out.drop("n_links")
