"""Benchmark decontamination by Wu-Manber multi-pattern search.

The test strings are all windows of ``window`` consecutive words of the
benchmark items (an item of fewer words is one window), written as their words
between single spaces.  Documents are written the same way, so an occurrence is
a plain substring.

* Strings are put in classes by length (powers of two).  A class looks at the
  first m bytes of its strings only, m being its shortest length.
* Block shift table: for the hash of each block of B bytes, how far the end of
  a match may be moved at least.  Blocks that no string holds skip m - B + 1
  bytes.
* Suffix-hash buckets: at a shift of 0 the last and first block of the m bytes
  select a bucket of strings; the rest of the string, up to the space that
  ends its last word, selects one of them by hash.
* Direct comparison with the bytes of the item decides.

The search runs over many places of a group of documents at once, each moving
by its own shifts (numpy), so long documents need no other treatment.

The strings are an index of bounded size: items are cut into pieces, the pieces
dealt into blocks of about ``BLOCK_BYTES``, and all documents searched for one
block after another (one block for benchmarks up to that size); only a block
is ever broadcast.  With one block documents are not shuffled at all.  A window that
many items hold is one string with a list of items.

Defined results: NULL and empty texts have no words and are clean; documents
of any length are whole; each row gets its own result, rows with one doc_id
too; items with one item_id are one item, those with a NULL id are one item
that is counted but not listed; items without words have no window; empty
tables give an empty result and clean documents; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import worker_cache, written

#: Bytes of item text in a block, and words of an item in a piece.
BLOCK_BYTES, PIECE_WORDS = 8 << 20, 5000
#: Bytes of document text searched at once, and of a place's share of them.
GROUP_BYTES, LANE = 8 << 20, 512
#: Bytes of a string's beginning that a class looks at, at most.
MOST = 256
SPANS = "array<struct<start:bigint,end:bigint>>"
#: a-z, 0-9 and bytes above 7F make words; A-Z are lower-cased.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
              for b in range(256))
_C = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _loads(buf: bytes) -> np.ndarray:
    """The 8 bytes at every place of ``buf`` (its last 8 bytes are padding)."""
    return np.ndarray((max(len(buf) - 7, 0),), "<u8", buf, 0, (1,))


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(item_id, piece): words of items between spaces, cut with an overlap."""
    for batch in batches:
        ids, pieces = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = words_of(text)
            for at in range(0, max(len(w) - window + 1, min(len(w), 1)), PIECE_WORDS):
                ids.append(i)
                pieces.append(b" ".join((b"", *w[at:at + PIECE_WORDS + window - 1], b"")))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, pa.binary())],
                                         ["item_id", "piece"])


class _Class:
    """Strings of one length class: their blocks' shifts and their buckets."""

    def __init__(self, eight: np.ndarray, start: np.ndarray, end: np.ndarray, n_words: np.ndarray):
        self.m = min(int((end - start).min()), MOST)
        self.longest = int((end - start).max())
        self.n_words = np.unique(n_words).tolist()
        self.b = min(self.m, 8)
        self.mask = np.uint64((1 << (8 * self.b)) - 1)
        blocks = len(start) * (self.m - self.b + 1)
        self.down = np.uint64(64 - min(max(blocks.bit_length() + 3, 12), 22))
        self.shift = np.full(1 << (64 - int(self.down)), self.m - self.b + 1, np.int16)
        for q in range(self.m - self.b + 1):               # later blocks allow smaller shifts
            self.shift[self.hash(eight[start + q])] = self.m - self.b - q
        self.buckets = np.unique(self.bucket(eight, start))

    def hash(self, block: np.ndarray) -> np.ndarray:
        return ((block & self.mask) * _C) >> self.down

    def bucket(self, eight: np.ndarray, start: np.ndarray) -> np.ndarray:
        last, first = eight[start + (self.m - self.b)] & self.mask, eight[start] & self.mask
        return (last * _C) ^ ((first * _C) >> np.uint64(17)) ^ first

    def places(self, eight: np.ndarray, size: int) -> np.ndarray:
        """Starts at which a string's first m bytes may stand."""
        if size < self.m:
            return np.empty(0, np.int64)
        first = np.arange(0, size - self.m + 1, LANE)      # a place moves through the starts of its lane
        at, stop = first + 0, np.minimum(first + LANE, size - self.m + 1)
        found, tail = [], self.m - self.b
        while len(at):
            move = self.shift[self.hash(eight[at + tail])]
            zero = move == 0
            if zero.any():
                found.append(at[zero])
                move[zero] = 1
            at = at + move
            left = at < stop
            if not left.all():
                at, stop = at[left], stop[left]
        if not found:
            return np.empty(0, np.int64)
        at = np.concatenate(found)
        key = self.bucket(eight, at)
        i = np.minimum(np.searchsorted(self.buckets, key), len(self.buckets) - 1)
        return at[self.buckets[i] == key]


class Index:
    """Test strings of one block of (item_id, piece) rows."""

    def __init__(self, rows: list[tuple], window: int):
        self.items = sorted({i for i, _ in rows if i is not None})
        number = {x: k for k, x in enumerate(self.items)}
        number[None] = len(self.items)
        self.text = b"".join(piece for _, piece in rows) + bytes(8)
        at, parts = 0, []
        for item, piece in rows:
            spaces = np.flatnonzero(np.frombuffer(piece, np.uint8) == 32) + at
            k = min(window, len(spaces) - 1)
            s = spaces[:len(spaces) - k]
            parts.append((s, spaces[k:] + 1, np.full(len(s), k), np.full(len(s), number[item])))
            at += len(piece)
        self.classes: list[_Class] = []
        self.hashes = np.empty(0, np.uint64)
        if not parts:
            return
        start, end, k, item = (np.concatenate(c) for c in zip(*parts))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(self.text[s:e]) for s, e in
                              zip(start.tolist(), end.tolist())), np.uint64, len(start))
        order = np.argsort(hashes, kind="stable")
        start, end, k, item, hashes = start[order], end[order], k[order], item[order], hashes[order]
        new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        for i in np.flatnonzero(~new).tolist():            # equal hashes: equal strings, as a rule
            j = i - 1
            while not new[j] and hashes[j] == hashes[i]:
                j -= 1
            if self.text[start[i]:end[i]] != self.text[start[j]:end[j]]:
                new[i] = True
        group = np.cumsum(new) - 1                         # distinct strings and the items of each
        pairs = np.unique(group * (len(number)) + item)
        self.held = pairs % len(number)
        self.held_from = np.searchsorted(pairs // len(number), np.arange(group[-1] + 2))
        self.hashes, self.start, self.end = hashes[new], start[new], end[new]
        eight, k = _loads(self.text), k[new]
        kind = np.floor(np.log2(self.end - self.start)).astype(int)
        self.classes = [_Class(eight, self.start[kind == c], self.end[kind == c], k[kind == c])
                        for c in np.unique(kind)]

    def string(self, found: bytes) -> int:
        """Number of the test string with these bytes, or -1."""
        h = np.uint64(xxhash.xxh3_64_intdigest(found))
        i = int(np.searchsorted(self.hashes, h))
        while i < len(self.hashes) and self.hashes[i] == h:
            if self.text[self.start[i]:self.end[i]] == found:
                return i
            i += 1
        return -1

    def search(self, text: bytes, spaces: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(space number, words, string) of every occurrence; ``text`` is padded."""
        eight = _loads(text)
        for c in self.classes:
            at = c.places(eight, len(text) - 8)
            if not len(at):
                continue
            i = np.minimum(np.searchsorted(spaces, at), len(spaces) - 1)
            i = i[spaces[i] == at]
            for n in c.n_words:
                own = i[i + n < len(spaces)]
                begin, end = spaces[own], spaces[own + n] + 1
                fits = end - begin <= c.longest
                for j, b, e in zip(own[fits].tolist(), begin[fits].tolist(), end[fits].tolist()):
                    s = self.string(text[b:e])
                    if s >= 0:
                        yield j, n, s


def _merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _batch(ids, rows: list[tuple]) -> pa.RecordBatch:
    """rows: (n_words, merged runs, item ids, with an item without an id or not)."""
    n_words, runs, items, unnamed = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
         pa.array([len(x) + u for x, u in zip(items, unnamed)], pa.int64()),
         pa.array([[{"start": a, "end": b} for a, b in r] for r in runs],
                  pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
         pa.array(items, pa.list_(pa.string()))],
        ["doc_id", "n_words", "n_hit", "n_items", "spans", "items"])


def _index(rows: list[tuple], window: int) -> Index:
    cache, key = worker_cache(), "decontaminate"
    if cache.get(key, (None,))[0] is not rows:             # a broadcast is read once a worker
        cache[key] = (None,)                               # one block at a time
        cache[key] = (rows, Index(rows, window))
    return cache[key][1]


def _scan(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_hit, n_items, spans, items) of (doc_id, text)."""
    for batch in batches:
        at, n = 0, batch.num_rows
        while at < n:                                      # groups of whole documents
            plain, size, to = [], 0, at
            while to < n and (size < GROUP_BYTES or to == at):
                w = words_of(batch.column(1)[to].as_py())
                plain.append(w)
                size += sum(map(len, w)) + len(w)
                to += 1
            yield _batch(batch.column(0).slice(at, to - at), _found(plain, index))
            at = to


def _found(plain: list[list[bytes]], index: Index) -> list[tuple]:
    # every document ends with a space and begins with one: a break is in no string
    text = b"\n".join(b" ".join((b"", *w, b"")) if w else b"" for w in plain) + bytes(8)
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    first = np.cumsum([0] + [len(w) + 1 if w else 0 for w in plain])      # number of a document's first space
    runs, strings = defaultdict(set), defaultdict(set)
    hits = list(index.search(text, spaces))
    if hits:
        doc = np.searchsorted(first, [j for j, _, _ in hits], "right") - 1
        for d, (j, n, s) in zip(doc.tolist(), hits):
            runs[d].add((j - int(first[d]), j - int(first[d]) + n))
            strings[d].add(s)
    out = []
    for d, w in enumerate(plain):
        if d not in runs:
            out.append((len(w), [], [], 0))
            continue
        held = np.unique(np.concatenate([index.held[index.held_from[s]:index.held_from[s + 1]]
                                         for s in strings[d]])).tolist()
        named = [index.items[k] for k in held if k < len(index.items)]
        out.append((len(w), _merged(runs[d]), named, len(held) - len(named)))
    return out


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of the blocks of each row together."""
    for batch in batches:
        rows = []
        for n_words, spans, items, unnamed in zip(*(c.to_pylist() for c in batch.columns[1:])):
            runs = [(x["start"], x["end"]) for own in spans for x in own]
            rows.append((n_words, _merged(runs), sorted({x for own in items for x in own}), unnamed))
        if rows:
            yield _batch(batch.column(0), rows)


def blocks(items: DataFrame, window: int, id_col: str = "item_id",
           text_col: str = "text") -> tuple[DataFrame, int]:
    """(item_id, piece, block) rows and the number of blocks."""
    pieces = written(
        items.select(F.col(id_col).cast("string").alias("item_id"), _bytes(text_col).alias("text"))
        .mapInArrow(lambda it: _pieces(it, window), "item_id string, piece binary").distinct(), "decontaminate-items")
    n = math.ceil((pieces.agg(F.sum(F.length("piece"))).first()[0] or 0) / BLOCK_BYTES) or 1
    return pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "piece"), F.lit(n))), n


def _bytes(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, spans, items): spans [start, end) of the
    words inside occurrences, and the ids of the items that occur, sorted."""
    spark = docs.sparkSession
    pieces, n_blocks = blocks(items, window)
    d = docs.select(F.col(id_col).alias("doc_id"), _bytes(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    rest = f"n_words long, n_hit long, n_items long, spans {SPANS}, items array<string>"

    def search(df, block, kind):
        rows = [(r.item_id, bytes(r.piece)) for r in
                pieces.where(F.col("block") == block).orderBy("item_id", "piece").collect()]
        shared = spark.sparkContext.broadcast(rows)
        return df.mapInArrow(lambda it: _scan(it, _index(shared.value, window)), f"doc_id {kind}, {rest}")

    if n_blocks == 1:
        return search(d, 0, kind)
    d = written(d.withColumn("uid", F.monotonically_increasing_id()), "decontaminate-docs")
    keyed = d.select(F.col("uid").alias("doc_id"), "text")
    found = None
    for b in range(n_blocks):
        one = written(search(keyed, b, "bigint").where("n_hit > 0 OR 0 = " + str(b)), "decontaminate-found")
        found = one if found is None else found.unionByName(one)
    unnamed = F.max(F.col("n_items") - F.size("items"))
    met = (found.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.collect_list("spans").alias("spans"),
                                       F.collect_list("items").alias("items"), unnamed.alias("unnamed"))
           .mapInArrow(_join_blocks, f"doc_id long, {rest}"))
    return (d.select("uid", F.col("doc_id").alias("id")).join(met, F.col("uid") == F.col("doc_id"))
            .select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "spans", "items"))
