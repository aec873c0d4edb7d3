"""Best-fit packing: bulk-synchronous best-fit of documents into sequences.

1. Tokenise; documents over the capacity are cut into full pieces, the first
   piece takes what is left over.
2. Rank the pieces within their length in the order of a hash: lengths with many
   pieces are cut into ranges of it, whose counts go to the driver; the ranks of
   a range start where the counts before it add up.
3. Pack in bulk-synchronous steps.  Pieces of one length are alike and so are
   open sequences with one content, so a step handles classes with a count:
   lengths fall in octaves (over half the capacity, over a quarter, ...); in
   each step of an octave every open sequence takes at most one piece.  One
   sweep matches each length class to its successor among the gap classes
   (the smallest gap that holds it); when classes ask for the same gaps, rank
   resolves it: longer pieces first, lower ranks first.  Gaps are updated and
   the step is repeated until no gap takes a piece of the octave; pieces then
   left open new sequences.
4. A sequence class gives each of its places a run of ranks of one length;
   pieces look up their run by (length, rank) and get sequence and offset.

The driver holds classes only (lengths are at most the capacity; a class holds
any number of pieces), never pieces.

Defined results: NULL text is the empty text, whose ids are the end mark;
repeated rows and ids are packed as separate documents; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import os
import re
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import bounded_batches, worker_cache

#: Chunks of text whose ids a worker keeps.
CACHE_CHUNKS = 500_000


# -- tokens -------------------------------------------------------------------

def added_tokens(path: str) -> dict[str, int]:
    """Added tokens (text: id) of the tokenizer file beside the ranks in ``path``.

    They are matched in text before anything else; only plain ones are known
    here, whose match takes no white space and asks for no word boundary.
    """
    own = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(own):
        return {}
    with open(own, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{own}: added tokens with options")
    return {t["content"]: t["id"] for t in added}


def load_tokenizer(path: str):
    """Ids of a string by the vocabulary in ``path`` (ranks of a byte-level BPE)
    and the added tokens that belong to it."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens=added_tokens(path))
    return partial(own.encode, allowed_special="all")


class _Chunks(dict):
    """Ids (little-endian uint32 bytes) of `` `` + chunk, for the chunks of a
    text between single spaces.

    A space between two other characters that are not white space starts a new
    pre-token, so such chunks are tokenised alone, and once.
    """

    def __init__(self, encode):
        self.encode = encode

    def whole(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        out = self[chunk] = self.whole(" " + chunk)
        return out


#: A space beside other white space or at the end: there the text is tokenised whole.
_MIXED = re.compile(r" (?:(?=\s|\Z)|(?<=\s ))")


def encode(text: str, chunks: _Chunks) -> bytes:
    if text[:1].isspace() or _MIXED.search(text):
        return chunks.whole(text)
    first, *rest = text.split(" ")
    return chunks.whole(first) + b"".join(map(chunks.__getitem__, rest))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int):
    """(doc_id, piece, start, length, ids_crc32) of each text's pieces."""
    cache = worker_cache()
    if ("chunks", path) not in cache:
        cache["chunks", path] = _Chunks(load_tokenizer(path))
    chunks = cache["chunks", path]
    end = array("I", [end_id]).tobytes()
    for batch in batches:
        of, rows = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            ids = encode(text, chunks) + end if text else end
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                of.append(i)
                rows.append((p, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(of, pa.int64())), pa.array(cols[0], pa.int32()),
             *[pa.array(c, pa.int64()) for c in cols[1:]]],
            ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .mapInArrow(lambda it: _pieces(it, tokenizer, capacity, end_id),
                        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"))


# -- classes --------------------------------------------------------------------

def sweep(lengths: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int]]:
    """[(length, gap, count)]: longest first, each length takes the smallest
    gaps that hold it; a gap is taken once."""
    free = sorted(g for g, n in gaps.items() if n)
    left, out = dict(gaps), []
    for size in sorted(lengths, reverse=True):
        n, at = lengths[size], bisect_left(free, size)
        while n and at < len(free):
            g = free[at]
            take = min(n, left[g])
            out.append((size, g, take))
            n, left[g] = n - take, left[g] - take
            if not left[g]:
                free.pop(at)
    return out


def pack_classes(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(contents, sequences)]: how many sequences hold which lengths."""
    left = {s: n for s, n in counts.items() if n}
    open_: dict[int, list] = {}            # gap -> [(contents, count)], all that is open
    done = []
    octave = capacity
    while left:
        while not any(s > octave // 2 for s in left) and octave > 1:
            octave //= 2
        own = {s: n for s, n in left.items() if s > octave // 2 or octave <= 1}
        taken = sweep(own, {g: sum(n for _, n in v) for g, v in open_.items() if g})
        if not taken:                       # no gap holds any: the longest open sequences
            # as many as the octave's tokens need at least, so that the rest still fits in gaps
            total = sum(s * n for s, n in own.items())
            need = max(1, -(-total // capacity)) if octave < capacity else sum(own.values())
            for s in sorted(own, reverse=True):
                n = min(own[s], need)
                if n:
                    open_.setdefault(capacity - s, []).append(((s,), n))
                    left[s] -= n
                    need -= n
        moved = []
        for s, g, n in taken:
            left[s] -= n
            while n:
                contents, m = open_[g].pop()
                use = min(n, m)
                if m > use:
                    open_[g].append((contents, m - use))
                moved.append((g - s, (*contents, s), use))
                n -= use
        for g, contents, n in moved:
            open_.setdefault(g, []).append((contents, n))
        done += [c for c in open_.pop(0, [])]
        left = {s: n for s, n in left.items() if n}
    merged: dict[tuple, int] = {}
    for contents, n in [*done, *(c for v in open_.values() for c in v)]:
        merged[contents] = merged.get(contents, 0) + n
    return sorted(merged.items())


def places(packed: list) -> list[tuple[int, int, int, int, int]]:
    """[(length, first_rank, ranks, first_sequence, offset)]: ranks in runs."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for contents, n in packed:
        offset = 0
        for size in contents:
            out.append((size, used.get(size, 0), n, sequence, offset))
            used[size] = used.get(size, 0) + n
            offset += size
        sequence += n
    return out


# -- ranks ----------------------------------------------------------------------

_ORDER = ("tie", "doc_id", "piece", "ids_crc32")
#: Pieces of a final task, at least.
TASK_PIECES = 100_000


def _split(counts: dict[int, int], most: int) -> dict[int, int]:
    """Length -> bits of the tie that cut its pieces into parts of about ``most``
    rows, for the lengths that need any."""
    return {s: min(62, (-(-n // most) - 1).bit_length()) for s, n in counts.items() if n > most}


def ranked(items: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``items`` with ``rank`` within equal ``length``, and the pieces per length.

    A length's pieces are cut by the leading bits of their tie, a hash, so the
    parts are in the order of the ranks, about equally large, and the same
    whenever they are computed: ranks start where the parts before add up.
    """
    spark = items.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # counted, counted by part and ranked: tokenised once, kept on the executors' disks
    # (by a plan of its own: a later run reads its files as they are then)
    items = (items.withColumns({"tie": F.xxhash64("doc_id", "piece", "ids_crc32"), "run": F.lit(uuid.uuid4().hex)})
             .persist(StorageLevel.DISK_ONLY).drop("run"))
    total = {r.length: r["count"] for r in items.groupBy("length").count().collect()}
    bits = _split(total, max(1, sum(total.values()) // parts))
    cut = F.lit(0).cast("long")
    if bits:
        shift = F.create_map(*[F.lit(v) for s, b in bits.items() for v in (s, 64 - b)])[F.col("length").cast("int")]
        cut = F.coalesce(F.call_function("shiftright", F.col("tie"), shift), cut)
    items = items.withColumn("part", cut)
    below, at = [], {}
    if bits:                              # parts + lengths rows, or twice that, at most
        own = items.where(F.col("length").isin(list(bits))).groupBy("length", "part").count().collect()
        for r in sorted(own, key=lambda r: (r.length, r.part)):
            below.append((r.length, r.part, at.get(r.length, 0)))
            at[r.length] = at.get(r.length, 0) + r["count"]
    below = spark.createDataFrame(below, "length long, part long, below long")
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy(*_ORDER))
    out = (items.withColumn("local", local).join(F.broadcast(below), ["length", "part"], "left")
           .withColumn("rank", F.coalesce("below", F.lit(0)) + F.col("local") - 1)
           .drop("part", "tie", "local", "below"))
    tasks = max(spark.sparkContext.defaultParallelism, sum(total.values()) // TASK_PIECES)
    return (out.coalesce(tasks) if tasks < parts else out), total


def _place(batches: Iterator[pa.RecordBatch], at: dict) -> Iterator[pa.RecordBatch]:
    """Adds (sequence_id, offset) to rows that end in (length, rank)."""
    for batch in batches:
        *own, length, rank = batch.columns
        sizes, rank = length.to_numpy(), rank.to_numpy()
        seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for size in np.unique(sizes):
            of = sizes == size
            first, sequence, offset = at[int(size)]
            k = np.searchsorted(first, rank[of], side="right") - 1
            seq[of] = sequence[k] + rank[of] - first[k]
            off[of] = offset[k]
        yield pa.RecordBatch.from_arrays(
            [*own, length, pa.array(seq), pa.array(off)],
            [*batch.schema.names[:-1], "sequence_id", "offset"])


def pack(items: DataFrame, capacity: int = 1024) -> DataFrame:
    """``items`` (doc_id, piece, ids_crc32, length and any others) with
    ``sequence_id`` and ``offset``."""
    srt, counts = ranked(items)
    at: dict[int, list] = {}
    for size, first, _, sequence, offset in places(pack_classes(counts, capacity)):
        at.setdefault(size, []).append((first, sequence, offset))
    at = {s: tuple(np.array(c, np.int64) for c in zip(*sorted(v))) for s, v in at.items()}
    names = [c for c in srt.columns if c not in ("length", "rank")]
    schema = ", ".join(f"{c} {srt.schema[c].dataType.simpleString()}" for c in [*names, "length"])
    return srt.select(*names, "length", "rank").mapInArrow(
        lambda it: _place(it, at), schema + ", sequence_id long, offset long")
