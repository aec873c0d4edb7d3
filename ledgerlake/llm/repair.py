"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation is read as a sequence of symbols, one per row: who speaks
(system, user, assistant, other) and what is wrong with the row (nothing, cut
off, must go).  The cheapest edits that give it the form
``(system? (user assistant)+)?`` are a shortest path through four states
(nothing yet, system, user, assistant spoke last).

1. Faults.  Identical rows of one turn are counted as one row; whether role and
   text were said before is one aggregate by (conversation, role, hash of text).
   Rows are sorted by range over (conversation, turn), so a conversation of any
   length is cut into segments by many tasks.
2. Grammar.  Re-Pair over all distinct segments: every round counts the pairs
   of neighbouring symbols and replaces the most frequent ones by new symbols.
   The pairs of a round never overlap, so replacing them together equals
   replacing them one by one.
3. Matrices.  Each symbol has a 4 x 4 matrix over (min, +): cost, rope of edits
   and rank of the rope among those that leave the same state.  A rule's matrix
   is the product of its two symbols', computed once, bottom-up, and shared by
   all conversations.
4. A conversation is one row vector, multiplied by the matrices of its
   compressed segments in order.

Ties.  Edits of the same rows, each row's inserts before it, form a prefix
code: of two different ones neither begins the other.  So which of two equal
costs has the least string is known from the ranks of their left factors (of
the right ones where those are the same), and no strings are compared.

At scale: rules are at most ``MAX_RULES``, so the driver and every task hold a
bounded grammar; a segment has at most ``SEGMENT`` symbols.  A conversation's
vector is carried through its segments by one task, at one byte a row or less;
``repaired`` sorts the rows of a conversation and streams them, as their order
decides and a digest of the whole can only be taken front to back.

Defined results: NULL role and text read as one space, NULL turns come first,
rows with a NULL conv_id are one conversation; a role without characters has
the initial space; rows of one turn stand by role, then by SHA-256 of the
text; repeated rows are duplicates; texts of any length are whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

#: Symbols a segment holds at most.
SEGMENT = 4096
#: Rules of the grammar, rules of a round and rounds, at most.
MAX_RULES, ROUND_RULES, ROUNDS = 4096, 256, 12
#: Conversations whose edits a worker remembers.
MEMO = 50_000

KEEP, DELETE, REROLE, INSERT, CUT_OFF = 0, 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)                  # states
#: Whoever may speak next: state -> (state after a user's or assistant's turn).
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = "sua"                                              # role classes 0..2; 3: any other
FINE, TRUNCATED, GOES = range(3)                           # kinds of a row
N_SYMBOLS = 12                                             # role class * 3 + kind
SPACE = " \t\n\x0b\x0c\r"
_APART = 0xFFFF


# -- matrices ----------------------------------------------------------------

class Matrix:
    """cost[s][t], rope[s][t] and rank[s][t] of the best edits from s to t."""

    __slots__ = ("cost", "rope", "rank")

    def __init__(self):
        self.cost = [[None] * 4 for _ in range(4)]
        self.rope = [[None] * 4 for _ in range(4)]
        self.rank = [[0] * 4 for _ in range(4)]


def symbol_matrix(symbol: int) -> Matrix:
    """Inserts, then one row with this symbol."""
    who, kind = divmod(symbol, 3)
    m = Matrix()
    for s in range(4):
        best: dict = {}
        at, paid, edits = s, 0, ""
        for _ in range(3):                                 # a third insert only returns to a state
            found = [(at, DELETE, "D")]
            if kind != GOES:
                more = CUT_OFF if kind == TRUNCATED else 0
                kept = {0: SYSTEM if at == START else None, 1: USER if at != USER else None,
                        2: ASSISTANT if at == USER else None}.get(who)
                if kept is not None:
                    found.append((kept, KEEP + more, "K"))
                found.append((NEXT[at], REROLE + more, "R"))
            for t, c, e in found:
                best[t] = min(best.get(t, (1 << 60, "")), (paid + c, edits + e))
            at, paid, edits = NEXT[at], paid + INSERT, edits + "I"
        for r, t in enumerate(sorted(best, key=lambda t: best[t][1])):
            m.cost[s][t], m.rope[s][t] = best[t]
            m.rank[s][t] = r
    return m


def _row(cost, rope, rank, b: Matrix):
    """One row (cost, rope, rank) times a matrix."""
    out_cost, out_rope, out_rank, order = [None] * 4, [None] * 4, [0] * 4, []
    for t in range(4):
        best = None
        for m in range(4):
            if cost[m] is not None and b.cost[m][t] is not None:
                c = (cost[m] + b.cost[m][t], rank[m], m)
                if best is None or c < best:
                    best = c
        if best is not None:
            m = best[2]
            out_cost[t] = best[0]
            out_rope[t] = (rope[m], b.rope[m][t]) if rope[m] else b.rope[m][t]
            order.append((rank[m], b.rank[m][t], t))
    for r, (_, _, t) in enumerate(sorted(order)):
        out_rank[t] = r
    return out_cost, out_rope, out_rank


def product(a: Matrix, b: Matrix) -> Matrix:
    out = Matrix()
    for s in range(4):
        out.cost[s], out.rope[s], out.rank[s] = _row(a.cost[s], a.rope[s], a.rank[s], b)
    return out


def unroll(rope) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


#: The row vector before any row: in START, at no cost.
BEGIN = ([0, None, None, None], ["", None, None, None], [0] * 4)


def closed(vector) -> tuple[int, str]:
    """Cheapest edits that end after an assistant or with nothing."""
    cost, rope, rank = vector
    ends = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    c, _, t = min((cost[t] + INSERT * len(e), rank[t], t) for t, e in ends.items() if cost[t] is not None)
    return c, unroll(rope[t]) + ends[t]


# -- grammar -----------------------------------------------------------------

class Grammar:
    """Rounds of rules (pair -> symbol), and a matrix per symbol."""

    def __init__(self):
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []     # (sorted pairs, their symbols)
        self.matrices = [symbol_matrix(s) for s in range(N_SYMBOLS)]

    def add(self, pairs: list[tuple[int, int]]) -> None:
        keys = np.array([(a << 16) | b for a, b in pairs], np.uint32)
        order = np.argsort(keys)
        symbols = np.arange(len(pairs), dtype=np.uint16) + np.uint16(len(self.matrices))
        self.matrices += [product(self.matrices[a], self.matrices[b]) for a, b in pairs]
        self.rounds.append((keys[order], symbols[order]))

    def compress(self, segments: list[bytes]) -> np.ndarray:
        """The segments' symbols, each segment ended by ``_APART``."""
        x = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8).astype(np.uint16)
        x[x == 0xFF] = _APART
        for keys, symbols in self.rounds:
            pair = pairs_of(x)
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            hit = keys[at] == pair
            # hits overlap in runs of one symbol only: take every other one from the left
            i = np.arange(len(hit))
            start = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), i, 0))
            hit &= (i - start) % 2 == 0
            x[:-1][hit] = symbols[at[hit]]
            keep = np.ones(len(x), bool)
            keep[1:][hit] = False
            x = x[keep]
        return x


def pairs_of(x: np.ndarray) -> np.ndarray:
    return (x[:-1].astype(np.uint32) << np.uint32(16)) | x[1:]


def _count_pairs(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    """(pair, n): pairs of neighbours, those of runs counted as they are replaced."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = grammar.compress(batch.column(0).to_pylist())
        pair = pairs_of(x)
        same = np.concatenate(([False], pair[1:] == pair[:-1]))            # inside a run
        inside = (x[:-1] != _APART) & (x[1:] != _APART)
        i = np.arange(len(pair))
        start = np.maximum.accumulate(np.where(same, 0, i))
        pair, n = np.unique(pair[inside & ((i - start) % 2 == 0)], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))],
                                         ["pair", "n"])


def learn(segments: DataFrame) -> Grammar:
    """Re-Pair over distinct segments (column ``symbols``)."""
    spark, grammar = segments.sparkSession, Grammar()
    distinct = written(segments.select("symbols").distinct(), "repair-segments")
    while len(grammar.rounds) < ROUNDS and len(grammar.matrices) < N_SYMBOLS + MAX_RULES:
        shared = spark.sparkContext.broadcast(grammar)
        # at most MAX_RULES candidates reach the driver
        counts = (distinct.mapInArrow(lambda it, g=shared: _count_pairs(it, g.value), "pair long, n long")
                  .groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
                  .orderBy(F.desc("n"), "pair").limit(MAX_RULES).collect())
        left, right, pairs = set(), set(), []
        room = min(ROUND_RULES, N_SYMBOLS + MAX_RULES - len(grammar.matrices))
        for r in counts[:]:
            a, b = r.pair >> 16, r.pair & 0xFFFF
            clash = a in right or b in left or (a == b and (a in left or b in right))
            if len(pairs) < room and not clash:
                left.add(a)
                right.add(b)
                pairs.append((a, b))
        if not pairs:
            break
        grammar.add(pairs)
    return grammar


# -- rows --------------------------------------------------------------------

def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def rows_of(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, sha), NULL role and text as one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return convs.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
                        text.alias("text"), _sha(text).alias("sha"))


def faults(convs: DataFrame) -> DataFrame:
    """One row per (conv_id, turn, role, sha): n copies, blank, cut_off, and
    whether the first of them is the first row with this role and text."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    r = (rows_of(convs)
         .select("conv_id", "turn", "role", "sha", (end == "").alias("blank"),
                 (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut_off"))
         .groupBy("conv_id", "turn", "role", "sha")
         .agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut_off").alias("cut_off")))
    r = written(r, "repair-rows")
    said = r.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s")).agg(
        F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("unplaced"))
    first = F.when(F.col("unplaced"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    return (r.join(said, F.expr("conv_id <=> c AND role = r AND sha = s"))
            .select("conv_id", "turn", "role", "sha", "n", "blank", "cut_off", first.alias("first")))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, part, seg, symbols) of sorted (conv_id, who, blank, cut_off, first, n)."""
    part = TaskContext.get().partitionId()
    conv, seg, held = None, 0, bytearray()
    names = ["conv_id", "part", "seg", "symbols"]

    def table(out, kind):
        c = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0], kind), pa.array([part] * len(out), pa.int32()), pa.array(c[1], pa.int64()),
             pa.array(c[2], pa.binary())], names)

    kind = None
    for batch in batches:
        kind, out = batch.column(0).type, []
        for c, who, blank, cut_off, first, n in zip(*(col.to_pylist() for col in batch.columns)):
            if c != conv:
                if held:
                    out.append((conv, seg, bytes(held)))
                conv, seg, held = c, 0, bytearray()
            symbol = who * 3 + (GOES if blank or not first else TRUNCATED if cut_off else FINE)
            held.append(symbol)
            n -= 1
            while n or len(held) >= SEGMENT:               # further copies are duplicates
                k = min(n, SEGMENT - len(held))
                held += bytes([who * 3 + GOES]) * k
                n -= k
                if len(held) >= SEGMENT:
                    out.append((conv, seg, bytes(held)))
                    seg, held = seg + 1, bytearray()
                    if len(out) >= 1024:
                        yield table(out, kind)
                        out = []
        if out:
            yield table(out, kind)
    if held:
        yield table([(conv, seg, bytes(held))], kind)


def segments(found: DataFrame) -> DataFrame:
    """(conv_id, part, seg, symbols): rows in order, as symbols, cut into segments."""
    kind = found.schema["conv_id"].dataType.simpleString()
    initial = F.substring("role", 1, 1)
    who = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    order = ["conv_id", "turn", "role", "sha"]
    s = (found.repartitionByRange(*order).sortWithinPartitions(*order)
         .select("conv_id", who.alias("who"), "blank", "cut_off", "first", "n")
         .mapInArrow(_segments, f"conv_id {kind}, part int, seg long, symbols binary"))
    return written(s, "repair-symbols")


_LEGAL = {(0, 1), (1, 2), (2, 1)}                          # su, ua, au
_ILLEGAL = np.array([[(a // 3, b // 3) not in _LEGAL for b in range(N_SYMBOLS)] for a in range(N_SYMBOLS)])


def _solve(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    """(conv_id, illegal, cost, audit) of segments sorted by conversation."""
    conv, last, illegal, vector, kind = None, None, 0, None, None
    done: dict = {}

    def result(out):
        c = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0], kind), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
             pa.array(c[3], pa.string())], ["conv_id", "illegal", "cost", "audit"])

    def finished():
        key = vector if isinstance(vector, bytes) else None
        if key is None:
            return conv, illegal, *closed(vector)
        if key not in done:                                # one segment: conversations share it
            if len(done) >= MEMO:
                done.clear()
            v = BEGIN
            for m in np.frombuffer(key, np.uint16).tolist():
                v = _row(*v, grammar.matrices[m])
            done[key] = closed(v)
        return conv, illegal, *done[key]

    for batch in batches:
        if not batch.num_rows:
            continue
        kind, out = batch.column(0).type, []
        raw = batch.column(1).to_pylist()
        x = grammar.compress(raw)
        ends = np.flatnonzero(x == _APART)
        begin = 0
        for c, symbols, end in zip(batch.column(0).to_pylist(), raw, ends.tolist()):
            own, begin = x[begin:end], end + 1
            plain = np.frombuffer(symbols, np.uint8)
            bad = int(_ILLEGAL[plain[:-1], plain[1:]].sum())
            if last is None or c != conv:
                if last is not None:
                    out.append(finished())
                conv, illegal, vector = c, bad, own.tobytes()
            else:
                if isinstance(vector, bytes):              # a second segment: no sharing
                    v = BEGIN
                    for m in np.frombuffer(vector, np.uint16).tolist():
                        v = _row(*v, grammar.matrices[m])
                    vector = v
                for m in own.tolist():
                    vector = _row(*vector, grammar.matrices[m])
                illegal += bad + bool(_ILLEGAL[last, plain[0]])
            last = plain[-1]
        if out:
            yield result(out)
    if last is not None:
        yield result([finished()])


def audits(found: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) per conversation of ``faults``."""
    segs = segments(found)
    shared = found.sparkSession.sparkContext.broadcast(learn(segs))
    kind = found.schema["conv_id"].dataType.simpleString()
    return (segs.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
            .select("conv_id", "symbols")
            .mapInArrow(lambda it: _solve(it, shared.value),
                        f"conv_id {kind}, illegal long, cost long, audit string"))


def repair(convs: DataFrame) -> DataFrame:
    """Per conversation with rows: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost (longs) and audit, the cheapest edits' initials in order."""
    found = written(faults(convs), "repair-faults")
    no = F.lit(0)
    counts = found.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), no).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(no)).alias("blank"),
        F.sum(F.when(F.col("blank"), no).otherwise(F.col("n") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum((~F.col("blank") & F.col("first") & F.col("cut_off")).cast("long")).alias("truncated"))
    plan = written(audits(found).select(F.col("conv_id").alias("of"), "illegal", "cost", "audit"),
                   "repair-audits")
    return (counts.join(plan, F.expr("conv_id <=> of"))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, position, edit, role, text): each conversation's audit row, then its rows."""
    edits, state, position, conv, kind = "", START, 0, None, None
    at = 0

    def moved(role):
        return SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ASSISTANT

    for batch in batches:
        kind, out, held = batch.column(0).type, [], 0

        def inserted():
            nonlocal at, state, position
            while at < len(edits) and edits[at] == "I":
                state = NEXT[state]
                out.append((conv, position, "I", "user" if state == USER else "assistant", ""))
                at, position = at + 1, position + 1

        def result():
            c = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], kind), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()),
                 pa.array(c[3], pa.string()), pa.array(c[4], pa.string())],
                ["conv_id", "position", "edit", "role", "text"])

        for c, is_row, role, text in zip(*(col.to_pylist() for col in batch.columns)):
            if not is_row:                                 # the next conversation's edits
                conv, edits, at, state, position = c, text, 0, START, 0
                inserted()
                continue
            edit, at = edits[at], at + 1
            if edit != "D":
                if edit == "R":
                    role = "user" if NEXT[state] == USER else "assistant"
                state = moved(role)
                out.append((conv, position, edit, role, text))
                position += 1
                held += len(text)
            inserted()
            if held > 1 << 24:
                yield result()
                out, held = [], 0
        if out:
            yield result()


def repaired(convs: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns after the edits of
    ``plan`` (conv_id, audit), each conversation's in order within one task."""
    r = rows_of(convs).select("conv_id", F.lit(1).alias("is_row"), "turn", "role", "sha", "text")
    a = plan.select("conv_id", F.lit(0).alias("is_row"), F.lit(None).cast(r.schema["turn"].dataType).alias("turn"),
                    F.lit("").alias("role"), F.lit(b"").alias("sha"), F.col("audit").alias("text"))
    kind = r.schema["conv_id"].dataType.simpleString()
    return (a.union(r).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "sha")
            .select("conv_id", "is_row", "role", "text")
            .mapInArrow(_edit, f"conv_id {kind}, position long, edit string, role string, text string"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, sha256) of ``role:text`` lines, over turns in order."""
    import hashlib

    conv, h, kind = None, None, None

    def result(out):
        c = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(c[0], kind), pa.array(c[1], pa.string())],
                                          ["conv_id", "sha256"])

    for batch in batches:
        kind, out = batch.column(0).type, []
        for c, position, role, text in zip(*(col.to_pylist() for col in batch.columns)):
            if position == 0:
                if h is not None:
                    out.append((conv, h.hexdigest()))
                conv, h = c, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
        if out:
            yield result(out)
    if h is not None:
        yield result([(conv, h.hexdigest())])


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's repaired turns; ``turns`` is
    what ``repaired`` returns, unshuffled."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (turns.select("conv_id", "position", "role", "text")
            .mapInArrow(_digest, f"conv_id {kind}, sha256 string"))
