"""Language ID: a linear-chain conditional random field over words.

Each word (a run of letters) is described by hashed features: the word itself
(lexicon), prefixes and suffixes, character n-grams.  A weight per feature and
language and a learned transition matrix give the label probabilities of every
word by forward-backward, so the words of code-switched text are labelled one
by one; a document's language is the one with the highest mean probability.

Texts are cut into chains of ``CHAIN`` words, so that many advance together in
numpy; each chain's transfer matrix carries the messages of a text's other
chains over the cuts, so the labels are those of the whole text, however long.
Emission scores depend on the word alone and are kept per worker, up to a bound.

Trained on the driver on a bounded sample of labelled rows: about
``SAMPLE_DOCS`` documents spread over the languages by a seeded hash of the id,
``SAMPLE_WORDS`` words of each, in seeded runs from all parts of the text.

Defined results: a NULL text or one without a letter (digits, fractions and
Roman numerals are none) is ``und`` with score 0;
ties go to the first language by name; repeated rows are labelled one by one;
without labelled rows every text is ``und``; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import worker_cache

#: Training documents; words of each, at most, in this many runs.
SAMPLE_DOCS, SAMPLE_WORDS, RUNS = 4000, 120, 4
#: Words in a chain; words in a block that is labelled at once; words a worker remembers.
CHAIN, BLOCK, CACHE_WORDS = 512, 200_000, 400_000
BITS = 17
MASK = (1 << BITS) - 1

#: Numerals that are no decimal digits (fractions, Roman numerals, circled digits).
_NUMERALS = frozenset(c for c in map(chr, range(0x110000))
                      if c.isnumeric() and not c.isalpha() and not c.isdecimal())
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    text = (text or "").lower()
    if not text.isascii() and not _NUMERALS.isdisjoint(text):
        text = "".join(" " if c in _NUMERALS else c for c in text)
    return _WORD.findall(text)


def features(word: str) -> list[int]:
    """Buckets of a lower-cased word's UTF-8 bytes: lexicon entry, affixes,
    n-grams.  Each kind has its own seed."""
    w = word.encode()
    own = [crc32(w, 1), *[crc32(w[:k], 2) for k in (1, 2, 3, 4)], *[crc32(w[-k:], 3) for k in (1, 2, 3, 4, 5)]]
    w = b"<" + w + b">"
    own += [crc32(w[i:i + 3], 4) for i in range(len(w) - 2)]
    return [x & MASK for x in own]


@dataclass
class Model:
    langs: list[str]
    w: np.ndarray = field(default=None)     # (buckets, langs)
    t: np.ndarray = field(default=None)     # (langs, langs) transitions

    def emissions(self, words: list[str]) -> np.ndarray:
        """Emission scores, (words, langs)."""
        ids = [features(w) for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sizes.sum())
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.w[flat], starts, axis=0) / np.sqrt(sizes)[:, None]


def forward_backward(e: np.ndarray, mask: np.ndarray, t: np.ndarray, before: np.ndarray | None = None,
                     after: np.ndarray | None = None, count: bool = True):
    """Marginals (chains, steps, langs) and expected transition counts of
    padded chains; ``e`` are emission scores, ``mask`` tells real words.
    ``before`` and ``after`` are messages (chains, langs) from what stands before
    and after each chain: the weight of its first and last labels.

    Scaled in probability space: each step normalises, so long chains neither
    over- nor underflow.
    """
    n, steps, k = e.shape
    x = np.exp(e - e.max(axis=2, keepdims=True))
    a = np.exp(t - t.max())
    alpha, beta = np.empty_like(x), np.empty_like(x)
    cur = x[:, 0] if before is None else x[:, 0] * before
    cur = cur / cur.sum(axis=1, keepdims=True)
    alpha[:, 0] = cur
    for s in range(1, steps):
        new = (cur @ a) * x[:, s]
        new /= new.sum(axis=1, keepdims=True)
        cur = np.where(mask[:, s, None], new, cur)
        alpha[:, s] = cur
    cur = np.full((n, k), 1.0 / k) if after is None else after
    beta[:, -1] = cur
    pairs = np.zeros((k, k))
    for s in range(steps - 1, 0, -1):
        out = x[:, s] * cur
        real = mask[:, s]
        if count and real.any():
            j = alpha[real, s - 1, :, None] * a[None] * out[real, None, :]
            pairs += (j / j.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        new = out @ a.T
        new /= new.sum(axis=1, keepdims=True)
        cur = np.where(real[:, None], new, cur)
        beta[:, s - 1] = cur
    m = alpha * beta
    return m / m.sum(axis=2, keepdims=True), pairs


def padded(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Emission scores of chains as one array, and which of its steps are words."""
    size = np.fromiter(map(len, chains), np.int64, len(chains))
    mask = np.arange(size.max())[None] < size[:, None]
    e = np.zeros((*mask.shape, chains[0].shape[1]))
    e[mask] = np.concatenate(chains)
    return e, mask


def messages(texts: list[list[np.ndarray]], t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, after) of the consecutive chains of texts, given their emission
    scores: each chain's transfer matrix carries what its text's others say."""
    a, k = np.exp(t - t.max()), len(t)
    e, mask = padded([c for own in texts for c in own])
    x = np.exp(e - e.max(axis=2, keepdims=True))
    n = len(x)
    through = np.eye(k)[None] * x[:, 0, None, :]
    for s in range(1, x.shape[1]):
        step = (through.reshape(-1, k) @ a).reshape(n, k, k) * x[:, s, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        through = np.where(mask[:, s, None, None], step, through)
    before, after, at = np.ones((n, k)), np.full((n, k), 1.0 / k), 0
    for own in texts:
        end = at + len(own)
        for i in range(at + 1, end):                       # words of chain i - 1, then a transition
            out = before[i - 1] @ through[i - 1] @ a
            before[i] = out / out.sum()
        for i in range(end - 2, at - 1, -1):
            out = a @ (through[i + 1] @ after[i + 1])
            after[i] = out / out.sum()
        at = end
    return before, after


def fit(docs: list[tuple[list[str], str]], steps: int = 60, rate: float = 0.1,
        decay: float = 1e-5) -> Model:
    """Maximum likelihood by Adam; languages weigh alike."""
    langs = sorted({y for _, y in docs})
    model = Model(langs)
    if not docs:
        return model
    k = len(langs)
    vocabulary: dict[str, int] = {}
    seqs = [[vocabulary.setdefault(w, len(vocabulary)) for w in ws] for ws, _ in docs]
    y = np.array([langs.index(lang) for _, lang in docs])
    size = np.fromiter(map(len, seqs), np.int64, len(seqs))
    feats = [features(w) for w in vocabulary]
    sizes = np.array([len(f) for f in feats])
    flat, scale = np.concatenate(feats), 1 / np.sqrt(sizes)
    of = np.repeat(np.arange(len(feats)), sizes)
    used, local = np.unique(flat, return_inverse=True)
    weigh = (len(docs) / k / np.bincount(y, minlength=k))[y]
    weigh = weigh / (weigh * size).sum()
    p, t = np.zeros((len(used), k)), np.zeros((k, k))
    state = [np.zeros_like(p), np.zeros_like(p), np.zeros_like(t), np.zeros_like(t)]
    target = np.eye(k)[y]
    seen = np.zeros((k, k))
    np.add.at(seen, (y, y), np.maximum(size - 1, 0))
    groups, kind = [], np.ceil(np.log2(np.maximum(size, 1)))   # chains of like length are padded together
    for x in np.unique(kind):
        own = np.flatnonzero(kind == x)
        mask = np.arange(max(1, size[own].max()))[None] < size[own][:, None]
        ids = np.zeros(mask.shape, np.int64)
        ids[mask] = np.concatenate([seqs[i] for i in own.tolist()])
        groups.append((ids, mask, target[own][:, None], weigh[own][:, None] * mask))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for step in range(1, steps + 1):
        emission = np.add.reduceat(p[local], starts, axis=0) * scale[:, None]
        per_word, pairs = np.zeros((len(feats), k)), np.zeros((k, k))
        for ids, mask, goal, share in groups:
            m, moves = forward_backward(emission[ids], mask, t)
            pairs += moves
            d = (m - goal) * share[:, :, None]
            for c in range(k):
                per_word[:, c] += np.bincount(ids.ravel(), d[:, :, c].ravel(), len(feats))
        per_word *= scale[:, None]
        gp = np.stack([np.bincount(local, per_word[of, c], len(used)) for c in range(k)], 1) + decay * p
        gt = (pairs - seen) / size.sum() + 1e-3 * t
        for x, g, m1, m2 in ((p, gp, *state[:2]), (t, gt, *state[2:])):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            x -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    model.w, model.t = np.zeros((1 << BITS, k)), t
    model.w[used] = p
    return model


def runs(words: list[str]) -> list[list[str]]:
    """The words, or seeded runs of them, one from each part of the text."""
    if len(words) <= SAMPLE_WORDS:
        return [words] if words else []
    size, part = SAMPLE_WORDS // RUNS, len(words) / RUNS
    seed = crc32(" ".join(words).encode())
    out = []
    for r in range(RUNS):
        first, room = int(part * r), int(part * (r + 1)) - int(part * r) - size
        at = first + crc32(f"{seed}:{r}".encode()) % (room + 1)
        out.append(words[at:at + size])
    return out


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, found = [], []
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = runs(letters(t))
            lang += [y] * len(own)
            found += own
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(found, pa.list_(pa.string()))],
                                         ["lang", "words"])


def train(docs: DataFrame, where: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fits on rows with a language for which ``where`` (over ``id``) holds."""
    rows = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                        F.col(text_col).alias("t")).where(F.col("lang").isNotNull() & where))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([])
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items()
                           for x in (lang, min(1.0, sample_docs / len(counts) / n))])
    some = rows.where(F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 20))
                      < F.element_at(rates, F.col("lang")) * (1 << 20))
    got = (some.select("lang", "t").mapInArrow(_sample, "lang string, words array<string>")
           .toArrow().to_pylist())
    return fit(sorted((r["words"], r["lang"]) for r in got if r["words"]))


class _Emissions(dict):
    """Row of each word in a table of emission scores; new words get theirs
    together, once a block."""

    def __init__(self, model: Model):
        self.model, self.table, self.new = model, np.empty((0, len(model.langs))), []

    def __missing__(self, word: str) -> int:
        out = self[word] = len(self)
        self.new.append(word)
        return out

    def scores(self) -> np.ndarray:
        if self.new:
            self.table = np.concatenate([self.table, self.model.emissions(self.new)])
            self.new = []
        return self.table

    def forget(self):
        self.__init__(self.model)
        self.clear()


def label(texts: list[str | None], emissions: _Emissions) -> np.ndarray:
    """Mean label probabilities of each text, (texts, langs); 0 without words."""
    k = len(emissions.model.langs)
    out = np.zeros((len(texts), k))
    ids, of, rest = [], [], 0

    def flush():
        """Labels the texts gathered: chains of like length together."""
        table = emissions.scores()
        cut = [[table[w[s:s + CHAIN]] for s in range(0, len(w), CHAIN)] for w in ids]
        parts = np.fromiter(map(len, cut), np.int64, len(cut))
        text, several = np.repeat(of, parts), np.repeat(parts > 1, parts)
        chains = [c for own in cut for c in own]
        before, after = np.ones((len(chains), k)), np.full((len(chains), k), 1.0 / k)
        if several.any():
            before[several], after[several] = messages([own for own in cut if len(own) > 1], emissions.model.t)
        kind = np.ceil(np.log2(np.fromiter(map(len, chains), np.int64, len(chains))))
        for x in np.unique(kind):
            own = np.flatnonzero(kind == x)
            e, mask = padded([chains[i] for i in own.tolist()])
            m, _ = forward_backward(e, mask, emissions.model.t, before[own], after[own], count=False)
            np.add.at(out, text[own], (m * mask[:, :, None]).sum(axis=1))
        ids.clear()
        of.clear()

    for i, text in enumerate(texts):
        if len(emissions) > CACHE_WORDS:
            if ids:
                flush()
            emissions.forget()
            rest = 0
        words = np.fromiter(map(emissions.__getitem__, letters(text)), np.int64)
        if len(words):
            ids.append(words)
            of.append(i)
        rest += len(words)
        if rest >= BLOCK:
            flush()
            rest = 0
    if ids:
        flush()
    n = out.sum(axis=1, keepdims=True)
    return np.divide(out, n, out=np.zeros_like(out), where=n > 0)


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = model.value
    cache = worker_cache()
    if cache.get("langid", (None,))[0] is not m:       # a broadcast is read once a worker
        cache["langid"] = (m, _Emissions(m))
    emissions = cache["langid"][1]
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        if m.langs:
            p = label(texts, emissions)
            best, top = p.argmax(axis=1), p.max(axis=1)
            lang = [m.langs[b] if s > 0 else "und" for b, s in zip(best, top)]
        else:
            lang, top = ["und"] * len(texts), np.zeros(len(texts))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(np.minimum(top, 1.0))],
            [*batch.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).alias("labelled_text")).mapInArrow(
        lambda it: _predict(it, shared), schema + ", lang_pred string, score double")
