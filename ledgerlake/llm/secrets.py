"""Secret scans: character Markov models of random strings and identifiers.

Native: DataFrame and SQL functions only.  Three fixed patterns give the base
spans.  The method adds ``random`` spans: every other long token is scored by
the log-likelihood ratio of two character bigram models, one of random strings
and one of ordinary identifiers, and is a secret when the ratio is high.  Base
spans cut tokens: what is left of a token beside them is a token of its own.

The models are trained on labelled samples of the corpus: values inside base
spans are the random class (with seeded base64 strings, so that every
character is covered), words outside them the ordinary class.  Their bigram
counts are one table of at most 67 x 67 rows a class, which becomes one array
literal of the projection.

Positions come from splitting: the pieces between matches and the matches
alternate, so a match starts where the lengths before it add up.  The sums are
taken in two levels, and the text beside the spans is read from blocks of it, so
many matches in one long text don't cost the square.

Defined results: NULL text is the empty text (no spans, hash of the empty
string); repeated rows are scanned one by one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches

#: The base patterns, in the order in which kinds are listed.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

#: Characters of the models; tokens are runs of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]"

#: Tokens shorter than this are never scored.
TOKEN_CHARS = 16
#: A token is random when its ratio per bigram (nats) is at least this.
RATIO = 1.5
#: Counts' worth of the single-character distribution in each context.
SMOOTHING = 4.0
#: Documents in the training sample, at most about this many.
SAMPLE_DOCS = 4000
#: Seeded random strings in the training sample.
SAMPLE_STRINGS = 2000
#: Labelled ordinary identifiers, for forms that prose lacks; each counts this often.
ORDINARY_TIMES = 25
ORDINARY = [
    "get_user_account_by_id", "MAX_RETRY_COUNT", "camelCaseIdentifierName", "some-kebab-case-name",
    "src/main/java/com/example", "usr/local/share/doc", "home/user/projects/data", "path/to/file",
    "DEFAULT_BUFFER_SIZE", "handleRequestTimeout", "HttpServletResponse", "isValidEmailAddress",
    "test_parse_empty_input", "content-type", "application/json", "text/html", "and/or",
    "2024-01-15", "1999-12-31", "10000000000", "1234567890", "0000000000", "20240115120000",
    "--------------------", "====================", "____________________", "++++++++++++++++++++",
    "////////////////////", "AbstractFactoryBuilder", "read_csv_file", "num_partitions", "x1_y2_z3",
    "version_1_2_3", "image_001", "chapter-12", "TOTAL_AMOUNT_USD", "createdAt", "updatedBy",
]


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _before(values: str, step: str = "a + x") -> str:
    """SQL: the fold (``step`` of a and x, from 0) of the ``values`` (array)
    before each element.

    The folds before each block of 256 come first, so an element adds one of
    them and part of its own block.
    """
    return _let(values, "l", _let(
        f"""aggregate(transform(sequence(0, (size(l) - 1) div 256),
                b -> aggregate(slice(l, b * 256 + 1, 256), 0L, (a, x) -> {step})),
            array(0L), (s, x) -> concat(s, array({_let("element_at(s, -1)", "a", step)})))""", "s",
        f"transform(l, (y, i) -> aggregate(slice(l, (i div 256) * 256 + 1, i % 256), s[i div 256], (a, x) -> {step}))"))


def _find(df: DataFrame, pattern: str, kind: int, keep: str, out: str, t: str = "t") -> DataFrame:
    """Adds ``out``: array of (start, kind, end, value) of the matches in column
    ``t`` that pass ``keep`` (SQL over the match ``m``)."""
    lit = "r'" + pattern.replace("'", r"\x27") + "'"
    hit = f"rlike({t}, {lit})"
    df = (df.withColumn(f"{out}_m", F.expr(f"IF({hit}, regexp_extract_all({t}, {lit}, 0), cast(array() AS array<string>))"))
          .withColumn(f"{out}_p", F.expr(f"IF(size({out}_m) > 0, split({t}, {lit}, -1), cast(array() AS array<string>))")))
    lengths = f"transform({out}_m, (m, i) -> cast(length({out}_p[i]) + length(m) AS bigint))"
    df = df.withColumn(f"{out}_s", F.expr(f"""IF(size({out}_m) = 0, cast(array() AS array<bigint>),
        zip_with({_before(lengths)}, slice({out}_p, 1, size({out}_m)), (s, p) -> s + length(p)))"""))
    return df.withColumn(out, F.expr(f"""filter(zip_with({out}_m, {out}_s, (m, s) -> struct(
        s AS start, {kind} AS kind, s + length(m) AS end, m AS value)),
        x -> {keep.replace('{m}', 'x.value')})""")).drop(f"{out}_m", f"{out}_p", f"{out}_s")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, row, assign, access, hex): arrays of spans of each kind;
    ``row`` is the input row as a struct."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                     F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    value = "length(regexp_extract({m}, r'" + ASSIGN.replace("'", r"\x27") + "', 2))"
    df = _find(df, ASSIGN, 0, f"{value} >= {ASSIGN_CHARS}", "assign")
    # runs are maximal, so asking for the length in the pattern drops the same matches
    df = _find(df, f"AKIA[A-Z0-9]{{{ACCESS_CHARS - 4},}}", 1, "true", "access")
    return _find(df, f"[0-9a-f]{{{HEX_CHARS},}}", 2, "true", "hex")


def _bigrams(samples: DataFrame) -> list:
    """[(class, bigram, count)] of (class, token) rows: a bounded table."""
    grams = F.expr("""transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))""")
    return (samples.where(F.length("token") >= 2).select("random", F.explode(grams).alias("g"))
            .groupBy("random", "g").count().collect())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratio of every bigram, row-major over ALPHABET.

    The sample: documents whose seeded hash falls under a rate that gives about
    ``sample_docs`` of them, whatever the size of the table.
    """
    spark = docs.sparkSession
    n = docs.count()
    rate = min(1.0, sample_docs / max(1, n))
    part = docs.where(F.pmod(F.xxhash64(F.lit("secrets"), F.col(id_col)), F.lit(1 << 20))
                      < rate * (1 << 20))
    found = base_spans(part, id_col, text_col)
    secrets = F.expr(f"""concat(
        transform(assign, x -> regexp_extract(x.value, r'{ASSIGN.replace("'", chr(92) + "x27")}', 2)),
        access.value, hex.value)""")
    plain = F.expr("""filter(regexp_extract_all(t, '[A-Za-z0-9+/_=-]{6,}', 0),
        w -> NOT exists(concat(assign, access, hex), x -> contains(x.value, w)))""")
    seeded = spark.range(SAMPLE_STRINGS).select(
        F.lit(True).alias("random"), F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))).alias("token"))
    samples = (found.select(F.lit(True).alias("random"), F.explode(secrets).alias("token"))
               .union(found.select(F.lit(False), F.explode(plain))).union(seeded)
               .union(spark.range(ORDINARY_TIMES).select(F.lit(False), F.explode(F.lit(ORDINARY)))))
    return ratios([(r.random, r.g, r["count"]) for r in _bigrams(samples)])


def ratios(bigrams: list) -> list[float]:
    """log P_random(b | a) - log P_ordinary(b | a) from (class, bigram, count).

    Counts are smoothed towards the class's distribution of single characters
    (``SMOOTHING`` counts), and that towards the uniform one.
    """
    k = len(ALPHABET)
    at = {c: i for i, c in enumerate(ALPHABET)}
    logs = {}
    for random in (True, False):
        n = [[0.0] * k for _ in range(k)]
        for of, g, count in bigrams:
            if of == random and g[0] in at and g[1] in at:
                n[at[g[0]]][at[g[1]]] += count
        single = [0.5 + sum(row[b] for row in n) for b in range(k)]
        total = sum(single)
        logs[random] = [math.log((row[b] + SMOOTHING * single[b] / total) / (sum(row) + SMOOTHING))
                        for row in n for b in range(k)]
    return [x - y for x, y in zip(logs[True], logs[False])]


#: Code points of a block of text.
BLOCK = 4096


def _pieces(df: DataFrame, spans: str) -> DataFrame:
    """Adds ``cuts``, the merged ``spans`` as (start, end), and ``pieces``, the
    text before, between and after them.

    A span begins a cut where it starts at or after the ends of all before it.
    The text is cut into blocks once and a piece put together from them, so the
    work follows the text and the number of spans.
    """
    df = df.withColumn("x", F.expr(f"array_sort(concat({spans}))"))
    df = df.withColumn("reach", F.expr(f"""IF(size(x) = 0, cast(array() AS array<bigint>),
        {_before("transform(x, v -> v.end)", "greatest(a, x)")})"""))
    df = df.withColumn("heads", F.expr(
        "filter(transform(x, (v, i) -> IF(v.start >= reach[i], i, NULL)), i -> i IS NOT NULL)"))
    df = df.withColumn("cuts", F.expr("""transform(heads, (i, j) -> struct(x[i].start AS start,
        IF(j + 1 < size(heads), reach[heads[j + 1]], greatest(reach[size(x) - 1], x[size(x) - 1].end)) AS end))"""))
    df = df.withColumn("blocks", F.expr(f"regexp_extract_all(t, '(?s).{{1,{BLOCK}}}', 0)"))
    part = f"""IF(a >= b, '', IF(a div {BLOCK} = b div {BLOCK},
        substring(blocks[int(a div {BLOCK})], int(a % {BLOCK}) + 1, int(b - a)),
        concat(substring(blocks[int(a div {BLOCK})], int(a % {BLOCK}) + 1),
               array_join(slice(blocks, int(a div {BLOCK}) + 2, int(b div {BLOCK} - a div {BLOCK}) - 1), ''),
               IF(b % {BLOCK} = 0, '', substring(blocks[int(b div {BLOCK})], 1, int(b % {BLOCK}))))))"""
    begin = "IF(j = 0, 0L, cuts[j - 1].end)"
    end = "IF(j = size(cuts), cast(length(t) AS bigint), cuts[j].start)"
    return df.withColumn("pieces", F.expr(
        f"transform(sequence(0, size(cuts)), j -> {_let(begin, 'a', _let(end, 'b', part))})")) \
        .drop("x", "reach", "heads", "blocks")


def _outside(df: DataFrame) -> DataFrame:
    """Adds ``outside``: the text with spaces in place of the base spans, so that
    tokens are cut there and what is left keeps its positions."""
    blank = F.expr("""array_join(transform(pieces, (p, j) -> IF(j = size(cuts), p,
        concat(p, repeat(' ', int(cuts[j].end - cuts[j].start))))), '')""")
    df = _pieces(df, "assign, access, hex")
    return df.withColumn("outside", F.when(F.size("cuts") > 0, blank).otherwise(F.col("t"))).drop("cuts", "pieces")


def scan(docs: DataFrame, model: list[float] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, t, row, assign, access, hex, random): spans of each kind."""
    bounded_batches(docs.sparkSession)
    model = train(docs, id_col, text_col) if model is None else model
    df = _outside(base_spans(docs, id_col, text_col))
    df = _find(df, f"{TOKEN}{{{TOKEN_CHARS},}}", 3, "true", "tokens", "outside").drop("outside")
    ratios = F.lit(model)
    k = len(ALPHABET)

    def score(x: Column) -> Column:
        token = x["value"]
        codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        pairs = F.zip_with(F.slice(codes, 1, F.length(token) - 1), F.slice(codes, 2, F.length(token)),
                           lambda a, b: F.get(ratios, a * k + b))
        return F.aggregate(pairs, F.lit(0.0), lambda a, b: a + b) / (F.length(token) - 1)

    return (df.withColumn("random", F.when(F.size("tokens") == 0, F.col("tokens"))
                          .otherwise(F.filter("tokens", lambda x: score(x) >= RATIO)))
            .drop("tokens"))


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans of some kinds, by start, then kind."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"""array_join(transform(array_sort(concat({', '.join(kinds)})),
        x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')""")


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``scanned`` with ``n_spans`` and ``redacted``: the text with every span
    replaced by ``mark`` (overlapping spans merge), NULL where nothing was found."""
    df = scanned.withColumn("n_spans", F.expr("size(assign) + size(access) + size(hex) + size(random)"))
    df = _pieces(df, "assign, access, hex, random")
    return df.withColumn("redacted", F.when(F.col("n_spans") > 0, F.array_join("pieces", mark))).drop("cuts", "pieces")
