"""Quality rules: a threshold table compiled into one Spark projection.

Each :class:`Rule` names a ratio (a column expression over the base counts)
and the interval it must lie in.  :func:`measure` computes the counts,
:func:`verdicts` compiles the table into boolean columns.  Built-in functions
only; no shuffle, no user function; a row needs memory in proportion to its
own text.

Defined results: NULL text counts as empty (all counts 0, ``base_failed``);
an empty table gives an empty result; repeated rows and ids are judged one by
one; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import words

#: Frequent function words of the corpus languages (en, de, fr, es).
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "with", "for", "it", "this", "was", "by",
    "der", "die", "das", "und", "von", "zu", "den", "mit", "ist", "ein", "eine", "nicht",
    "le", "la", "les", "des", "et", "que", "qui", "dans", "est", "un", "une", "pour", "par",
    "el", "los", "las", "del", "de", "y", "en", "se", "con", "por", "para", "es",
]


@dataclass(frozen=True)
class Rule:
    name: str
    over: str          # SQL expression over the measured columns
    low: float | None
    high: float | None


#: The threshold table; a document is kept if no rule fails.
RULES = (
    Rule("length", "n_words", 50, 100_000),
    Rule("word_length", "word_chars / n_words", 2, 12),
    Rule("symbols", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words / n_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.3),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.3),
    Rule("letters", "n_letters / word_chars", 0.7, None),
)


def _repeat_words(w: str, g: str) -> str:
    """SQL: words of ``w`` inside 3-word windows (hashes ``g``) found twice or more.

    Most texts have no such window, which counting distinct hashes tells.
    Otherwise each hash gets its position in place of its low bits, and the
    sorted numbers put equal windows side by side; whole hashes are compared, so
    no window counts that is not found again.  One would be missed only if another
    window with the same upper bits (48, fewer beyond 65,535 words) stood between
    two equal ones.  The positions found are counted as a union of intervals: in
    order, each window adds the words that its predecessor does not cover.
    """
    mask = f"(shiftleft(1L, greatest(16, int(ceil(log2(size({w}) + 1))))) - 1)"
    at = f"int(s[{{j}}] & {mask})"
    here, prev, nxt = (f"{g}[{at.format(j=j)}]" for j in ("j", "j - 1", "j + 1"))
    return f"""CASE WHEN size(array_distinct({g})) = size({g}) THEN 0L ELSE
        aggregate(array(sort_array(transform({g}, (x, i) -> (x & ~{mask}) | i))), 0L, (none, s) ->
            aggregate(sort_array(transform(filter(sequence(0, size(s) - 1),
                    j -> (j > 0 AND {here} = {prev}) OR (j < size(s) - 1 AND {here} = {nxt})),
                    j -> {at.format(j='j')})),
                struct(0L AS n, -3 AS last),
                (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)) END"""


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts of each text, one output row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    df = df.withColumn("w", words(F.col("t")))
    df = df.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("g", F.expr("""IF(size(w) < 4, cast(array() AS array<bigint>),
        transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"""))
    return df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words("w", "g")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^\s*([-*•])\s"))).cast("long")
        .alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long")
        .alias("n_ellipsis_lines"),
        F.size(F.filter("w", lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"))


def passes(rule: Rule) -> Column:
    """Whether a measured row lies in the rule's interval (a ratio over zero passes)."""
    x = F.expr(f"try_divide({rule.over.replace(' / ', ', ')})" if " / " in rule.over else rule.over)
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (x >= rule.low)
    if rule.high is not None:
        ok = ok & (x <= rule.high)
    return F.coalesce(ok, F.lit(True))


def verdicts(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.concat_ws(",", *[F.when(~passes(r), F.lit(r.name)) for r in rules])
    return measured.withColumns({"base_failed": base, "failed_rules": failed}) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
