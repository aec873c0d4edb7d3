"""Declarative data-quality rules: ordered labelling and a total split.

A rule is a name plus a predicate.  Labelling assigns the *first* rule that
holds; the split sends labelled rows to quarantine and unlabelled rows to
the clean side.  Every predicate is wrapped in ``coalesce(pred, false)``
so a NULL operand can never make a row satisfy neither side: clean and
quarantine are complements and together always equal the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_flag, out_of_range


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


# ---- fixed values: rule labels written to the quarantine table ------------
R1_LABEL = "R1_event_id_nulo"
R2_LABEL = "R2_costo_anomalo"
R3_LABEL = "R3_unit_nulo_con_value"
# labels of this library, for rows the three rules above would let through
CORRUPT_LABEL = "R0_registro_corrupto"
RANGE_LABEL = "R4_numero_fuera_de_rango"
TIME_LABEL = "R5_timestamp_nulo"
AMOUNT_LABEL = "B1_importe_fuera_de_rango"
# costs below this bound (strictly) are rejected
NEGATIVE_COST_BOUND = -0.01
# ---------------------------------------------------------------------------


def usage_rules(id_col: str = "event_id", cost_col: str = "cost_usd_increment",
                value_col: str = "value_num", unit_col: str = "unit",
                time_col: str = "timestamp", corrupt_col: str | None = None,
                numbers: Sequence[str] = ("value_num", "cost_usd_increment", "carbon_kg",
                                          "genai_tokens")) -> list[Rule]:
    """R1 missing id, R2 cost below the bound, R3 value present without unit.

    Around them: R0 for records the reader could not parse (``corrupt_col`` holds
    their text), R4 for numbers no sum can hold (infinite, NaN, beyond the
    bound) and R5 for events without a time, which belong to no day.
    """
    beyond = reduce(lambda a, b: a | b, [as_flag(out_of_range(c)) for c in numbers])
    first = [Rule(CORRUPT_LABEL, F.col(corrupt_col).isNotNull())] if corrupt_col else []
    return first + [
        Rule(R1_LABEL, F.col(id_col).isNull()),
        Rule(R2_LABEL, F.col(cost_col) < F.lit(NEGATIVE_COST_BOUND)),
        Rule(R3_LABEL, F.col(value_col).isNotNull() & F.col(unit_col).isNull()),
        Rule(RANGE_LABEL, beyond),
        Rule(TIME_LABEL, F.col(time_col).isNull()),
    ]


def amount_rules(cols: Sequence[str | Column]) -> list[Rule]:
    """Invoices whose amounts or rate no sum can hold."""
    return [Rule(AMOUNT_LABEL, reduce(lambda a, b: a | b, [as_flag(out_of_range(c)) for c in cols]))]


def rule_label(rules: list[Rule]) -> Column:
    """First matching rule's name, NULL when the row passes every rule."""
    expr = None
    for r in rules:
        p = as_flag(r.predicate)
        expr = F.when(p, F.lit(r.name)) if expr is None else expr.when(p, F.lit(r.name))
    return expr.otherwise(F.lit(None).cast("string"))


def label(df: DataFrame, rules: list[Rule], label_col: str = "dq_rule") -> DataFrame:
    return df.withColumn(label_col, rule_label(rules))


def split(labelled: DataFrame, label_col: str = "dq_rule") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) from one labelled frame: a disjoint, total cover."""
    is_bad = F.col(label_col).isNotNull()
    return labelled.filter(~is_bad), labelled.filter(is_bad)


def split_report(labelled: DataFrame, label_col: str = "dq_rule") -> DataFrame:
    """Rows per side and per rule, plus the input total: one small aggregate.

    Output columns: side ('clean' / 'quarantine' / 'input'), dq_rule, rows.
    The reconciliation clean + quarantine = input holds by construction and
    is asserted in the tests.
    """
    per_rule = (labelled.groupBy(F.col(label_col).alias("dq_rule"))
                .agg(F.count("*").alias("rows"))
                .withColumn("side", F.when(F.col("dq_rule").isNull(), F.lit("clean"))
                            .otherwise(F.lit("quarantine"))))
    # The input total is summed from the per-rule aggregate (a handful of
    # rows) instead of a second scan of the labelled input.
    total = per_rule.agg(F.sum("rows").alias("rows")).select(
        F.lit("input").alias("side"), F.lit(None).cast("string").alias("dq_rule"), "rows")
    return per_rule.select("side", "dq_rule", "rows").unionByName(total)
