"""Chat formatting by multi-party perspective rotation.

A dialogue is rendered once for every participant: that speaker's turns become
the ``assistant`` turns that carry loss, the turns of the others become
``user`` turns that name their speaker, system turns stay as they are.

One output row per turn and perspective, with its place in the dialogue, its
rendered text and the span of that text on which a model is trained, so a
dialogue of any length (or one that holds a third of all turns) is never
gathered into one row.  :func:`transcripts` joins the rows of each dialogue
for consumers that want one text.

Defined results: NULL conv_id is a dialogue of its own; NULL role is the
speaker ``unknown``; NULL text is the empty text; turns with equal or NULL
``turn`` numbers are all kept, ordered by (turn, role, text) with NULL first, so
ties and repeated rows are told by their text or alike; texts of any length are
rendered whole; a dialogue with system turns only has no participant and no row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

#: Fixed values of the chat template.
OPEN, CLOSE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text", system: str = "system") -> DataFrame:
    """(conv_id, perspective, turn, speaker, role, rendered, mask_start, mask_end).

    ``mask_start`` / ``mask_end`` are code points in ``rendered`` (end
    exclusive) of the words and the end mark the assistant is trained to write;
    -1 on the other rows.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    # written, so the join is of plain tables and a dialogue with very many turns
    # can be split over tasks
    people = written(t.where(F.col("speaker") != system)
                     .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective"))
                     .distinct(), "chat-people")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == system, "system").when(own, "assistant").otherwise("user")
    head = F.concat(F.lit(OPEN), F.col("role"),
                    F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("speaker")))
                    .otherwise(F.lit("")), F.lit(CLOSE))
    trained = F.col("role") == "assistant"
    return (t.join(people, F.col("conv_id").eqNullSafe(F.col("of")))
            .withColumn("role", role)
            .withColumn("rendered", F.concat(head, F.col("text"), F.lit(END)))
            .select("conv_id", "perspective", "turn", "speaker", "role", "rendered",
                    F.when(trained, F.length(head)).otherwise(-1).cast("long").alias("mask_start"),
                    F.when(trained, F.length("rendered") - 1).otherwise(-1).cast("long")
                    .alias("mask_end")))


def transcripts(rotated: DataFrame) -> DataFrame:
    """One text per (conv_id, perspective) with its list of masked spans.

    A transcript is one row, so its dialogue must fit a task; use the rows of
    :func:`rotate` where it may not.
    """
    rows = F.sort_array(F.collect_list(F.struct(
        "turn", "speaker", "rendered", "mask_start", "mask_end")))
    df = rotated.groupBy("conv_id", "perspective").agg(rows.alias("r"))
    return df.select(
        "conv_id", "perspective", F.expr("array_join(r.rendered, '')").alias("text"),
        F.expr("""aggregate(r, struct(0L AS pos, cast(array() AS array<struct<s:bigint,e:bigint>>) AS m),
            (a, x) -> struct(a.pos + length(x.rendered) AS pos,
                CASE WHEN x.mask_start < 0 THEN a.m ELSE concat(a.m, array(struct(
                    a.pos + x.mask_start AS s, a.pos + x.mask_end AS e))) END AS m)).m""")
        .alias("mask"))
