"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and decides on all that the stage
before it kept; its result is written as Parquet to the shared folder and read
again as the next one's ``docs``, so a lost executor costs no earlier stage.
All but the last return the columns of ``documents`` and pass other columns
through.

Rows that share an id stay or go together.  NULL texts are clean, unlike any
other, have no secrets and size 0 (so the mix takes them 0 times); empty texts
alike.  Of equal ids or scores nothing depends on the order of rows.  Texts of
any length are whole in every stage.  An empty table passes every stage empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, mixing, packing, secrets, toxicity
from ledgerlake.llm.common import table, written
from ledgerlake.llm.queries import fold, weights_521


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.7 or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("id", 3) != 1)
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    found = jaccard.join(docs, count_links=False)            # only components decide
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs.doc_id == gone["gone"], "left_anti").select([docs[c] for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; ``n_chars`` follows."""
    df = secrets.redact(secrets.scan(docs))
    found = F.col("redacted").isNotNull()
    new = {"text": F.coalesce("redacted", F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(found, F.length("redacted").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("row.n_chars"))
    return df.select([new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times)."""
    taken = (mixing.mix(docs, weights_521).groupBy("id")
             .agg(F.max("copies").alias("copies")).where("copies > 0"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")   # names that clash stay inside
    return (docs.select(row).join(taken, F.col("row.doc_id").eqNullSafe(F.col("id")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select([F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Scores of trained models and tokenizers have no SQL form; tests/llm compares
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
