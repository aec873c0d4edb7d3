"""Texts go to Python in batches of bounded size, whatever the session was set to."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, mixing, packing, secrets, toxicity
from ledgerlake.llm.common import TEXT_CONF
from ledgerlake.llm.queries import fold, weights_521

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = 6_000_000


def _labels(docs):
    return docs.sparkSession.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")


CALLS = {
    "toxicity.train": lambda d: toxicity.train(d, _labels(d), fold("id", 3) != 1),
    "toxicity.score": lambda d: toxicity.score(d, toxicity.fit([], [], 4), ["doc_id"]),
    "toxicity.clean": lambda d: toxicity.clean(d, toxicity.fit([], [], 4)),
    "jaccard.join": lambda d: jaccard.join(d, count_links=False),
    "secrets.scan": lambda d: secrets.scan(d, [0.0] * len(secrets.ALPHABET) ** 2),
    "mixing.mix": lambda d: mixing.mix(d, weights_521),
    "packing.pieces": lambda d: packing.pieces(d, PATH),
}


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    """3,000 texts of 4 KB and one of 6 MB, in one file."""
    path = str(tmp_path_factory.mktemp("batches") / "documents")
    (spark.range(3001, numPartitions=1)
     .select(F.col("id").alias("doc_id"),
             F.when(F.col("id") == 1500, F.repeat(F.lit("x"), LONG))
             .otherwise(F.rpad(F.col("id").cast("string"), 4000, " word")).alias("text"))
     .write.parquet(path))
    return path


@pytest.mark.parametrize("name", CALLS)
def test_texts_come_in_bounded_batches_and_whole(spark, texts, name):
    def sizes(batches):
        for b in batches:
            longest = max(map(len, b.column(0).to_pylist()), default=0)
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (b.num_rows, b.nbytes, longest)],
                                             ["n", "size", "longest"])

    for k in TEXT_CONF:
        spark.conf.unset(k)
    few = spark.createDataFrame([(1, "a b c", "s"), (2, "d e f", None)], "doc_id long, text string, source string")
    CALLS[name](few)
    got = (spark.read.parquet(texts).select("text").coalesce(1)
           .mapInArrow(sizes, "n long, size long, longest long").collect())
    assert sum(r.n for r in got) == 3001
    assert max(r.longest for r in got) == LONG
    assert all(r.size <= 5_000_000 for r in got if r.longest < LONG)
    assert all(r.size <= LONG + 5_000_000 for r in got)


def test_same_pieces_in_any_batches(spark, texts):
    def rows():
        return sorted(map(tuple, packing.pieces(spark.read.parquet(texts).where("doc_id <> 1500"), PATH).collect()))

    for k in TEXT_CONF:
        spark.conf.unset(k)
    want = rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows() == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
