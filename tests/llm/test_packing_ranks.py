"""Ranks of pieces: lengths cut by a hash, nothing written to the shared folder."""

from pyspark.sql import functions as F

from ledgerlake.llm import packing
from ledgerlake.session import lake_root
from ledgerlake.sources import files


def _written(spark):
    return {n for n in files.names(spark, f"{lake_root(spark)}/llm") if n.startswith("packing")}


def test_ranks_of_cut_lengths(spark):
    # one length has most pieces, one a single piece; rows repeat and ids are null
    rows = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 1000).alias("doc_id"), F.lit(0).alias("piece"),
        F.when(F.col("id") == 7, 3).when(F.col("id") % 7 == 0, 500).otherwise(1024).cast("long").alias("length"),
        (F.col("id") % 11).cast("long").alias("ids_crc32"))
    before = _written(spark)
    got, total = packing.ranked(rows)
    got = got.withColumn("tie", F.xxhash64("doc_id", "piece", "ids_crc32")).collect()
    assert _written(spark) == before
    assert len(got) == 3000 and total == {3: 1, 500: 428, 1024: 2571}
    for size, n in total.items():
        own = sorted((r for r in got if r.length == size), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(n))
        assert [r.tie for r in own] == sorted(r.tie for r in own)


def test_bits_of_a_cut():
    assert packing._split({5: 10, 6: 11, 7: 20, 8: 41}, 10) == {6: 1, 7: 1, 8: 3}
