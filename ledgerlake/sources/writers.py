"""Parquet / CSV / JSON sinks and the bytes-per-layer report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: str | list[str], *,
                      dynamic: bool = False, sort_by: list[str] | None = None,
                      mode: str = "overwrite") -> str:
    """Partitioned Parquet write.

    ``rebalance`` on the partition columns lets AQE size the write tasks:
    small partitions are coalesced (no small-file storm of one file per task
    per date) and a hot date is split over several tasks instead of landing in
    a single one.  ``dynamic`` replaces only the partitions present in ``df``
    (incremental days); static replaces the whole table (full rebuild).
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df.hint("rebalance", *cols)
    if sort_by:
        out = out.sortWithinPartitions(*cols, *sort_by)
    w = out.write.mode(mode).partitionBy(*cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


#: Rows of a compressed text file: one task reads it whole.
FILE_ROWS = 100_000


def write_csv(df: DataFrame, path: str, *, header: bool = True, compression: str = "none") -> str:
    _text_writer(df, compression).option("header", header).csv(path)
    return path


def _text_writer(df: DataFrame, compression: str):
    w = df.write.mode("overwrite").option("compression", compression)
    return w if compression == "none" else w.option("maxRecordsPerFile", FILE_ROWS)


# Full microsecond precision in JSON text (the default format keeps millis).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)
    return path


def write_text(df: DataFrame, path: str, *, compression: str = "none") -> str:
    """One string column as text, a line per row."""
    _text_writer(df, compression).text(path)
    return path


def layer_sizes(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Bytes on disk per layer, and in MB rounded to two digits.

    Uses the ``binaryFile`` source for its file listing and ``length`` column;
    the ``content`` column is never selected, so no file body is read.
    """
    files = None
    for layer, path in layers.items():
        one = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
               .select(F.lit(layer).alias("layer"), "length"))
        files = one if files is None else files.unionByName(one)
    return (files.groupBy("layer")
            .agg(F.sum("length").alias("bytes"),
                 F.round(F.sum("length") / (1024 * 1024), 2).alias("mb")))
