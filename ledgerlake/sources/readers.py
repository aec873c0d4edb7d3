"""Declared-schema scans (batch and stream) and lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..specs import CORRUPT, TableSpec


def _schema_of(spec: TableSpec | StructType) -> StructType:
    return spec.schema if isinstance(spec, TableSpec) else spec


def with_corrupt(spec: TableSpec | StructType) -> StructType:
    """The schema plus the column that keeps the text of unparsable records."""
    schema = _schema_of(spec)
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def read_csv(spark: SparkSession, path: str, spec: TableSpec | StructType, *,
             header: bool = True, check_header: bool = True,
             mode: str = "PERMISSIVE", keep_corrupt: bool = False) -> DataFrame:
    """CSV with header and a declared schema.

    With ``check_header`` the header names must match the declared columns
    (``enforceSchema=false``); otherwise CSV binds columns by position and a
    six-column schema over a seven-column file silently shifts values.  With
    ``keep_corrupt`` a record that does not fit the schema keeps its text in
    ``_corrupt_record`` instead of turning into NULLs unseen.
    """
    return (spark.read.schema(with_corrupt(spec) if keep_corrupt else _schema_of(spec))
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("header", header)
            .option("enforceSchema", not check_header)
            .option("mode", mode)
            .csv(path))


JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_jsonl(spark: SparkSession, path: str | list[str], spec: TableSpec | StructType, *,
               keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with a declared schema; ``keep_corrupt`` as in ``read_csv``."""
    return (spark.read.schema(with_corrupt(spec) if keep_corrupt else _schema_of(spec))
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path))


def read_parquet(spark: SparkSession, path: str,
                 spec: TableSpec | StructType | None = None) -> DataFrame:
    """Parquet layer read with its declared schema.

    A declared schema keeps partition columns at their declared type and makes
    a layer that holds no file yet (an empty mart) read as zero rows.
    """
    r = spark.read
    if spec is not None:
        r = r.schema(_schema_of(spec))
    return r.parquet(path)


def read_parquet_files(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Some Parquet folders with one declared schema (no folder: no rows)."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stream_jsonl(spark: SparkSession, path: str, spec: TableSpec | StructType, *,
                 max_files_per_trigger: int = 10) -> DataFrame:
    return (spark.readStream.schema(_schema_of(spec))
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("timestampFormat", JSON_TIMESTAMP_FORMAT)
            .json(path))


def stream_parquet(spark: SparkSession, path: str, spec: TableSpec | StructType, *,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(_schema_of(spec))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Bronze lineage: ingestion time and the file each row came from.

    ``_metadata.file_path`` is the file-source metadata column (works for batch
    and streaming file sources alike).
    """
    return df.withColumns({
        "ingest_ts": F.current_timestamp(),
        "source_file": F.col("_metadata.file_path"),
    })
