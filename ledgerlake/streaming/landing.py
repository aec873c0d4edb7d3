"""Feed replayer: lands a frame as a sequence of file groups for a file stream.

A stand-in for the delivery of files (there is no live feed to read): it is
used by the stream queries and tests only.  A file stream source takes files in
modification-time order, so the order in which groups are written is the order
in which they are consumed.

Every row lands: groups are the distinct values of a group column, whatever
they are (days before the first, NULL for rows without a time).  The frame is
computed once, into a staging table with a folder per group; each group is then
written from its own folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import run_dir
from ..sources.writers import JSON_TIMESTAMP_FORMAT

GROUP = "_file_no"


def file_number(event_time: str, start: str, days_per_file: int) -> Column:
    days = F.datediff(F.to_date(event_time), F.lit(start).cast("date"))
    return F.floor(days / F.lit(days_per_file)).cast("int")


def land_files(df: DataFrame, path: str, file_no: Column, *, last: tuple = (),
               fmt: str = "json", drop: tuple[str, ...] = ()) -> list:
    """Append one file group per distinct ``file_no``; returns the groups in
    the order they landed: NULL first, then ascending, those in ``last`` (in
    that order) after all others."""
    spark = df.sparkSession
    staging = run_dir(spark, "landing_groups")
    tagged = df.withColumn(GROUP, file_no).drop(*drop)
    # one file per group: a delivery is one file, and two files of one group would
    # pass the stream as two deliveries
    tagged.repartition(GROUP).write.partitionBy(GROUP).parquet(staging)
    staged = spark.read.schema(tagged.schema).parquet(staging)
    groups = [r[0] for r in staged.select(GROUP).distinct().collect()]     # folders
    groups.sort(key=lambda g: (g in last and 1 + last.index(g), g is not None, g or 0))
    for g in groups:
        part = staged.filter(F.col(GROUP).isNull() if g is None else F.col(GROUP) == g).drop(GROUP)
        w = part.write.mode("append")
        if fmt == "json":
            w.option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)
        else:
            w.parquet(path)
    return groups
