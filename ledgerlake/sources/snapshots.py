"""Tables of immutable folders under a versioned manifest.

``data/<write>/<folder>/*.parquet``  rows; a folder holds one combination of the
                                     layout columns and is never changed
``manifests/<write>``                a Parquet table of one row per folder: layout
                                     values, path, rows, bytes, and the least and
                                     greatest value of the zone columns
``log/<version>.json``               which manifest a version is, and the last batch
                                     of every writer

A version exists as soon as its log file does, which is created by one rename
that fails where the version is taken: a writer that comes second starts over on
the new version.  A reader picks a version once and reads its folders only, so
it sees the table before a commit or after it, never between.  Work that stops
before its commit leaves folders that no manifest names.

The manifest grows with folders (hundreds of MB each), not with rows.  Predicates
on layout and zone columns are answered by it, so a scan opens only folders that
may hold an answer (data skipping).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import files


class Conflict(Exception):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Version:
    number: int
    manifest: str | None
    batches: dict[str, int]


@dataclass
class SnapshotTable:
    spark: SparkSession
    path: str
    schema: StructType
    layout: tuple[str, ...]
    sort_by: tuple[str, ...] = ()
    zones: tuple[str, ...] = ()

    # ---------------------------------------------------------- versions
    def head(self) -> Version:
        """The latest version (number 0 before the first commit)."""
        found = [int(n[:-5]) for n in files.names(self.spark, f"{self.path}/log") if n.endswith(".json")]
        return self.version(max(found)) if found else Version(0, None, {})

    def version(self, number: int) -> Version:
        v = json.loads(files.read_text(self.spark, f"{self.path}/log/{number:020d}.json"))
        return Version(number, v["manifest"], v["batches"])

    def manifest_schema(self) -> StructType:
        zone = [StructField(f"{side}_{z}", self.schema[z].dataType) for z in self.zones for side in ("low", "high")]
        return StructType([*(self.schema[c] for c in self.layout), StructField("folder", StringType()),
                           StructField("rows", LongType()), StructField("bytes", LongType()), *zone])

    def manifest(self, version: Version) -> DataFrame:
        if version.manifest is None:
            return self.spark.createDataFrame([], self.manifest_schema())
        return self.spark.read.schema(self.manifest_schema()).parquet(f"{self.path}/manifests/{version.manifest}")

    # ---------------------------------------------------------- reading
    def read(self, version: Version | None = None, where: Column | None = None) -> DataFrame:
        """Rows of one version; ``where`` is a predicate on the manifest's columns
        that folders must pass (their rows are not filtered further)."""
        m = self.manifest(version or self.head())
        folders = [r.folder for r in (m if where is None else m.where(where)).select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    # ---------------------------------------------------------- writing
    def write(self, rows: DataFrame) -> str:
        """Writes folders that no version names yet; returns the write's name."""
        name = uuid.uuid4().hex
        # the folders' names are copies: the layout columns stay in the files
        copies = {f"_{i}": F.col(c) for i, c in enumerate(self.layout)}
        out = rows.select(*self.schema.fieldNames()).withColumns(copies).hint("rebalance", *copies)
        (out.sortWithinPartitions(*copies, *self.sort_by).write.partitionBy(*copies)
         .parquet(f"{self.path}/data/{name}"))
        return name

    def folders_of(self, write: str) -> DataFrame:
        """Manifest rows of a write, from its files."""
        root = f"{self.path}/data/{write}"
        cols = [*dict.fromkeys((*self.layout, *self.zones))]
        at = F.regexp_extract("path", f"({write}/.*)/[^/]*$", 1)
        # each file's size counts once, whatever its rows
        per_file = (self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(root)
                    .select(*cols, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
                    .groupBy(*self.layout, "path", "size")
                    .agg(F.count("*").alias("n"), *[f(z).alias(f"{side}_{z}") for z in self.zones
                                                    for side, f in (("low", F.min), ("high", F.max))]))
        return (per_file.groupBy(*self.layout, at.alias("folder"))
                .agg(F.sum("n").alias("rows"), F.sum("size").alias("bytes"),
                     *[f(f"{side}_{z}").alias(f"{side}_{z}") for z in self.zones
                       for side, f in (("low", F.min), ("high", F.max))]))

    def commit(self, base: Version, write: str | None, drop: Column, *, writer: str | None = None,
               batch: int = 0) -> Version:
        """The version after ``base``: its folders without those that ``drop``
        holds for, and the folders of ``write``.  Raises ``Conflict`` if ``base``
        is not the latest any more."""
        kept = self.manifest(base).where(~F.coalesce(drop, F.lit(False)))
        new = kept if write is None else kept.unionByName(self.folders_of(write))
        name = uuid.uuid4().hex
        new.coalesce(1).write.parquet(f"{self.path}/manifests/{name}")
        batches = {**base.batches, **({writer: batch} if writer else {})}
        text = json.dumps({"manifest": name, "batches": batches})
        if not files.create_once(self.spark, f"{self.path}/log/{base.number + 1:020d}.json", text):
            raise Conflict(f"version {base.number + 1} of {self.path} is taken")
        return Version(base.number + 1, name, batches)


def retried(work, times: int = 5):
    """``work()`` again on the new version where another writer was first."""
    for left in reversed(range(times)):
        try:
            return work()
        except Conflict:
            if not left:
                raise


def may_hold(column: str, value) -> Column:
    """Manifest predicate: a folder's range of a zone column has the value."""
    v = value if isinstance(value, Column) else F.lit(value)
    return (F.col(f"low_{column}") <= v) & (F.col(f"high_{column}") >= v)
