"""Marts kept as mergeable partial aggregates, one table per mart.

A load (a stream's output, the late rows of one backfill) is aggregated once,
by mart key, into sums, counts, maxima and minima; partial rows of different
loads are merged by key with the same functions, and a mart's columns are
computed from the merged row.  So rows that arrive late change the marts by an
aggregate over themselves, and only the periods they belong to are read again.

``<path>/load=<name>/period=<month>/*.parquet``; a load is complete when its
``_SUCCESS`` is there, is written once, and overwritten if it stopped before.
:meth:`PartialStore.compact` merges the loads there are into one folder, so a
mart read stays one partial row per key however many backfills have run.  Sums
are exact decimals, so the order and number of loads do not matter: merged
partials equal a rebuild from all rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.columns import to_money, whole_of
from ..sources import files
from .gold import Mart, Measure
from .serving import period_of

PERIOD, LOAD = "period", "load"
#: Folders of merged loads begin with this; no load's name may.
MERGED = "merged-"


def _fields(name: str, m: Measure) -> dict[str, tuple[Column, str]]:
    """Partial fields of a measure: name -> (aggregate over rows, how partials merge)."""
    e = F.expr(m.of) if m.of else None
    match m.kind:
        case "total" | "whole":
            return {f"{name}_sum": (F.sum(to_money(e)), "sum")}
        case "rows":
            return {f"{name}_n": (F.count("*"), "sum")}
        case "hits":
            return {f"{name}_hits": (F.count_if(e), "sum")}
        case "share":
            return {f"{name}_hits": (F.count_if(e), "sum"), f"{name}_n": (F.count("*"), "sum")}
        case "mean":
            return {f"{name}_sum": (F.sum(to_money(e)), "sum"), f"{name}_n": (F.count(e), "sum")}
        case "top":
            return {f"{name}_top": (F.max(e), "max")}
        case "earliest":
            first = F.when(F.col(m.by).isNotNull(), F.struct(F.col(m.by).alias("by"), e.alias("value")))
            return {f"{name}_first": (F.min(first), "min")}
    raise ValueError(f"unknown measure kind {m.kind!r}")


def _finish(name: str, m: Measure) -> Column:
    """The measure's value from its merged fields."""
    match m.kind:
        case "total":
            return F.round(f"{name}_sum", m.scale).cast("double")
        case "whole":
            return whole_of(F.col(f"{name}_sum"))
        case "rows":
            return F.col(f"{name}_n")
        case "hits":
            return F.col(f"{name}_hits")
        case "share":
            return F.round(F.col(f"{name}_hits") / F.col(f"{name}_n"), m.scale)
        case "mean":
            return F.round(F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum") / F.col(f"{name}_n")),
                           m.scale).cast("double")
        case "top":
            return F.round(f"{name}_top", m.scale)
        case "earliest":
            return F.col(f"{name}_first.value")
    raise ValueError(f"unknown measure kind {m.kind!r}")


def partials(silver: DataFrame, mart: Mart) -> DataFrame:
    """One partial row per mart key."""
    rows = silver.filter(mart.where) if mart.where else silver
    return rows.groupBy(*mart.grain).agg(*[c.alias(k) for name, m in mart.measures.items()
                                           for k, (c, _) in _fields(name, m).items()])


def merged(parts: DataFrame, mart: Mart) -> DataFrame:
    """Partial rows of one key made one."""
    how = {"sum": F.sum, "max": F.max, "min": F.min}
    return parts.groupBy(*mart.grain).agg(*[how[h](k).alias(k) for name, m in mart.measures.items()
                                            for k, (_, h) in _fields(name, m).items()])


def finished(parts: DataFrame, mart: Mart) -> DataFrame:
    """The mart, as ``gold.build`` returns it, of partial rows merged by key."""
    out = parts.select(*mart.grain, *[_finish(name, m).alias(name) for name, m in mart.measures.items()])
    return out.withColumns({k: F.lit(v) for k, v in mart.constants.items()}) if mart.constants else out


@dataclass
class PartialStore:
    spark: SparkSession
    path: str
    mart: Mart
    time_col: str
    grain: str = "month"

    def loads(self) -> list[str]:
        """Complete loads, whether merged since or not."""
        return sorted(n.split("=", 1)[1] for n in files.names(self.spark, self.path)
                      if n.startswith(f"{LOAD}=") and not n.startswith(f"{LOAD}={MERGED}")
                      and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def add(self, silver: DataFrame, load: str) -> None:
        """Aggregates a load and writes it; a load that is there is left as it is."""
        if load.startswith(MERGED):
            raise ValueError(f"a load's name may not begin with {MERGED!r}")
        if load in self.loads():
            return
        self._write(partials(silver, self.mart), load)

    def _write(self, parts: DataFrame, folder: str) -> None:
        (parts.withColumn(PERIOD, period_of(self.time_col, self.grain)).hint("rebalance", PERIOD)
         .write.mode("overwrite").partitionBy(PERIOD).parquet(f"{self.path}/{LOAD}={folder}"))

    def _last_merge(self) -> tuple[int, dict]:
        """Number of the last compaction, its folder and the loads merged in it."""
        done = [int(n) for n in files.names(self.spark, f"{self.path}/merges") if n.isdigit()]
        if not done:
            return 0, {"folder": None, "loads": []}
        return max(done), json.loads(files.read_text(self.spark, f"{self.path}/merges/{max(done):08d}"))

    def folders(self) -> list[str]:
        """What holds every load once: the last merge and the loads since."""
        _, last = self._last_merge()
        since = sorted(set(self.loads()) - set(last["loads"]))
        return [last["folder"], *since] if last["folder"] else since

    def compact(self, silver_schema: StructType) -> str | None:
        """Merges all loads into one folder; returns it (None if there is nothing
        to merge, or another compaction was first).

        The folder counts as soon as a file that names it and its loads is there,
        created once and whole: a reader sees the loads apart or merged, never
        both, and a compaction that stops leaves the loads as they were.  Loads
        added meanwhile are not in it and stay beside it.  Old folders stay, so a
        reader that listed them goes on.
        """
        number, last = self._last_merge()
        loads = sorted({*self.loads(), *last["loads"]})
        since = [n for n in loads if n not in set(last["loads"])]
        folders = [last["folder"], *since] if last["folder"] else since
        if len(folders) < 2:
            return None
        folder = f"{MERGED}{number + 1:08d}-{uuid.uuid4().hex[:8]}"
        self._write(merged(self.read(self._schema(silver_schema), None, folders), self.mart), folder)
        won = files.create_once(self.spark, f"{self.path}/merges/{number + 1:08d}",
                                json.dumps({"folder": folder, "loads": loads}))
        return folder if won else None

    def _schema(self, silver_schema: StructType) -> StructType:
        return partials(self.spark.createDataFrame([], silver_schema), self.mart).schema

    def periods(self, load: str) -> list:
        """Periods that a load touches: its folders."""
        found = [n.split("=", 1)[1] for n in files.names(self.spark, f"{self.path}/{LOAD}={load}")
                 if n.startswith(f"{PERIOD}=")]
        return sorted((None if n == "__HIVE_DEFAULT_PARTITION__" else n for n in found), key=str)

    def read(self, schema: StructType, periods: list | None = None, folders: list[str] | None = None) -> DataFrame:
        """Partial rows of all complete loads; those of some periods only."""
        fields = StructType([*schema.fields, StructField(LOAD, StringType()), StructField(PERIOD, DateType())])
        paths = [f"{self.path}/{LOAD}={n}" for n in (self.folders() if folders is None else folders)]
        if not paths:
            return self.spark.createDataFrame([], fields)
        df = self.spark.read.schema(fields).option("basePath", self.path).parquet(*paths)
        if periods is None:
            return df
        some = F.col(PERIOD).isin([F.lit(p).cast("date") for p in periods if p is not None])
        return df.where(some | F.col(PERIOD).isNull() if None in periods else some)

    def build(self, silver_schema: StructType, periods: list | None = None) -> DataFrame:
        """The mart of all loads, or its rows of some periods."""
        return finished(merged(self.read(self._schema(silver_schema), periods), self.mart), self.mart)
