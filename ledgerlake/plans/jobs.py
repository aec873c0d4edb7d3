"""Batch jobs that materialise the layers: landing → bronze → silver (+ quarantine) → gold → serving.

Each layer is written under the lake root and the next layer reads it back
with its declared schema.  The written table is the lineage cut: a lost
executor recomputes from the last written layer, not from the landing data,
and each layer's plan stays small.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import dedupe_by_key
from ..operators.enrich import check_unique
from ..sources import files, readers, standins, writers
from ..specs import CORRUPT, TableSpec
from . import gold, serving, silver
from .assemble import REFERENCE_SPIKE, Lake

#: Codec of landed text: several times smaller on disk.
LANDING = "gzip"


def bronze_csv_table(spark: SparkSession, csv_path: str, spec: TableSpec | StructType,
                     out_path: str, key: list[str], order: list[str] = (),
                     partition_by: str | None = None) -> DataFrame:
    """CSV master → declared read (header checked, unparsable records kept with
    their text) → lineage → deterministic dedupe by natural key → Parquet
    (optionally partitioned).  Returns the written table read back with its
    schema; its keys are checked to be unique, so joins to it never multiply
    rows."""
    raw = readers.with_lineage(readers.read_csv(spark, csv_path, spec, check_header=True,
                                                keep_corrupt=True))
    bronze = dedupe_by_key(raw, key, order=list(order))
    if partition_by:
        writers.write_partitioned(bronze, out_path, partition_by)
    else:
        writers.write_parquet(bronze, out_path)
    return check_unique(readers.read_parquet(spark, out_path, bronze.schema), key, out_path)


def bronze_masters(spark: SparkSession, sf_dir: str, root: str) -> dict[str, tuple[TableSpec, str]]:
    """The seven masters from landing CSV to bronze; name → (table, path)."""
    out = {}
    for name, (spec, rows) in standins.masters(spark, sf_dir).items():
        landing, path = writers.write_csv(rows, f"{root}/landing/{name}", compression=LANDING), f"{root}/bronze/{name}"
        bronze_csv_table(spark, landing, spec, path, list(spec.key),
                         partition_by=spec.partition_by[0] if spec.partition_by else None)
        out[name] = spec, path
    return out


def bronze_lines(spark: SparkSession, landing: str, schema: StructType, out_path: str) -> DataFrame:
    """JSON lines → declared read with the text of unparsable records → lineage
    → dedupe by id → Parquet."""
    raw = readers.with_lineage(readers.read_jsonl(spark, landing, schema, keep_corrupt=True))
    writers.write_parquet(dedupe_by_key(raw, ["event_id"]), out_path)
    return readers.read_parquet(spark, out_path, raw.schema)


@dataclass
class Layers:
    root: str
    paths: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict)

    def add(self, name: str, path: str, schema: StructType) -> None:
        self.paths[name], self.schemas[name] = path, schema

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> None:
        path = f"{self.root}/{name}"
        if partition_by:
            writers.write_partitioned(df, path, partition_by)
        else:
            writers.write_parquet(df, path)
        self.add(name, path, df.schema)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return readers.read_parquet(spark, self.paths[name], self.schemas[name])

    def bytes(self, spark: SparkSession, name: str) -> int:
        return files.bytes_of(spark, self.paths[name])


def build_gold(spark: SparkSession, layers: Layers, spike=REFERENCE_SPIKE,
               prefix: str = "gold") -> dict[str, gold.Mart]:
    """The five marts from written silver, written partitioned by date."""
    usage = layers.read(spark, "silver/usage_events_clean")
    sources = [
        (gold.DAILY_USAGE, usage, "usage_date"),
        (gold.REVENUE_MONTH, layers.read(spark, "silver/billing_monthly_clean"), "month"),
        (gold.cost_anomaly(*spike), usage, "usage_date"),
        (gold.TICKETS_DAY, layers.read(spark, "silver/support_tickets_clean"), None),
        (gold.tokens_day(standins.GENAI_SERVICE), usage, "usage_date"),
    ]
    for mart, rows, part in sources:
        layers.write(f"{prefix}/{mart.name}", gold.build(rows, mart, mart.attrs), part)
    return {mart.name: mart for mart, *_ in sources}


def split_once(labelled: DataFrame, path: str, label_col: str = "dq_rule") -> list[tuple[str, DataFrame]]:
    """(clean, quarantine) as (folder, rows): the labelled rows are written once,
    a folder per side, and each side is read from its own."""
    spark = labelled.sparkSession
    side = F.when(F.col(label_col).isNull(), "clean").otherwise("quarantine")
    labelled.withColumn("side", side).write.partitionBy("side").parquet(path)
    out = []
    for name in ("clean", "quarantine"):
        folder = f"{path}/side={name}"
        there = files.exists(spark, folder)
        out.append((folder if there else path, readers.read_parquet_files(spark, [folder] if there else [], labelled.schema)))
    return out


def build_layers(spark: SparkSession, lake: Lake, root: str, spike=REFERENCE_SPIKE) -> Layers:
    """Full batch rebuild of every layer into ``root`` (a fresh run folder)."""
    L = Layers(root)
    # bronze: the seven masters and the feed; everything below reads these
    for name, (spec, path) in bronze_masters(spark, lake.sf_dir, root).items():
        L.add(f"bronze/{name}", path, readers.with_corrupt(spec))
    landing = writers.write_text(
        standins.landing_lines(lake.bronze_events(), writers.JSON_TIMESTAMP_FORMAT),
        f"{root}/landing/usage_events", compression=LANDING)
    feed = bronze_lines(spark, landing, lake.bronze_events().schema, f"{root}/bronze/usage_events")
    L.add("bronze/usage_events", f"{root}/bronze/usage_events", feed.schema)

    # silver: rules (threshold fitted on the written bronze), split, enrichment
    orgs, resources = L.read(spark, "bronze/customers_orgs"), L.read(spark, "bronze/resources")
    labelled = silver.labelled_events(feed, spike_q=spike[0], spike_multiplier=spike[1])
    clean, quarantine = split_once(labelled, f"{root}/silver/labelled")
    L.add("silver/quarantine", quarantine[0], quarantine[1].schema)
    clean = clean[1]
    L.write("silver/usage_events_clean",
            silver.silver_usage(clean, orgs, resources,
                                orgs_bytes=L.bytes(spark, "bronze/customers_orgs"),
                                resources_bytes=L.bytes(spark, "bronze/resources")), "usage_date")
    # tickets by month: a question's dates prune folders, and a long sparse
    # history does not become thousands of one-file day folders
    tickets = silver.ticket_features(L.read(spark, "bronze/support_tickets").drop(CORRUPT))
    L.write("silver/support_tickets_clean",
            tickets.withColumn("ticket_month", F.trunc("ticket_date", "month")), "ticket_month")
    L.write("silver/billing_monthly_clean", silver.revenue_usd(
        L.read(spark, "bronze/billing_monthly").drop(CORRUPT), orgs,
        orgs_bytes=L.bytes(spark, "bronze/customers_orgs")), "month")

    # gold, from the written silver; serving, from the written gold
    for name in build_gold(spark, L, spike):
        spec = serving.SERVING[name]
        path = f"{root}/serving/{name}"
        table = serving.serve(L.paths[f"gold/{name}"], L.read(spark, f"gold/{name}"), path, spec)
        L.add(f"serving/{name}", path, table.schema)
    return L


def layer_counts(spark: SparkSession, layers: Layers) -> DataFrame:
    """Rows per written layer, read back from storage."""
    out = None
    for name in layers.paths:
        one = (layers.read(spark, name).agg(F.count("*").alias("rows"))
               .select(F.lit(name).alias("layer"), "rows"))
        out = one if out is None else out.unionByName(one)
    return out
