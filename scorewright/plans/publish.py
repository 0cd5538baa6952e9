"""Staging and publishing of scored snapshots.

Tables live in three zones (ops / staging / prod databases).  Each table is an
external Parquet table whose folder is under a shared table root (by default
``<spark.checkpoint.dir>/tables``), so every executor can reach it.

* Every snapshot is written to a folder of its own (``<table>/runs/<run>``) by a plain
  ``DataFrameWriter``, so the deployment's output committer applies, and one metadata
  statement then makes it visible.  A failed write leaves the table as it was.
* Rows are counted while they are written (``Observation``); nothing is read again for a count.
* staging: full refresh (drop + create over the written folder), 60 columns, ``archv`` and
  ``time_stamp`` literals; written once and read back by every publish step,
  so scoring never runs twice and lineage is cut at a stored table.
* current: unpartitioned, replaced each run; the replaced snapshot's folder becomes partition
  ``(archive that replaced it, run)`` of ``<current>_purge`` (zero-copy).
* slim / weekly / monthly: exactly the partitions of the run are replaced, so a rerun of an
  archive is idempotent; a replaced folder goes to ``<table>_purge``.
  weekly / monthly carry tokenized keys (one pass, or as many as their ``token_passes`` says).
* ``<table>_published`` shows one whole version of each table to every session (:mod:`scorewright.plans.versions`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from scorewright.functions.columns import ident, text
from scorewright.functions.tokens import secret, token
from scorewright.plans.layout import SLIM, STAGING, TOKENIZED
from scorewright.plans.retention import new_run, switch_current, switch_partitions
from scorewright.plans.versions import ddl
from scorewright.session import shared_root


@dataclass(frozen=True)
class Zones:
    ops: str = "ops"
    staging: str = "staging"
    prod: str = "prod"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[str, ...]
    partitioned: bool
    token_passes: int = 0
    keep: int | None = None          # newest partitions kept by retention; None = keep all
    zone: str = "prod"


@dataclass(frozen=True)
class Layout:
    zones: Zones = field(default_factory=Zones)
    raw: str = "scored_raw"
    staging: str = "scored_staging"
    current: TableSpec = TableSpec("scored_current", tuple(STAGING), False)
    slim: TableSpec = TableSpec("scored_slim", tuple(SLIM), True, 0, 60)
    weekly: TableSpec = TableSpec("scored_weekly", tuple(STAGING), True, 1, 12)
    monthly: TableSpec = TableSpec("scored_monthly", tuple(STAGING), True, 1, 60)
    rejects: TableSpec = TableSpec("scored_raw_rejects", ("bad_file", "infocheck_id", "fields_read", "bad_line", "time_stamp"), True, 0, None, "ops")
    table_root: str | None = None

    def published(self) -> tuple[TableSpec, ...]:
        return self.current, self.slim, self.weekly, self.monthly

    def qualified(self, zone: str, name: str) -> str:
        return f"{getattr(self.zones, zone)}.{name}"

    def location(self, spark: SparkSession, zone: str, name: str) -> str:
        root = self.table_root or f"{shared_root(spark)}/tables"
        return f"{root.rstrip('/')}/{getattr(self.zones, zone)}/{name}"


def ensure_zones(spark: SparkSession, layout: Layout) -> None:
    for db in (layout.zones.ops, layout.zones.staging, layout.zones.prod):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(db)}")


def staged(scored: DataFrame, archive, run_ts: str) -> DataFrame:
    """The 60 staging columns.  ``archive`` is an int or a Column (back-fills)."""
    archv = (archive if not isinstance(archive, int) else F.lit(archive)).cast("int")
    extra = {"sexo": F.lit(None).cast("string"), "archv": archv,
             "time_stamp": F.date_format(F.to_timestamp(F.lit(run_ts)), "yyyy-MM-dd HH:mm:ss")}
    return scored.select(*[extra[c].alias(c) if c in extra else F.col(c) for c in STAGING])


def write_staging(spark: SparkSession, layout: Layout, staging_df: DataFrame) -> DataFrame:
    """S6 + S7: write the Parquet folder, drop the table, create it over that folder, read it back."""
    ensure_zones(spark, layout)
    table = layout.qualified("staging", layout.staging)
    folder = f"{layout.location(spark, 'staging', layout.staging)}/runs/{new_run()}"
    staging_df.write.parquet(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({ddl(staging_df.schema.fields)}) USING parquet LOCATION {text(folder)}")
    return spark.table(table)


def ensure_table(spark: SparkSession, layout: Layout, spec: TableSpec, schema: StructType) -> str:
    ensure_zones(spark, layout)
    table = layout.qualified(spec.zone, spec.name)
    cols = StructType([schema[c] for c in spec.columns])
    if spec.partitioned:
        cols = StructType(list(cols.fields) + [StructField("archive", IntegerType(), True)])
    part = " PARTITIONED BY (archive)" if spec.partitioned else ""
    base = layout.location(spark, spec.zone, spec.name)
    # an unpartitioned table starts on an empty folder beside the runs, so it never lists one half written
    folder = base if spec.partitioned else f"{base}/empty"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl(cols.fields)}) USING parquet{part} LOCATION {text(folder)}")
    return table


def _columns(spark: SparkSession, spec: TableSpec, token_key: str) -> list[Column]:
    key = secret(spark, token_key) if spec.token_passes else None
    return [token(c, TOKENIZED[c], key, spec.token_passes).alias(c) if spec.token_passes and c in TOKENIZED else F.col(c)
            for c in spec.columns]


def _run_folder(spark: SparkSession, layout: Layout, spec: TableSpec, run: str) -> str:
    return f"{layout.location(spark, spec.zone, spec.name)}/runs/{run}"


def counted(df: DataFrame, seen: Observation | None) -> DataFrame:
    """``rows`` of ``seen`` are those of ``df`` once it has been written."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))


def publish_partition(spark: SparkSession, layout: Layout, spec: TableSpec, staging: DataFrame, archive: int,
                      token_key: str, seen: Observation | None = None) -> list[int]:
    """Write the snapshot, make it partition ``archive`` and keep the newest ``spec.keep`` archives, as one
    version.  Returns the archives that retention dropped."""
    table = ensure_table(spark, layout, spec, staging.schema)
    run = new_run()
    rows = staging.select(*_columns(spark, spec, token_key))
    counted(rows, seen).write.parquet(f"{_run_folder(spark, layout, spec, run)}/archive={int(archive)}")
    return switch_partitions(spark, table, {archive: run}, spec.keep)


def publish_partitions(spark: SparkSession, layout: Layout, spec: TableSpec, staging: DataFrame, archives: list[int],
                       token_key: str) -> list[int]:
    """Back-fill: rows carry their own ``archive``, one of ``archives``; only these partitions are replaced.
    ``rebalance`` lets AQE split a hot archive over several tasks and merge small ones, so no
    task holds a whole archive and files stay sized.  Rows without an archive are left out."""
    table = ensure_table(spark, layout, spec, staging.schema)
    run = new_run()
    (staging.where(F.col("archive").isNotNull()).select(*_columns(spark, spec, token_key), "archive").hint("rebalance", "archive")
     .write.partitionBy("archive").parquet(_run_folder(spark, layout, spec, run)))
    return switch_partitions(spark, table, dict.fromkeys(archives, run), spec.keep)


def publish_current(spark: SparkSession, layout: Layout, staging: DataFrame, archive: int, seen: Observation | None = None) -> None:
    """S8 + R4/R5 for the unpartitioned table, zero-copy: write the new snapshot, hand the folder being
    replaced to ``<name>_purge`` as partition ``(archive, run)``, then point the table at the new folder."""
    spec = layout.current
    table = ensure_table(spark, layout, spec, staging.schema)
    run = new_run()
    counted(staging.select(*spec.columns), seen).write.parquet(_run_folder(spark, layout, spec, run))
    switch_current(spark, table, archive, run)
