"""Versions of a published table: a complete list of partition folders each, and one pointer to the newest.

``<table>_versions`` is an external table partitioned by ``(version, archive, run)``; a version's partitions are the
run folders that the published table consists of, so a version is metadata only.  ``<table>_published`` is a view over
one version.  A publish adds all partitions of the next version in one statement and then replaces the view in one
statement: a reader of the view, in any session, sees the whole old or the whole new version, and a run that breaks off
leaves the old one.  The plain table follows the version afterwards, partition by partition; its property ``version``
says how far it has come, and a later run puts a table that lags in order first.

The run id is part of the partition's name, so every folder is known from one listing of partition names; no partition
has to be described.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from scorewright.functions.columns import ident, text

KEPT_VERSIONS = 2               # versions whose partitions stay registered besides the newest


def versions_table(table: str) -> str:
    return f"{table}_versions"


def view_name(table: str) -> str:
    return f"{table}_published"


def ddl(fields: list[StructField]) -> str:
    return ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in fields)


def partition_specs(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Names of all partitions: one catalog call."""
    return [dict(part.split("=", 1) for part in row[0].split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def property_of(spark: SparkSession, table: str, key: str = "version") -> int:
    if not spark.catalog.tableExists(table):
        return 0
    return int(dict(tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()).get(key, 0))


def newest(spark: SparkSession, table: str) -> int:
    """Number of the published version; 0 before the first."""
    return property_of(spark, view_name(table))


def entries(spark: SparkSession, table: str, version: int | None = None) -> dict[int, str]:
    """``{archive: run}`` of a version (default: the published one)."""
    version = newest(spark, table) if version is None else version
    if not version:
        return {}
    return {int(p["archive"]): p["run"] for p in partition_specs(spark, versions_table(table)) if int(p["version"]) == version}


def base_folder(location: str) -> str:
    return location.split("/runs/")[0].removesuffix("/empty").rstrip("/")


def run_folder(base: str, archive: int, run: str, partitioned: bool) -> str:
    return f"{base}/runs/{run}" + (f"/archive={int(archive)}" if partitioned else "")


def ensure_versions(spark: SparkSession, table: str, base: str) -> str:
    name = versions_table(table)
    if not spark.catalog.tableExists(name):
        fields = [f for f in spark.table(table).schema.fields if f.name != "archive"]
        keys = [StructField("version", IntegerType()), StructField("archive", IntegerType()), StructField("run", StringType())]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(StructType([*fields, *keys]).fields)}) USING parquet "
                  f"PARTITIONED BY (version, archive, run) LOCATION {text(base + '_versions')}")
    return name


def commit(spark: SparkSession, table: str, content: dict[int, str], base: str, partitioned: bool) -> int:
    """Make ``content`` (``{archive: run}``) the published version.  The last statement that readers notice is the view's."""
    name, now = ensure_versions(spark, table, base), newest(spark, table)
    there = partition_specs(spark, name)
    new = now + 1
    # what a run that broke off before its view left behind, and versions too old to keep
    stale = [p for p in there if int(p["version"]) > now or int(p["version"]) < new - KEPT_VERSIONS]
    if stale:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(
            f"PARTITION (version={p['version']}, archive={p['archive']}, run={text(p['run'])})" for p in stale))
    if content:
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION (version={new}, archive={int(a)}, run={text(run)}) LOCATION {text(run_folder(base, a, run, partitioned))}"
            for a, run in sorted(content.items())))
    columns = ", ".join(ident(f.name) for f in spark.table(table).schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {view_name(table)} TBLPROPERTIES ('version' = '{new}') AS "
              f"SELECT {columns} FROM {name} WHERE version = {new}")
    return new


def mark(spark: SparkSession, table: str, version: int) -> None:
    """The plain table now holds ``version``."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('version' = '{int(version)}')")
    spark.catalog.refreshTable(table)
