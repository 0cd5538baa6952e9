"""Run folders that no table refers to.

A run that breaks off between its write and its switch leaves a folder ``<table>/runs/<run>`` that nothing reads.  The
folder names (one listing a table, as many as there were runs) are anti-joined with the runs that partition names and
table locations refer to: published, versioned, purged.  No data is read, and no partition is described.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.functions.columns import text
from scorewright.plans import versions as V
from scorewright.plans.publish import Layout
from scorewright.plans.retention import published_runs, run_of, table_location

ORPHANS = "table_name string, run string, folder string, age_hours double"


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Metadata-sized rows as a literal relation."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = ", ".join(c.split()[0] for c in schema.split(", "))
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(r) + ')' for r in rows)} AS t({names})")


def run_folders(spark: SparkSession, base: str) -> list[tuple[str, str, float]]:
    """``run, folder, age in hours`` of every run folder of a table, half-written ones included."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/runs")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    now = time.time() * 1000
    return [(s.getPath().getName(), s.getPath().toString(), (now - s.getModificationTime()) / 3_600_000) for s in fs.listStatus(path)]


def referenced_runs(spark: SparkSession, table: str) -> set[str]:
    """Runs that a table's location, its partitions, its versions or its purge table refer to."""
    out = {run_of(table_location(spark, table).rstrip("/"))}
    for name in (V.versions_table(table), table + "_purge"):
        if spark.catalog.tableExists(name):
            out |= {p["run"] for p in V.partition_specs(spark, name)}
    if not V.newest(spark, table) and spark.table(table).schema.names[-1] == "archive":
        out |= set(published_runs(spark, table).values())
    return {r for r in out if r}


def orphan_runs(spark: SparkSession, layout: Layout, min_age_hours: float = 0.0) -> DataFrame:
    """``table_name, run, folder, age_hours`` of run folders that nothing refers to.  ``min_age_hours`` leaves out those of
    runs that may still be going on."""
    specs = [("prod", s.name) for s in layout.published()] + [("staging", layout.staging), ("ops", layout.rejects.name)]
    found, known = [], []
    for zone, name in specs:
        table = layout.qualified(zone, name)
        found += [(text(name), text(run), text(folder), f"{age}D") for run, folder, age in run_folders(spark, layout.location(spark, zone, name))]
        if spark.catalog.tableExists(table):
            known += [(text(name), text(run)) for run in sorted(referenced_runs(spark, table))]
    folders = _values(spark, found, ORPHANS).where(F.col("age_hours") >= min_age_hours)
    return folders.join(_values(spark, known, "table_name string, run string"), ["table_name", "run"], "left_anti")


def remove_orphans(spark: SparkSession, layout: Layout, min_age_hours: float = 168.0) -> list[str]:
    """Delete orphaned run folders older than ``min_age_hours`` (a week by default, longer than any run)."""
    folders = [r["folder"] for r in orphan_runs(spark, layout, min_age_hours).collect()]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return folders
