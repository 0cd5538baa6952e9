"""List partitions (metadata only), keep the newest N, archive then drop the rest.

Archiving is zero-copy, like the published flow's "drop partition, move its folder to the purge
zone": every published snapshot lies in a folder of its own (``<table>/runs/<run>[/archive=<a>]``,
never written again), and a replaced or retired snapshot's folder is registered as partition
``(archive, run)`` of ``<table>_purge``.  The run id is part of the key, so an archive that is
handed over again adds a partition and never collides with an earlier one.  The tables are
external: dropping a partition or pointing it elsewhere keeps its files.  No data is read or written.

What a table consists of is its published version (:mod:`scorewright.plans.versions`): a publish and the retention that
follows it are one version, the purge table and the plain table follow from the difference to the version before, and
folders are known from partition names, without asking the catalog for one partition after the other.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField

from scorewright.functions.columns import ident, text
from scorewright.plans import versions as V

RUN_FOLDER = re.compile(r"/runs/([^/]+)(?:/[^/]+=[^/]*)?/?$")


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def run_of(location: str) -> str | None:
    """Run id of a published folder; None for a folder no run wrote (a table's first, empty one)."""
    m = RUN_FOLDER.search(location)
    return m.group(1) if m else None


def list_partitions(spark: SparkSession, table: str, key: str = "archive") -> list[int]:
    """Partition values, oldest first (catalog metadata; no data is scanned)."""
    return sorted({int(p[key]) for p in V.partition_specs(spark, table)})


def victims(partitions: list[int], keep: int | None) -> list[int]:
    if keep is None:
        return []
    return sorted(partitions)[:-keep] if keep > 0 else sorted(partitions)


def _location(spark: SparkSession, table: str, spec: str = "") -> str:
    rows = (spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").where("col_name = 'Location'")
            .select(F.col("data_type")).collect())
    return rows[0][0]         # of a partition: its own location comes before the table's


def table_location(spark: SparkSession, table: str) -> str:
    return _location(spark, table)


def partition_location(spark: SparkSession, table: str, value: int, key: str = "archive") -> str:
    return _location(spark, table, f"PARTITION ({ident(key)}={int(value)})")


def ensure_purge_table(spark: SparkSession, table: str, purge_table: str) -> str:
    """``table``'s columns, partitioned by ``(archive, run)``."""
    if not spark.catalog.tableExists(purge_table):
        fields = [f for f in spark.table(table).schema.fields if f.name != "archive"]
        fields += [StructField("archive", IntegerType()), StructField("run", StringType())]
        base = V.base_folder(table_location(spark, table))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {purge_table} ({V.ddl(fields)}) USING parquet PARTITIONED BY (archive, run) "
                  f"LOCATION {text(base + '_purge')}")
    return purge_table


def hand_over(spark: SparkSession, purge_table: str, folders: dict[int, list[str]]) -> None:
    """Register the folders of each archive as partitions ``(archive, run)`` of the purge table, in one statement.

    A folder that is there already (a job repeated after it broke off between hand-over and switch) is left as it is.
    """
    there = {(int(p["archive"]), p["run"]) for p in V.partition_specs(spark, purge_table)}
    new = {(int(a), run_of(loc)): loc for a, locations in folders.items() for loc in locations}
    specs = " ".join(f"PARTITION (archive={a}, run={text(run)}) LOCATION {text(loc)}"
                     for (a, run), loc in sorted(new.items()) if (a, run) not in there)
    if specs:
        spark.sql(f"ALTER TABLE {purge_table} ADD {specs}")
        spark.catalog.refreshTable(purge_table)


def published_runs(spark: SparkSession, table: str) -> dict[int, str]:
    """``{archive: run}`` of the published version.  A table that was filled before it had versions is described once."""
    if V.newest(spark, table):
        return V.entries(spark, table)
    return {a: run_of(partition_location(spark, table, a)) for a in list_partitions(spark, table)}


def follow(spark: SparkSession, table: str, before: dict[int, str], after: dict[int, str], base: str) -> None:
    """Take the plain table's partitions from ``before`` to ``after``."""
    gone = [a for a in before if a not in after]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION (archive={a})" for a in sorted(gone)))
    for a in sorted(a for a in after if a in before and before[a] != after[a]):
        spark.sql(f"ALTER TABLE {table} PARTITION (archive={a}) SET LOCATION {text(V.run_folder(base, a, after[a], True))}")
    added = " ".join(f"PARTITION (archive={a}) LOCATION {text(V.run_folder(base, a, run, True))}"
                     for a, run in sorted(after.items()) if a not in before)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD {added}")


def put_in_order(spark: SparkSession, table: str, runs: dict[int, str], base: str) -> None:
    """A plain table that a broken run left behind its version gets that version's partitions, in two statements."""
    now = V.newest(spark, table)
    if V.property_of(spark, table) != now:
        follow(spark, table, dict.fromkeys(list_partitions(spark, table), ""), {}, base)
        follow(spark, table, {}, runs, base)
        V.mark(spark, table, now)


def switch_partitions(spark: SparkSession, table: str, runs: dict[int, str], keep: int | None = None) -> list[int]:
    """Publish the run folders ``runs`` (``{archive: run}``) and keep the newest ``keep`` archives, as one version.

    Replaced and retired folders go to ``<table>_purge`` first, so a job that breaks off here leaves every snapshot in a
    table.  Returns the archives that retention dropped.
    """
    base = V.base_folder(table_location(spark, table))
    before = published_runs(spark, table)
    put_in_order(spark, table, before, base)
    runs = {int(a): run for a, run in runs.items()}
    after = {**before, **runs}
    drop = victims(list(after), keep)
    after = {a: run for a, run in after.items() if a not in set(drop)}
    if after == before and not drop:
        return []
    leaving: dict[int, list[str]] = {}
    for a, run in [*before.items(), *((a, r) for a, r in runs.items() if a in set(drop))]:
        if after.get(a) != run:
            leaving.setdefault(a, []).append(V.run_folder(base, a, run, True))
    if leaving:
        hand_over(spark, ensure_purge_table(spark, table, table + "_purge"), leaving)
    version = V.commit(spark, table, after, base, partitioned=True)
    follow(spark, table, before, after, base)
    V.mark(spark, table, version)
    return drop


def switch_current(spark: SparkSession, table: str, archive: int, run: str) -> None:
    """Point the unpartitioned table at a new run.  The folder it replaces becomes partition ``(archive that replaced it,
    run)`` of ``<table>_purge``."""
    old = table_location(spark, table).rstrip("/")
    base = V.base_folder(old)
    if V.newest(spark, table):                        # the version counts, should the table lag behind it
        old = next((V.run_folder(base, a, r, False) for a, r in V.entries(spark, table).items()), old)
    if run_of(old):
        hand_over(spark, ensure_purge_table(spark, table, table + "_purge"), {archive: [old]})
    version = V.commit(spark, table, {int(archive): run}, base, partitioned=False)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {text(V.run_folder(base, archive, run, False))}")
    V.mark(spark, table, version)


def retain(spark: SparkSession, table: str, keep: int | None) -> list[int]:
    """Keep the newest ``keep`` partitions; hand the others' folders to ``<table>_purge`` (zero-copy) and drop them.
    Returns the dropped partition values."""
    return switch_partitions(spark, table, {}, keep)
