"""CAL5: run ledger -- which archive was published to which table, with row counts.

Replaces a marker file: the job skips an archive whose ``job`` entry exists, and
``pending`` finds archives not yet run with a left anti join (no collect).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from scorewright.functions.columns import text

LEDGER_SCHEMA = StructType([StructField("archive", IntegerType(), False),
                            StructField("table_name", StringType(), False),
                            StructField("rows", LongType(), True),
                            StructField("run_ts", TimestampType(), False)])


def ensure_ledger(spark: SparkSession, table: str, location: str) -> str:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (archive INT, table_name STRING, rows BIGINT, "
              f"run_ts TIMESTAMP) USING parquet LOCATION {text(location)}")
    return table


def record(spark: SparkSession, table: str, runs: dict[int, dict[str, int | None]], run_ts: datetime | None = None) -> None:
    """Entries of each archive of ``runs``, in one insert."""
    ts = (run_ts or datetime.now(timezone.utc).replace(tzinfo=None)).strftime("%Y-%m-%d %H:%M:%S")
    # a literal VALUES relation: no Python-side DataFrame, no Python worker
    values = ", ".join(f"({int(archive)}, {text(name)}, {'NULL' if n is None else int(n)}, TIMESTAMP '{ts}')"
                       for archive, entries in runs.items() for name, n in entries.items())
    if values:
        spark.sql(f"INSERT INTO {table} SELECT * FROM VALUES {values} AS t(archive, table_name, rows, run_ts)")


def is_done(spark: SparkSession, table: str, archive: int, step: str = "job") -> bool:
    return spark.table(table).where((F.col("archive") == archive) & (F.col("table_name") == step)) \
        .limit(1).count() > 0


def done(ledger: DataFrame, step: str = "job") -> DataFrame:
    return ledger.where(F.col("table_name") == step).select("archive").distinct()


def pending(candidates: DataFrame, ledger: DataFrame, step: str = "job") -> DataFrame:
    """Archives in ``candidates`` (column ``archive``) without a ``step`` entry in the ledger."""
    return candidates.select("archive").distinct().join(done(ledger, step), "archive", "left_anti")
