"""A stored feature table that answers "how fresh is it" from file footers.

The feature columns are kept as they are, beside the parsed observation date as a DATE column, partitioned by archive where
rows carry one.  ``max`` of a DATE column is answered by Spark's Parquet source from footer statistics (strings are not: their
statistics may be cut), and a filter on the partition column leaves one folder to look at.  The probe runs in a session of
its own, since that reader has to be chosen by settings.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBS_DATE = "obs_date"
#: The Parquet reader that pushes aggregates down, and the pushdown itself.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@dataclass(frozen=True)
class FeatureStore:
    path: str
    column: str = "fecha_obs"

    def write(self, features: DataFrame) -> "FeatureStore":
        """Replace the table.  Rows with an ``archive`` are partitioned by it; ``rebalance`` splits a hot archive over tasks."""
        rows = features.withColumn(OBS_DATE, F.try_to_date(F.col(self.column), "yyyy-MM-dd"))
        if "archive" in features.columns:
            rows.hint("rebalance", "archive").write.mode("overwrite").partitionBy("archive").parquet(self.path)
        else:
            rows.write.mode("overwrite").parquet(self.path)
        return self

    def read(self, spark: SparkSession, archive: int | None = None) -> DataFrame:
        """The feature columns; of one archive, its partition alone."""
        rows = spark.read.parquet(self.path)
        if archive is not None:
            rows = rows.where(F.col("archive") == F.lit(archive))
        return rows.drop(OBS_DATE)

    def last_observation(self, spark: SparkSession, archive: int | None = None) -> DataFrame:
        """One row ``last_obs``: the latest observation date, null for no rows.  A table without the DATE column (written by
        others) is scanned and parsed."""
        probe = spark.newSession()
        for k, v in FOOTER_CONF.items():
            probe.conf.set(k, v)
        rows = probe.read.parquet(self.path)
        if OBS_DATE not in rows.columns:
            rows = spark.read.parquet(self.path).withColumn(OBS_DATE, F.try_to_date(F.col(self.column), "yyyy-MM-dd"))
        if archive is not None:
            rows = rows.where(F.col("archive") == F.lit(archive))
        return rows.agg(F.max(OBS_DATE).alias("last_obs"))

    def last_date(self, spark: SparkSession, archive: int | None = None) -> dt.date | None:
        return self.last_observation(spark, archive).first()["last_obs"]
