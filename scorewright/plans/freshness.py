"""S12 / P8 / CAL4: freshness gate on the feature table.

``max(fecha_obs)`` rather than an arbitrary ``LIMIT 1`` row; a partition filter
prunes to one archive when given.  Whole days between ``as_of`` and that date must
be below the threshold; an empty table and a date after ``as_of`` count as not fresh.

A :class:`~scorewright.sources.feature_store.FeatureStore` answers from Parquet footers of the pruned partition; any other
DataFrame is scanned for its one column and parsed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.sources.feature_store import FeatureStore


def verdict(last: DataFrame, as_of: dt.date, max_age_days: int) -> DataFrame:
    age = F.datediff(F.lit(as_of), F.col("last_obs"))
    return last.select("last_obs", age.alias("age_days"),
                       F.coalesce((age >= 0) & (age < F.lit(max_age_days)), F.lit(False)).alias("fresh"))


def freshness(features: DataFrame, as_of: dt.date, max_age_days: int = 4, archive: int | None = None,
              column: str = "fecha_obs") -> DataFrame:
    """One row: last observation date, its age in whole days at ``as_of``, and the gate verdict."""
    df = features if archive is None else features.where(F.col("archive") == F.lit(archive))
    return verdict(df.agg(F.max(F.try_to_date(F.col(column), "yyyy-MM-dd")).alias("last_obs")), as_of, max_age_days)


def stored_freshness(spark: SparkSession, store: FeatureStore, as_of: dt.date, max_age_days: int = 4,
                     archive: int | None = None) -> DataFrame:
    """The same row, from footers."""
    return verdict(store.last_observation(spark, archive), as_of, max_age_days)
