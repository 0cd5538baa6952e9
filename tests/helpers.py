"""Build one-row feature frames for edge cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewright.plans.layout import SOURCE, schema

SOURCE_SCHEMA = schema(SOURCE)


def rows(spark: SparkSession, *overrides: dict) -> DataFrame:
    """One row per dict; unspecified features are null.  ``id`` goes into ``infocheck_id``."""
    data = []
    for i, o in enumerate(overrides):
        base = {c: None for c in SOURCE}
        base["infocheck_id"] = str(o.pop("id", i))
        base.update(o)
        data.append(tuple(base[c] for c in SOURCE))
    return spark.createDataFrame(data, SOURCE_SCHEMA)


def by_id(df: DataFrame) -> dict:
    return {r["infocheck_id"]: r.asDict() for r in df.collect()}
