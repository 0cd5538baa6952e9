"""Deterministic keyed token of a string under a named domain (built-ins only).

``sha2(key | domain | value, 256)`` as lower-case hex.  Equal inputs give equal
tokens, so tokenized ids stay joinable across tables and runs; the token is not
reversible and not format preserving.  ``key`` is a deployment secret: it enters a plan as
a scalar subquery over a one-row relation, so neither plans nor event logs show it.  Null
stays null (``concat`` with a null is null).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def secret(spark: SparkSession, key: str) -> Column:
    return spark.createDataFrame([(key,)], "secret string").scalar()


def token(column: str, domain: str, key: Column, passes: int = 1) -> Column:
    """``passes`` times the token of ``column``; ``key`` from :func:`secret`."""
    out = F.col(column)
    for _ in range(passes):
        out = F.sha2(F.concat(key, F.lit(f"|{domain}|"), out), 256)
    return out
