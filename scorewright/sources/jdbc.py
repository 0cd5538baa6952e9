"""Feature table outside the lake, read over JDBC in parallel slices.

Only needed when the features are not already a lake table (then use ``spark.table``).  Only the model's columns are
selected (pushed into the remote query), and the read is cut into slices of about equally many rows: the bounds are
quantiles of the slicing column, taken from rows that are in the lake already (last week's staging table, say), so a column
whose values crowd together does not leave one executor with most of the table, as even ranges would.  Each slice is
a predicate of its own; the first also takes values below every bound and nulls, the last those above.

No database may run here, so the read itself is untested: tests hold the generated query, predicates and options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.spec import Scorecard


def quote(name: str) -> str:
    """A column name as ANSI SQL quotes it."""
    return '"' + name.replace('"', '""') + '"'


def equi_depth_bounds(known: DataFrame, column: str, slices: int, accuracy: int = 10_000) -> list[int]:
    """Up to ``slices - 1`` rising bounds that cut the rows of ``known`` into about equal slices: one aggregate with a
    mergeable quantile sketch.  Frequent values make fewer bounds: equal values are never cut apart."""
    if slices < 2:
        return []
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    got = known.agg(F.percentile_approx(F.col(column).cast("long"), shares, accuracy).alias("q")).first()["q"]
    return sorted(set(got or []))


def slice_predicates(column: str, bounds: list[int]) -> list[str]:
    """One condition a slice; every row, nulls included, meets exactly one."""
    c = quote(column)
    if not bounds:
        return ["1 = 1"]
    edges = sorted(set(int(b) for b in bounds))
    return ([f"({c} < {edges[0]} OR {c} IS NULL)"] + [f"({c} >= {lo} AND {c} < {hi})" for lo, hi in zip(edges, edges[1:])]
            + [f"{c} >= {edges[-1]}"])


def feature_query(table: str, card: Scorecard, slice_column: str) -> str:
    cols = ", ".join(quote(c) for c in dict.fromkeys((*card.source_columns(), slice_column)))
    return f"(SELECT {cols} FROM {table}) features"


def read_features_jdbc(spark: SparkSession, url: str, table: str, card: Scorecard, slice_column: str, bounds: list[int],
                       properties: dict[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """The model's columns of ``table``, one task a slice."""
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    rows = spark.read.jdbc(url, feature_query(table, card, slice_column), predicates=slice_predicates(slice_column, bounds), properties=options)
    return rows.select(*card.source_columns())
