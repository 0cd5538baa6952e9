"""Weight lookup by (selector, key) as a join against a small table.

The published model writes the district weights as one 483-arm CASE.  A CASE
that long compiles to a single generated method far over the JIT's size limit,
so it is modelled as data and joined.  The table is a fixed resource (483 rows),
so its size is known before planning: it is broadcast when it is under
``MAX_BROADCAST_ROWS`` and shuffled with a sort-merge join otherwise.  Keys are
checked unique, so the left join never multiplies rows.
"""

from __future__ import annotations

import csv
from functools import lru_cache
from importlib import resources
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.functions.columns import num, replace_columns, selector_is, text, when_chain
from scorewright.spec import Lookup, Scorecard

MAX_BROADCAST_ROWS = 200_000


@lru_cache(maxsize=None)
def lookup_rows(resource: str, key: str) -> tuple[tuple[float, str, float], ...]:
    text = resources.files("scorewright.data").joinpath(resource).read_text(encoding="utf-8")
    reader = csv.DictReader(line for line in text.splitlines() if not line.startswith("#"))
    rows = tuple((float(r["scorecard"]), r[key], float(r["weight"])) for r in reader)
    seen = set()
    for sc, k, _ in rows:
        if (sc, k) in seen:
            raise ValueError(f"{resource}: repeated key ({sc}, {k!r})")
        seen.add((sc, k))
    return rows


_TABLES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def lookup_table(spark: SparkSession, lk: Lookup) -> DataFrame:
    """The lookup rows as a small DataFrame, built once per session."""
    tables = _TABLES.setdefault(spark, {})
    if (lk.table, lk.key) not in tables:
        tables[lk.table, lk.key] = _build_table(spark, lk)
    return tables[lk.table, lk.key]


def _build_table(spark: SparkSession, lk: Lookup) -> DataFrame:
    # A literal VALUES relation lives in the JVM (LocalTableScan): broadcasting it needs no job and
    # no Python worker, unlike a DataFrame created from a Python list (a Python RDD scan).
    values = ", ".join(f"({num(sc)}, {text(k)}, {num(w)})" for sc, k, w in lookup_rows(lk.table, lk.key))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(__lk_sc, __lk_key, __lk_w)")


def lookup_default_sql(card: Scorecard, lk: Lookup) -> str:
    return when_chain((selector_is(card.selector, sc), num(w)) for sc, w in lk.default_per_scorecard)


def lookup(df: DataFrame, card: Scorecard) -> DataFrame:
    spark = df.sparkSession
    for lk in card.lookups:
        table = lookup_table(spark, lk)
        if len(lookup_rows(lk.table, lk.key)) <= MAX_BROADCAST_ROWS:
            table = F.broadcast(table)
        cond = (F.col(card.selector) == F.col("__lk_sc")) & (F.col(lk.key) == F.col("__lk_key"))
        joined = df.join(table, cond, "left")
        weight = f"coalesce(__lk_w, {lookup_default_sql(card, lk)})"
        df = replace_columns(joined, {}, {lk.name: weight}).drop("__lk_sc", "__lk_key", "__lk_w")
    return df
