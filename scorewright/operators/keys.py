"""J1 (compat self-join) and J1u (key uniqueness check)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.operators.score import RESULTS, score_append
from scorewright.session import scratch_path
from scorewright.spec import Scorecard


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once (nulls group together), with their count.

    A partial count per task then one shuffle on the keys; a hot key costs one
    counter per task, never a collected group.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def _null_safe(keys: Sequence[str], prefix: str):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once in the shared folder and read back: computed once, and of a size Catalyst knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def score_join_compat(df: DataFrame, card: Scorecard, auto_units: bool = False,
                      check_unique: bool = True) -> DataFrame:
    """Exact replay of the published form: raw rows LEFT JOIN their scores on the keys,
    null-safe (``<=>``), so a key tuple repeated *k* times yields *k*^2 rows.

    Every row is scored once and stored with its results; whatever follows reads those.  A row whose key is unique
    matches its own score only, so it needs no join.  With ``check_unique`` (default) the repeated key tuples are
    found first (a partial count per task, then a shuffle of key tuples only); without it every key counts as repeated.
    The right side holds one entry per repeated key: its distinct results with their counts, at most one per
    possible score however often the key occurs.  Every stored row looks its entry
    up; the *k*^2 rows first exist in the output, where the counts are spread out again.  No side is
    forced to be broadcast: both tables are stored, so Catalyst decides by their size in bytes,
    and where it shuffles them AQE splits the left rows of a hot key.
    """
    keys = list(card.keys)
    scored = _stored(score_append(df, card, auto_units=auto_units), "scored")
    right = scored.select(*keys, *RESULTS)
    if check_unique:
        repeated = _stored(duplicate_keys(right, keys).select(*[F.col(k).alias(f"__d_{k}") for k in keys]), "repeated-keys")
        right = right.join(repeated, _null_safe(keys, "__d_"), "left_semi")
    entries = _stored(right.groupBy(*keys, *RESULTS).agg(F.count(F.lit(1)).alias("__n"))
                      .groupBy(*[F.col(k).alias(f"__r_{k}") for k in keys])
                      .agg(F.collect_list(F.struct(*RESULTS, "__n")).alias("__entries")), "key-results")
    matched = (scored.join(entries, _null_safe(keys, "__r_"), "left")
               .withColumn("__e", F.explode_outer("__entries"))
               .withColumn("__i", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.coalesce("__e.__n", F.lit(1).cast("long"))))))
    single = F.col("__entries").isNull()
    return matched.select(*df.columns, *[F.when(single, F.col(r)).otherwise(F.col(f"__e.{r}")).alias(r) for r in RESULTS])
