"""The whole scorecard as one chain of narrow layers.

    cast -> knock-out -> sentinels/parse -> consult age + band flag
         -> selector -> imputations -> caps -> derived -> lookup (broadcast)
         -> linear -> scale -> band

Each step is one ``selectExpr`` layer; Catalyst collapses cheap adjacent
projections and keeps the expensive ones (read many times downstream) as
separate projections of the same stage.  No step shuffles; the only exchange is
the broadcast of the size-checked lookup table.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.operators.cap import cap
from scorewright.operators.consult_age import consult_age
from scorewright.operators.derive import derive
from scorewright.operators.impute import impute
from scorewright.operators.knockout import knockout
from scorewright.operators.linear import linear
from scorewright.operators.lookup import lookup
from scorewright.operators.normalize import cast_numeric, normalize
from scorewright.operators.scale import band, scale
from scorewright.spec import Scorecard

RESULTS = ("score_pos", "flow_pos")


def source_projection(df: DataFrame, card: Scorecard) -> DataFrame:
    """Exactly the columns the model reads, in source order (column pruning at the scan)."""
    return df.select(*card.source_columns())


def working_frame(df: DataFrame, card: Scorecard, auto_units: bool = False,
                  upto: str = "band") -> DataFrame:
    """All working columns after the named step (imputed / capped values overwrite the inputs)."""
    steps = [
        ("cast", lambda d: cast_numeric(d, card)),
        ("knockout", lambda d: knockout(d, card)),
        ("normalize", lambda d: normalize(d, card)),
        ("consult_age", lambda d: consult_age(d, card, auto_units=auto_units)),
        ("impute", lambda d: impute(d, card)),
        ("cap", lambda d: cap(d, card)),
        ("derive", lambda d: derive(d, card)),
        ("lookup", lambda d: lookup(d, card)),
        ("linear", lambda d: linear(d, card)),
        ("scale", lambda d: scale(d, card)),
        ("band", lambda d: band(d, card)),
    ]
    names = [n for n, _ in steps]
    if upto not in names:
        raise ValueError(f"unknown step {upto!r}; one of {names}")
    for n, f in steps:
        df = f(df)
        if n == upto:
            break
    return df


def score(df: DataFrame, card: Scorecard, keys: Optional[Sequence[str]] = None,
          auto_units: bool = False) -> DataFrame:
    """``keys`` given -> keys + score_pos + flow_pos (P3); else every working column."""
    out = working_frame(source_projection(df, card), card, auto_units=auto_units)
    if keys is not None:
        return out.select(*keys, *RESULTS)
    return out


def score_append(df: DataFrame, card: Scorecard, auto_units: bool = False) -> DataFrame:
    """Raw columns of ``df`` with score_pos and flow_pos appended -- the no-join form of the
    published "left join raw rows to their scores on the keys".  Identical to it whenever the
    keys are unique (see :func:`scorewright.operators.keys.duplicate_keys`), with no shuffle.

    The raw values ride along in one struct column while the working copies are
    overwritten; Catalyst resolves the struct fields back to the scanned columns.
    """
    raw_cols = df.columns
    packed = df.select(F.struct(*[F.col(c) for c in raw_cols]).alias("__raw"), *raw_cols)
    scored = working_frame(packed, card, auto_units=auto_units)
    return scored.select(*[F.col("__raw").getField(c).alias(c) for c in raw_cols], *RESULTS)
