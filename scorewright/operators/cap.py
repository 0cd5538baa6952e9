"""Ordered cap arms, first match wins (some arms only for one scorecard)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import compare, ident, num, replace_columns, selector_is, when_chain
from scorewright.spec import Cap, Scorecard


def cap_sql(cap: Cap, selector: str) -> str:
    c = ident(cap.column)
    arms = []
    for arm in cap.arms:
        cond = compare(c, arm.op, arm.bound)
        if arm.scorecard is not None:
            cond = f"{selector_is(selector, arm.scorecard)} AND {cond}"
        arms.append((cond, num(arm.value)))
    return when_chain(arms, c)


def cap(df: DataFrame, card: Scorecard) -> DataFrame:
    return replace_columns(df, {k.column: cap_sql(k, card.selector) for k in card.caps})
