"""K1: knock-out rule on raw values; any firing test -> ``flow_x = 1``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import any_of, flag, num, replace_columns, zero_if_null
from scorewright.spec import KnockoutTest, Scorecard


def knockout_test_sql(t: KnockoutTest) -> str:
    s = " + ".join(zero_if_null(c) for c in t.plus)
    for c in t.minus:
        s += f" - {zero_if_null(c)}"
    return f"{s} >= {num(t.at_least)}"


def knockout_flag_sql(card: Scorecard) -> str:
    return flag(any_of(knockout_test_sql(t) for t in card.knockout))


def knockout(df: DataFrame, card: Scorecard, name: str = "flow_x") -> DataFrame:
    return replace_columns(df, {}, {name: knockout_flag_sql(card)})
