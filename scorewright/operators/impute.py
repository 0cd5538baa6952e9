"""Null -> constant, possibly depending on the selector (imputed first, its own layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import ident, num, replace_columns, selector_is, value, when_chain
from scorewright.spec import Impute, Scorecard


def missing_as_null(column: str, numeric: bool) -> str:
    """R's ``coalesce`` treats NaN as missing too (``is.na(NaN)`` is TRUE); Spark's only null."""
    return f"nanvl({ident(column)}, CAST(NULL AS DOUBLE))" if numeric else ident(column)


def impute_selector(df: DataFrame, card: Scorecard) -> DataFrame:
    sel = missing_as_null(card.selector, True)
    return replace_columns(df, {card.selector: f"coalesce({sel}, {num(card.selector_default)})"})


def impute_sql(i: Impute, selector: str) -> str:
    fill = value(i.value)
    if i.per_scorecard:
        fill = when_chain(((selector_is(selector, k), value(v)) for k, v in i.per_scorecard), fill)
    return f"coalesce({missing_as_null(i.column, not isinstance(i.value, str))}, {fill})"


def impute(df: DataFrame, card: Scorecard) -> DataFrame:
    """Both layers: selector, then every other imputation reading the imputed selector."""
    df = impute_selector(df, card)
    return replace_columns(df, {i.column: impute_sql(i, card.selector) for i in card.imputes})
