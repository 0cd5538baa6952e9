"""L1: linear predictor per scorecard; a selector without a model -> null."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import ident, num, replace_columns, selector_is, when_chain
from scorewright.spec import LinearModel, Scorecard


def linear_sql(m: LinearModel) -> str:
    # Left-associative sum in the listed order: double addition is not associative.
    return " + ".join([num(m.intercept), *(f"{num(t.weight)} * {ident(t.column)}" for t in m.terms)])


def logodds_sql(card: Scorecard) -> str:
    return when_chain((selector_is(card.selector, m.scorecard), linear_sql(m)) for m in card.models)


def linear(df: DataFrame, card: Scorecard, name: str = "logodds") -> DataFrame:
    return replace_columns(df, {}, {name: logodds_sql(card)})
