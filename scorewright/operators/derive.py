"""Derived flags and recodes on capped values (one layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import any_of, compare, flag, ident, num, replace_columns, when_chain
from scorewright.spec import AnyPositiveFlag, CompareFlag, Recode, Scorecard


def derived_sql(d) -> str:
    if isinstance(d, CompareFlag):
        return flag(compare(ident(d.column), d.op, d.value))
    if isinstance(d, AnyPositiveFlag):
        return flag(any_of(f"coalesce({ident(c)}, 0.0D) > 0.0D" for c in d.columns))
    if isinstance(d, Recode):
        c = ident(d.column)
        return when_chain(((f"{c} = {num(frm)}", num(to)) for frm, to in d.mapping),
                          c if d.default is None else num(d.default))
    raise TypeError(f"unknown derived step {d!r}")


def derive(df: DataFrame, card: Scorecard) -> DataFrame:
    return replace_columns(df, {}, {d.name: derived_sql(d) for d in card.derived})
