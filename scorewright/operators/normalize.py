"""Type preparation (numeric inputs -> double), sentinels -> null (N1), text -> number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.functions.columns import ident, replace_columns, text
from scorewright.spec import Scorecard


# Spark's cast also takes a type suffix ("12d", "12f"); as.numeric does not.
NUMBER = "(?i)^ *([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|nan|[+-]?inf(inity)?) *$"


def numeric_inputs(card: Scorecard, columns: list[str]) -> list[str]:
    keys, txt = set(card.keys), set(card.text_columns)
    return [c for c in dict.fromkeys((*card.knockout_inputs, *card.inputs))
            if c in columns and c not in keys and c not in txt]


def cast_numeric(df: DataFrame, card: Scorecard) -> DataFrame:
    """All numeric features become double before any arithmetic (the model computes in doubles)."""
    return replace_columns(df, {c: f"CAST({ident(c)} AS DOUBLE)" for c in numeric_inputs(card, df.columns)})


def normalize_sql(card: Scorecard) -> dict[str, str]:
    new: dict[str, str] = {}
    for s in card.sentinels:
        new[s.column] = f"nullif({new.get(s.column, ident(s.column))}, {text(s.value)})"
    for c in card.numeric_text:
        source = new.get(c, ident(c))
        new[c] = f"CASE WHEN {source} RLIKE {text(NUMBER)} THEN TRY_CAST({source} AS DOUBLE) END"
    return new


def normalize(df: DataFrame, card: Scorecard) -> DataFrame:
    """``na_if(c, sentinel)`` then, for numeric text, ``try_cast(c as double)`` (bad text -> null).

    Plain ``cast`` would raise under ANSI mode; ``try_cast`` is the R ``as.numeric`` behaviour.
    """
    return replace_columns(df, normalize_sql(card))


def reject_counts(card: Scorecard) -> dict[str, Column]:
    """Per text column the model parses, an aggregate: rows whose text is neither missing nor a sentinel, yet no number or
    date.  Such rows are scored as if the value were missing."""
    from scorewright.operators.consult_age import parse_date_sql
    sentinel = {s.column: s.value for s in card.sentinels}
    age = card.consult_age
    parsed = {c: normalize_sql(card)[c] for c in card.numeric_text}
    parsed.update({c: parse_date_sql(c, age.fmt) for c in (age.start, age.end)})
    counts = {}
    for c, value in parsed.items():
        given = f"nullif({ident(c)}, {text(sentinel[c])})" if c in sentinel else ident(c)
        counts[c] = F.expr(f"count_if({given} IS NOT NULL AND ({value}) IS NULL)")
    return counts


def rejects(df: DataFrame, card: Scorecard) -> DataFrame:
    """One aggregate (a counter per task and column), unpivoted into ``(column, rejected_rows)``."""
    counts = reject_counts(card)
    return df.agg(*[n.alias(c) for c, n in counts.items()]).unpivot([], list(counts), "column", "rejected_rows")
