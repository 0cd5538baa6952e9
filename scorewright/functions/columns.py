"""Small expression builders shared by the operators.

Operators render their expressions as Spark SQL text; a whole layer is applied
with one ``selectExpr`` call, i.e. one driver round trip per layer instead of
one per sub-expression, which keeps planning of a ~100-expression scorecard
well under a second.  Identifiers are back-quoted; numbers become double literals.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def num(v) -> str:
    """Double literal (``72.0D``, ``(-0.022072D)``, ``4.646968e-10D``)."""
    s = repr(float(v))
    if s in ("inf", "-inf", "nan"):
        raise ValueError(f"non-finite constant {v!r}")
    return f"({s}D)" if s.startswith("-") else f"{s}D"


def text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value(v) -> str:
    return text(v) if isinstance(v, str) else num(v)


def when_chain(arms: Iterable[tuple[str, str]], otherwise: str | None = None) -> str:
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in arms)
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE {body}{tail} END"


def any_of(conds: Iterable[str]) -> str:
    return " OR ".join(f"({c})" for c in conds)


def flag(cond: str) -> str:
    """1 when ``cond`` is true, 0 when false or null (R ``case_when(cond ~ 1, TRUE ~ 0)``)."""
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def compare(col_sql: str, op: str, v) -> str:
    sql_op = {"<": "<", ">": ">", "==": "=", ">=": ">=", "<=": "<="}[op]
    return f"{col_sql} {sql_op} {num(v)}"


def zero_if_null(name: str) -> str:
    """NaN counts as missing too, as in R's ``coalesce``."""
    return f"coalesce(nanvl(CAST({ident(name)} AS DOUBLE), CAST(NULL AS DOUBLE)), 0.0D)"


def selector_is(selector: str, card_value) -> str:
    return f"{ident(selector)} = {num(card_value)}"


def replace_columns(df: DataFrame, new: dict[str, Column | str],
                    add: dict[str, Column | str] | None = None) -> DataFrame:
    """One ``select`` layer: overwrite ``new`` in place (keeping column order), append ``add``.

    Values are SQL expression text (or Columns).  Every expression reads the
    *previous* layer's values, so a layer never sees a value it overwrites
    itself -- callers split dependent steps into layers.  An ``add`` name that
    already exists is overwritten in place.  An all-text layer is one
    ``selectExpr`` call: a single driver round trip however wide the frame is.
    """
    columns = df.columns
    missing = set(new) - set(columns)
    if missing:
        raise KeyError(f"columns not in frame: {sorted(missing)}")
    merged = {**new, **(add or {})}
    extra = [n for n in (add or {}) if n not in columns]
    if all(isinstance(v, str) for v in merged.values()):
        exprs = [f"{merged[c]} AS {ident(c)}" if c in merged else ident(c) for c in columns]
        return df.selectExpr(*exprs, *[f"{merged[n]} AS {ident(n)}" for n in extra])
    as_col = {k: (F.expr(v) if isinstance(v, str) else v) for k, v in merged.items()}
    cols = [as_col[c].alias(c) if c in as_col else F.col(c) for c in columns]
    return df.select(*cols, *[as_col[n].alias(n) for n in extra])


def round9(c: Column) -> Column:
    """Stable 9-decimal rendering of a double for reports and value-hash comparison."""
    return F.round(c, 9)


def literal_array_sql(values: Iterable[str], sep: str = "~") -> str:
    """A constant string array from one literal (``split`` of a literal folds at planning time)."""
    items = [str(v) for v in values]
    if any(sep in x for x in items):
        raise ValueError(f"separator {sep!r} occurs in a value")
    return f"split({text(sep.join(items))}, {text(sep)})"
