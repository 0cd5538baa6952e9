"""Age of the last consult in seconds (T1 flag computed in the same layer).

``seconds`` is the default unit.  ``auto_units=True`` replays the batch-dependent
unit of R's date subtraction: the smallest absolute non-null difference over the
*whole batch* picks secs (<60 s), mins (<1 h), hours (<1 day) or days.  That is
one global ``min`` aggregate (a partial per task + one-row final), a scalar subquery of the
same plan -- no join, and no job before the result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.functions.columns import flag, ident, num, replace_columns, text
from scorewright.spec import InSetFlag, Scorecard, SecondsBetween


def parse_date_sql(column: str, fmt: str) -> str:
    # Wall-clock timestamps without a zone, so the difference never depends on the session time
    # zone (no daylight-saving hour).  The ISO form goes through Spark's native parser (TRY_CAST:
    # fast, null on bad text, and like R it also takes "yyyy-MM-dd HH:mm:ss").
    if fmt == "yyyy-MM-dd":
        # a cast also takes "2019" and "2019-05": only full dates count
        return f"CASE WHEN {ident(column)} RLIKE '^ *[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}' THEN TRY_CAST({ident(column)} AS TIMESTAMP_NTZ) END"
    return f"try_to_timestamp({ident(column)}, {text(fmt)})::TIMESTAMP_NTZ"


def raw_seconds_sql(spec: SecondsBetween) -> str:
    return (f"CAST(timestampdiff(SECOND, {parse_date_sql(spec.start, spec.fmt)}, "
            f"{parse_date_sql(spec.end, spec.fmt)}) AS DOUBLE)")


def batch_unit_seconds(df: DataFrame, spec: SecondsBetween) -> Column:
    """Divisor R's ``difftime(units='auto')`` would pick for this batch: a scalar subquery."""
    smallest = df.agg(F.expr(f"min(abs({raw_seconds_sql(spec)}))").alias("m"))
    unit = "CASE WHEN m < 60 OR m IS NULL THEN 1.0D WHEN m < 3600 THEN 60.0D WHEN m < 86400 THEN 3600.0D ELSE 86400.0D END"
    return smallest.select(F.expr(unit).alias("unit")).scalar()


def in_set_flag_sql(f: InSetFlag) -> str:
    return flag(f"coalesce({ident(f.column)}, {text(f.null_as)}) IN ({', '.join(text(v) for v in f.values)})")


def consult_age(df: DataFrame, card: Scorecard, auto_units: bool = False) -> DataFrame:
    spec = card.consult_age
    seconds, missing = raw_seconds_sql(spec), f"{ident(spec.start)} IS NULL"
    add: dict[str, str | Column] = {f.name: in_set_flag_sql(f) for f in card.flags_before_impute}
    if auto_units:
        add[spec.name] = F.when(F.expr(missing), F.lit(float(spec.missing))).otherwise(F.expr(seconds) / batch_unit_seconds(df, spec))
    else:
        add[spec.name] = f"CASE WHEN {missing} THEN {num(spec.missing)} ELSE {seconds} END"
    return replace_columns(df, {}, add)
