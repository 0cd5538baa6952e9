"""Logistic points, affine rescale, clamp, knock-out override; B1: band letter."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.columns import ident, literal_array_sql, num, replace_columns, text
from scorewright.spec import Scorecard


def points_sql(card: Scorecard, logodds: str = "logodds") -> str:
    """G1 + G2: ``rint(slope * rint(1 / (1 + exp(x)) * points) + offset)``; ``rint`` rounds
    halves to even like R's ``round`` (Spark's ``round`` rounds halves up)."""
    s = card.scaling
    g1 = f"rint(1.0D / (1.0D + exp({ident(logodds)})) * {num(s.points)})"
    return f"rint({num(s.slope)} * {g1} + {num(s.offset)})"


def scale(df: DataFrame, card: Scorecard, name: str = "score_pos", knocked: str = "flow_x") -> DataFrame:
    s = card.scaling
    df = replace_columns(df, {}, {name: points_sql(card)})
    c = ident(name)
    df = replace_columns(df, {name: f"CASE WHEN {c} > {num(s.hi)} THEN {num(s.hi)} "
                                    f"WHEN {c} < {num(s.lo)} THEN {num(s.lo)} ELSE {c} END"})
    return replace_columns(df, {name: f"CAST(CASE WHEN {ident(knocked)} = 1 THEN {int(s.knockout_score)} "
                                      f"ELSE {c} END AS INT)"})


def band_letter(card: Scorecard, score: int):
    """Band of one integer score: ``above < score <= up_to``; the knock-out score -> knock-out band."""
    if score == card.scaling.knockout_score:
        return card.knockout_band
    for b in card.bands:
        if b.above < score <= b.up_to:
            return b.letter
    return None


def band_table(card: Scorecard) -> tuple[int, list]:
    """Letters for every integer score from the lowest possible (knock-out or ``lo``) to ``hi``,
    built from the band rule.  Returns (first score, letters)."""
    first = int(min(card.scaling.knockout_score, card.scaling.lo))
    return first, [band_letter(card, s) for s in range(first, int(card.scaling.hi) + 1)]


def band_sql(card: Scorecard, score: str = "score_pos") -> str:
    """One array lookup by integer score.  A CASE chain would read the score 28 times, and a
    filter on the band pushed below the scoring projections would inline the whole score
    computation that often; the lookup reads it twice.  Out-of-range or null score -> null."""
    first, letters = band_table(card)
    table = literal_array_sql("" if x is None else x for x in letters)
    idx = f"{ident(score)} - {first - 1}"
    # element_at counts negative indexes from the end and rejects 0: below-range -> null index
    return f"nullif(try_element_at({table}, IF({idx} > 0, {idx}, NULL)), {text('')})"


def band(df: DataFrame, card: Scorecard, name: str = "flow_pos") -> DataFrame:
    return replace_columns(df, {}, {name: band_sql(card)})
