"""Scorecard specification: every step of a points scorecard as frozen data.

The compiler in :mod:`scorewright.operators.score` turns a :class:`Scorecard`
into Catalyst expressions; nothing here touches Spark.  The step order is
fixed and mirrors the published model:

    knock-out (raw values) -> sentinels / text-to-number -> date age and
    band flag -> selector imputation -> imputations -> caps -> derived flags
    and lookups -> linear predictor per scorecard -> logistic scaling ->
    knock-out override -> band letter.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Optional, Union

Value = Union[int, float, str]


@dataclass(frozen=True)
class KnockoutTest:
    """Fires when ``sum(plus) - sum(minus) >= at_least``; every input is read as ``coalesce(x, 0)``."""
    plus: tuple[str, ...]
    at_least: float
    minus: tuple[str, ...] = ()


@dataclass(frozen=True)
class Sentinel:
    """A text value that means "missing" (``na_if``)."""
    column: str
    value: str


@dataclass(frozen=True)
class Impute:
    """Null -> ``value``; with ``per_scorecard`` the value depends on the (already imputed) selector."""
    column: str
    value: Value
    per_scorecard: tuple[tuple[int, Value], ...] = ()


@dataclass(frozen=True)
class CapArm:
    """One arm of a cap: when ``column <op> bound`` (and the selector equals ``scorecard``) -> ``value``."""
    op: str                      # "<" or ">"
    bound: float
    value: float
    scorecard: Optional[int] = None


@dataclass(frozen=True)
class Cap:
    """Ordered arms, first match wins; no match keeps the value."""
    column: str
    arms: tuple[CapArm, ...]


@dataclass(frozen=True)
class InSetFlag:
    """1 when ``coalesce(column, null_as)`` is one of ``values``, else 0."""
    name: str
    column: str
    values: tuple[str, ...]
    null_as: str = ""


@dataclass(frozen=True)
class AnyPositiveFlag:
    """1 when any ``coalesce(c, 0) > 0``, else 0."""
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class CompareFlag:
    """1 when ``column <op> value`` holds, else 0 (null compares false)."""
    name: str
    column: str
    op: str                      # "==" or ">"
    value: float


@dataclass(frozen=True)
class Recode:
    """``mapping`` by equality, first match wins; otherwise ``default`` (None keeps the column value)."""
    name: str
    column: str
    mapping: tuple[tuple[float, float], ...]
    default: Optional[float] = None


@dataclass(frozen=True)
class Lookup:
    """Weight looked up by (selector, key) in a small table; unmatched -> per-scorecard default;
    a selector with no default (e.g. scorecard 2) -> null."""
    name: str
    key: str
    table: str                   # resource name under scorewright/data, columns scorecard,<key>,weight
    default_per_scorecard: tuple[tuple[int, float], ...]


@dataclass(frozen=True)
class SecondsBetween:
    """``end - start`` of two ``yyyy-MM-dd`` texts, in seconds (or a batch-chosen unit when
    ``auto_units``); ``missing`` when ``start`` is null."""
    name: str
    end: str
    start: str
    missing: float
    fmt: str = "yyyy-MM-dd"


@dataclass(frozen=True)
class Term:
    column: str
    weight: float


@dataclass(frozen=True)
class LinearModel:
    """``intercept + sum(weight * column)``, added in the listed order (double addition order)."""
    scorecard: int
    intercept: float
    terms: tuple[Term, ...]


@dataclass(frozen=True)
class Scaling:
    """``s = rint(points / (1 + exp(logodds)))``, ``s = rint(slope * s + offset)``, clamp to
    ``[lo, hi]``, knock-out -> ``knockout_score``.  ``rint`` rounds halves to even."""
    points: float
    slope: float
    offset: float
    lo: float
    hi: float
    knockout_score: int


@dataclass(frozen=True)
class Band:
    """``above < score <= up_to`` -> ``letter``."""
    letter: str
    above: float
    up_to: float


@dataclass(frozen=True)
class Scorecard:
    name: str
    keys: tuple[str, ...]
    knockout_inputs: tuple[str, ...]
    inputs: tuple[str, ...]                  # model inputs in source order (may repeat knock-out inputs)
    text_columns: tuple[str, ...]            # inputs that stay text; all other inputs are cast to double
    knockout: tuple[KnockoutTest, ...]
    sentinels: tuple[Sentinel, ...]
    numeric_text: tuple[str, ...]            # text inputs parsed as numbers after the sentinels
    consult_age: SecondsBetween
    selector: str
    selector_default: int
    imputes: tuple[Impute, ...]
    caps: tuple[Cap, ...]
    flags_before_impute: tuple[InSetFlag, ...]
    derived: tuple[Union[AnyPositiveFlag, CompareFlag, Recode], ...]
    lookups: tuple[Lookup, ...]
    models: tuple[LinearModel, ...]
    scaling: Scaling
    bands: tuple[Band, ...]
    knockout_band: str
    personal_inputs: tuple[str, ...] = field(default=())

    def source_columns(self) -> list[str]:
        """Ordered union of keys, knock-out inputs and model inputs without repeats."""
        return list(dict.fromkeys((*self.keys, *self.knockout_inputs, *self.inputs)))

    def without_terms(self, *columns: str) -> "Scorecard":
        """Switch inputs off: drop their terms from every linear model (e.g. personal data)."""
        drop = set(columns)
        models = tuple(replace(m, terms=tuple(t for t in m.terms if t.column not in drop))
                       for m in self.models)
        return replace(self, models=models)

    def with_caps(self, *caps: Cap) -> "Scorecard":
        """Replace the caps of the named columns (e.g. the corrected marital-status floor)."""
        by_col = {c.column: c for c in caps}
        return replace(self, caps=tuple(by_col.get(c.column, c) for c in self.caps))
