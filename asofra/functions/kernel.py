"""Null and guard rules that every operator inherits, as columns and as SQL.

The SQL forms are plain ANSI text: indicator formulas are built from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def guarded(num: Column, den: Column, least: float = EPS) -> Column:
    """num / den, null if either is null or |den| < least."""
    return F.when(F.abs(den) >= least, num / den)


def growth(now: Column, before: Column) -> Column:
    return guarded(now - before, F.abs(before))


def zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    """x within [low, high]; greatest and least skip nulls, so a null stays."""
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))


def log_safe(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def no_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def between(x: Column, bounds: tuple[int, int]) -> Column:
    return x.between(*bounds)


# The same rules as SQL text.


def div(num: str, den: str, least: str = "1e-9") -> str:
    return f"(CASE WHEN abs({den}) >= {least} THEN ({num}) / ({den}) END)"


def grow(now: str, before: str) -> str:
    return div(f"({now}) - ({before})", f"abs({before})")


def z0(x: str) -> str:
    return f"coalesce({x}, 0e0)"


def flag(condition: str) -> str:
    """1 or 0, null if the condition is null."""
    return f"(CASE WHEN {condition} THEN 1e0 WHEN NOT ({condition}) THEN 0e0 END)"


def given(condition: str, then: str) -> str:
    return f"(CASE WHEN {condition} THEN {then} END)"


def known(*names: str) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


def any_known(*names: str) -> str:
    return f"coalesce({', '.join(names)}) IS NOT NULL"


def available(*names: str) -> str:
    """Sum of what is there, null if nothing is."""
    return given(any_known(*names), " + ".join(z0(n) for n in names))
