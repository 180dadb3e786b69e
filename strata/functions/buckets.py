"""CASE bucketing."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_MISSING = object()


def bucket(cases: list[tuple[Column, Any]], otherwise: Any = _MISSING) -> Column:
    """``CASE WHEN c1 THEN v1 ... [ELSE otherwise] END``.

    Without ``otherwise`` an unmatched row (including a NULL input, for which
    every comparison is NULL) gets NULL; with it, NULL inputs fall into the
    ELSE branch.
    """
    if not cases:
        raise ValueError("bucket needs at least one case")
    expr = None
    for cond, value in cases:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if otherwise is not _MISSING:
        expr = expr.otherwise(F.lit(otherwise))
    return expr


def climate_zone(avg: Column, cold_below: float, warm_above: float, with_else: bool = False) -> Column:
    """Three-way climate class: ``< cold`` cold, ``BETWEEN`` temperate, ``> warm`` warm.

    ``with_else=True`` replaces the last test by ELSE, so NULL averages are
    classed as warm (the view variant); otherwise they stay NULL.
    """
    cases = [
        (avg < cold_below, "Cold"),
        (avg.between(cold_below, warm_above), "Temperate"),
    ]
    if with_else:
        return bucket(cases, otherwise="Warm")
    return bucket(cases + [(avg > warm_above, "Warm")])
