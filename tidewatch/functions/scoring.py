"""Score math: piecewise normalisation, weighted sum, severity bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ALERT_LEVELS, SEVERITY_BOUNDS, SEVERITY_LABELS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def piecewise(c, lower: float, mid: float, upper: float) -> Column:
    """<= lower -> 0; lower..mid -> 0..0.5; mid..upper -> 0.5..1; >= upper -> 1.

    NULL stays NULL. NaN compares above every number in Spark, so it lands on 1.0.
    """
    x = _c(c).cast("double")
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(x <= lower, F.lit(0.0))
            .when(x < mid, 0.5 * (x - lower) / float(mid - lower))
            .when(x < upper, 0.5 + 0.5 * (x - mid) / float(upper - mid))
            .otherwise(F.lit(1.0)))


def weighted_sum(weights: dict[str, float], cols: dict[str, Column] | None = None) -> Column:
    """sum(weight * column) over the named columns."""
    cols = cols or {}
    terms = [cols.get(k, F.col(k)) * F.lit(float(w)) for k, w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def severity(c, bounds=SEVERITY_BOUNDS, labels=SEVERITY_LABELS, closed: str = "left") -> Column:
    """Three-band label. ``closed='left'`` compares with ``<`` (E14), ``'right'``
    with ``<=`` (F2). A NULL score falls through to the top band, as SQL CASE does."""
    x = _c(c)
    lo, hi = bounds
    if closed == "left":
        return F.when(x < lo, labels[0]).when(x < hi, labels[1]).otherwise(labels[2])
    return F.when(x <= lo, labels[0]).when(x <= hi, labels[1]).otherwise(labels[2])


def alert_label(c) -> Column:
    """Alert level text (F2): <= 0.3, <= 0.6, else."""
    return severity(c, labels=tuple(l for l, _ in ALERT_LEVELS), closed="right")


def alert_color(c) -> Column:
    """Alert colour (F2), same bands as ``alert_label``."""
    return severity(c, labels=tuple(k for _, k in ALERT_LEVELS), closed="right")
