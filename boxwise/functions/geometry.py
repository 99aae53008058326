"""Box geometry as Column expressions (contract K2).

Boxes are corners ``(x1, y1, x2, y2)``; areas and intersections have no ``+1``.
Threshold tests compare ``inter > thr * union`` so that no division decides a
keep/drop, and the DuckDB oracle uses the identical expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(b, name: str) -> Column:
    """Field ``name`` of box ``b``: a struct Column, or a prefix string."""
    if isinstance(b, str):
        return F.col(f"{b}{name}")
    return b[name]


def area(b) -> Column:
    return (_c(b, "x2") - _c(b, "x1")) * (_c(b, "y2") - _c(b, "y1"))


def intersection(a, b) -> Column:
    iw = F.greatest(F.lit(0.0), F.least(_c(a, "x2"), _c(b, "x2")) - F.greatest(_c(a, "x1"), _c(b, "x1")))
    ih = F.greatest(F.lit(0.0), F.least(_c(a, "y2"), _c(b, "y2")) - F.greatest(_c(a, "y1"), _c(b, "y1")))
    return iw * ih


def iou(a, b) -> Column:
    """Intersection over union; 0 when the union is 0."""
    inter = intersection(a, b)
    uni = area(a) + area(b) - inter
    return F.when(uni > 0, inter / uni).otherwise(F.lit(0.0))


def iou_above(a, b, thr: float) -> Column:
    """``IoU(a, b) > thr`` written without a division."""
    inter = intersection(a, b)
    return inter > F.lit(float(thr)) * (area(a) + area(b) - inter)


def round_half_even(c: Column) -> Column:
    """Python's ``int(round(v))``: banker's rounding, then an integer."""
    return F.bround(c, 0).cast("int")
