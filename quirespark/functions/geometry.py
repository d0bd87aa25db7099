"""Boxes on a page in coordinates from 0 to 1, origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def normalize(value: Column, extent: Column) -> Column:
    """A coordinate as a share of the page; 0 where the page has no extent."""
    return F.when(extent > 0, clamp(value / extent)).otherwise(F.lit(0.0))


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def overlap_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return area(F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3]))


def contains(outer: tuple[Column, ...], inner: tuple[Column, ...]) -> Column:
    return (outer[0] <= inner[0]) & (outer[1] <= inner[1]) & (outer[2] >= inner[2]) & (outer[3] >= inner[3])


def centre_inside(outer: tuple[Column, ...], inner: tuple[Column, ...]) -> Column:
    x, y = (inner[0] + inner[2]) / 2, (inner[1] + inner[3]) / 2
    return x.between(outer[0], outer[2]) & y.between(outer[1], outer[3])


def grid(c: Column, step: float) -> Column:
    """Number of the nearest grid line; halves go to the even one."""
    return F.rint(c / step).cast("int")


def x_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Horizontal overlap as a share of the narrower box."""
    both = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    return both / F.least(F.greatest(a[2] - a[0], F.lit(0.001)), F.greatest(b[2] - b[0], F.lit(0.001)))


def y_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """How far the centre of ``b`` is below that of ``a``."""
    return (b[1] + b[3]) / 2 - (a[1] + a[3]) / 2


def box(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(prefix + c) for c in ("x0", "y0", "x1", "y1"))
