"""Box geometry as column expressions. Boxes are structs with x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0.0)) * F.greatest(b["y2"] - b["y1"], F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    """Area common to two boxes; both sides are held at 0, so that two negative ones make no area."""
    width = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    height = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for two boxes without area."""
    common = intersection(a, b)
    return F.coalesce(F.try_divide(common, area(a) + area(b) - common), F.lit(0.0))


def contained(a: Column, b: Column) -> Column:
    """Share of the first box that lies in the second; 0 if it has no area."""
    return F.coalesce(F.try_divide(intersection(a, b), area(a)), F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """Whether boxes touch or overlap: the cheap test before a measure."""
    return (a["x1"] <= b["x2"]) & (b["x1"] <= a["x2"]) & (a["y1"] <= b["y2"]) & (b["y1"] <= a["y2"])


def ranges_overlap(low_a: Column, high_a: Column, low_b: Column, high_b: Column, grace: int = 0) -> Column:
    """Whether two ranges of depths, each wider by the grace on both sides, meet; false where one is missing."""
    return F.coalesce((low_a - grace <= high_b + grace) & (low_b - grace <= high_a + grace), F.lit(False))


def unit_box(b: Column, width: Column, height: Column) -> Column:
    """A box with corners in order and within the unit square: swapped corners are turned, pixels divided by the size.

    Null if a coordinate is missing, or pixels come without a usable size.
    """
    pixels = F.greatest(b["x1"], b["x2"], b["y1"], b["y2"]) > 2
    share = lambda c, size: F.when(pixels, F.try_divide(c, F.nullif(size.cast("double"), F.lit(0.0)))).otherwise(c)
    x1, x2, y1, y2 = share(b["x1"], width), share(b["x2"], width), share(b["y1"], height), share(b["y2"], height)
    held = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    out = F.struct(b["label"].alias("label"), held(F.least(x1, x2)).alias("x1"), held(F.least(y1, y2)).alias("y1"), held(F.greatest(x1, x2)).alias("x2"), held(F.greatest(y1, y2)).alias("y2"))
    return F.when(x1.isNotNull() & x2.isNotNull() & y1.isNotNull() & y2.isNotNull(), out)
