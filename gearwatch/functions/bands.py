"""Banded classification of a numeric column (the ``expected_gear`` rule)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference: speed band edges in km/h.
# Below 0 -> 0, [0,30) -> 1, [30,60) -> 2, ..., [150,180) -> 6, otherwise 7.
GEAR_BOUNDS: tuple[float, ...] = (0, 30, 60, 90, 120, 150, 180)


def band_of(value: Column, bounds: Sequence[float] = GEAR_BOUNDS) -> Column:
    """Index of the first bound the value is strictly below; ``len(bounds)`` otherwise.

    NULL and NaN fall through every comparison and get the last band, which is
    what a ``CASE WHEN v < b0 ... ELSE n`` chain does.
    """
    if not bounds:
        raise ValueError("bounds must not be empty")
    if any(b2 <= b1 for b1, b2 in zip(bounds, bounds[1:])):
        raise ValueError("bounds must be strictly increasing")
    expr = None
    for label, bound in enumerate(bounds):
        cond = value < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(len(bounds))).cast("int")


def classify_bands(
    df: DataFrame,
    column: str = "speed",
    bounds: Sequence[float] = GEAR_BOUNDS,
    output: str = "expected_gear",
) -> DataFrame:
    """Add ``output`` = band index of ``column`` (narrow, no shuffle)."""
    return df.withColumn(output, band_of(F.col(column), bounds))
