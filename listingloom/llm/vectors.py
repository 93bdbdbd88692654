"""Reading columns of vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not NULL, and no component NULL, infinite or not a number."""
    whole = F.forall(
        vector.cast("array<double>"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))
