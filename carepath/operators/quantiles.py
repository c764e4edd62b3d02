"""Exact order statistics without gathering a column in one task.

``order_statistics`` finds the k-th smallest values by histogram refinement:
each round counts the rows of at most ``BINS`` equal-width bins of the current
value range (one aggregate; only bins reach the driver) and goes on inside the
bin that holds the rank, between that bin's own least and largest value, until
these are equal.  The method and the result are the same at every size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def order_statistics(df: DataFrame, col: str, ranks: list[int]) -> list[float | None]:
    """Values of 0-based ``ranks`` among the non-null, non-NaN values of ``col``, in order."""
    values = df.select(F.col(col).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    n, lo, hi = values.agg(F.count("*"), F.min("_v"), F.max("_v")).first()
    out: dict[int, float | None] = {}
    # open ranges: (least, largest) -> [(rank, rank inside the range)]
    todo = {(lo, hi): [(r, r) for r in ranks if 0 <= r < n]}
    while todo:
        (a, b), wanted = todo.popitem()
        if not wanted:
            continue
        if a == b:
            out.update((r, a) for r, _ in wanted)
            continue
        # Halves, so that a range over the whole number line stays finite.
        width = b / 2 - a / 2
        place = F.least(F.floor((F.col("_v") / 2 - F.lit(a / 2)) / F.lit(width) * BINS), F.lit(BINS - 1)) if width > 0 else (F.col("_v") > a).cast("long")
        bins = sorted(tuple(r) for r in values.where(F.col("_v").between(a, b)).groupBy(place.alias("bin"))
                      .agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b")).collect())
        before = 0
        for _, size, least, largest in bins:
            inside = [(r, k - before) for r, k in wanted if before <= k < before + size]
            if inside:
                todo.setdefault((least, largest), []).extend(inside)
            before += size
    return [out.get(r) for r in ranks]


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """The interpolated ``q``-quantile (linear between the two nearest ranks)."""
    n = df.select(F.count_if(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))).first()[0]
    if not n:
        return None
    at = q * (n - 1)
    k = math.floor(at)
    low, high = order_statistics(df, col, [k, min(k + 1, n - 1)])
    return low + (high - low) * (at - k)
