"""Distributed running sums over an ordered column.

A window ``sum(...).over(Window.orderBy(x))`` with no partition key moves
every row into one task.  ``running_sums`` instead cuts the order column
into ranges at approximate quantiles (one pass), sums each range
(one aggregate; only ``n_ranges`` rows reach the driver), and runs the
window per range with the preceding ranges' totals added as literals.
The result is exact; the quantiles only balance the ranges.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _with_range_id(df: DataFrame, col: str, cuts: list[float], out: str = "_rg") -> DataFrame:
    """Index of the range holding ``col`` by binary search over the cuts
    (``Bucketizer``, JVM-side): stays O(log n) per row however many ranges
    the cluster's partition count asks for."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf")] + list(cuts) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep")
    return b.transform(df).withColumn(out, F.col(out).cast("int"))


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], n_ranges: int | None = None,
                 descending: bool = False, prefix: str = "cum_", by: str | None = None) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` in ``order_col``
    order, and the grand totals ``total_<c>`` (known from the range sums).
    ``order_col`` must be unique per row (aggregate first) and numeric.  With
    ``by`` every value of that column (a few: models, say) has sums of its own;
    the ranges are shared, so all of them take one pass."""
    spark = df.sparkSession
    if n_ranges is None:
        n_ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    key = F.col(order_col)
    if descending:
        df = df.withColumn("_ord", -key.cast("double"))
    else:
        df = df.withColumn("_ord", key.cast("double"))
    probs = [i / n_ranges for i in range(1, n_ranges)]
    cuts = sorted(set(x for x in df.approxQuantile("_ord", probs, 0.001) if x is not None)) if probs else []
    staged = _with_range_id(df, "_ord", cuts)
    group = [by, "_rg"] if by else ["_rg"]
    totals = staged.groupBy(*group).agg(*[F.sum(c).alias(c) for c in sum_cols])
    kinds = {c: totals.schema[c].dataType for c in sum_cols}
    totals = totals.collect()
    by_range = {(r[by] if by else None, r["_rg"]): r for r in totals}
    groups = sorted({g for g, _ in by_range}, key=str)
    offsets: dict[str, dict[tuple, float]] = {c: {} for c in sum_cols}
    sums = {}
    for g in groups or [None]:
        acc = {c: 0 for c in sum_cols}
        for rg in range(len(cuts) + 2):   # + the NaN bucket kept by the Bucketizer
            for c in sum_cols:
                offsets[c][g, rg] = acc[c]
                row = by_range.get((g, rg))
                if row is not None and row[c] is not None:
                    acc[c] += row[c]
        sums[g] = acc
    w = Window.partitionBy(*group).orderBy("_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def number(c, v):
        # Of the sum's own type: a literal of fewer bits would overflow in what is computed from it.
        return F.lit(v).cast(kinds[c])

    def numbers(c, values: dict):
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), number(c, v))])

    out = staged
    for c in sum_cols:
        per_group = {g: numbers(c, {rg: v for (h, rg), v in offsets[c].items() if h == g}) for g in sums}
        if by and groups:
            maps = F.create_map(*[x for g, m in per_group.items() for x in (F.lit(g), m)])
            off = F.element_at(F.element_at(maps, F.col(by)), F.col("_rg"))
            whole = F.element_at(numbers(c, {g: s[c] for g, s in sums.items()}), F.col(by))
        else:
            off, whole = F.element_at(next(iter(per_group.values())), F.col("_rg")), number(c, next(iter(sums.values()))[c])
        out = out.withColumns({f"{prefix}{c}": F.sum(c).over(w) + off, f"total_{c}": whole})
    return out.drop("_ord", "_rg")
