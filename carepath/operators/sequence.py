"""Skew-aware "previous row" per key (the engine of W1).

A plain ``lag(...).over(Window.partitionBy(key).orderBy(...))`` sends every
row of a key to one task.  That is fine while keys are small, but one
patient (or one bad default id) holding a third of all rows would leave a
single straggler task sorting a third of the table.

``lag_within`` therefore:

1. counts rows per key with a partial (map-side combined) aggregate and
   keeps only *hot* keys, those above ``rows_per_bucket`` rows;
2. if there are none, runs the plain window (one shuffle, as usual);
3. otherwise cuts each hot key into about ``ceil(n / rows_per_bucket)`` buckets
   of equal counts at quantiles of its first order column, runs the window per
   ``(key, bucket)``, and stitches bucket borders: the last row of every
   hot bucket is found with a partial ``max_by`` aggregate, shifted one
   bucket with a window over that small summary, and joined back.

The hot-key table and the bucket summary have a proven size bound
(``total rows / rows_per_bucket``); they are broadcast only when that bound
is below ``broadcast_limit`` and shuffled otherwise.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_BUCKET = 2_000_000
DEFAULT_BROADCAST_LIMIT = 200_000


def _maybe_broadcast(df: DataFrame, n_rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= limit else df


# Hot-key statistics of an explicit base table, kept per DataFrame object
# for the life of that object (a DataFrame over files sees a fixed listing,
# so its statistics do not change while it lives).
_HOT_CACHE: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


#: Cut points of a hot key are chosen among this many quantiles of its order column.
QUANTILES = 1000


def _position(df: DataFrame, t0: str):
    """The first order column as a number."""
    if isinstance(df.schema[t0].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(t0).cast("timestamp")).cast("double")
    return F.col(t0).cast("double")


def _hot_keys(src_df: DataFrame, key: str, t0: str, rows_per_bucket: int, cache: bool):
    memo = _HOT_CACHE.setdefault(src_df, {}) if cache else {}
    k = (key, t0, rows_per_bucket)
    if k not in memo:
        narrow = src_df.select(key, _position(src_df, t0).alias("_p"))
        # Cut at quantiles, so that buckets hold equal counts, not equal spans.
        probs = [i / QUANTILES for i in range(1, QUANTILES)]
        counts = narrow.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(rows_per_bucket))
        st = counts.agg(F.count(F.lit(1)).alias("k"),
                        F.sum(F.ceil(F.col("_n") / F.lit(rows_per_bucket))).alias("b")).first()
        cuts = (narrow.join(counts, key).groupBy(key)
                .agg(F.first("_n").alias("_n"), F.percentile_approx("_p", probs, 10 * QUANTILES).alias("_q")))
        nb = F.least(F.ceil(F.col("_n") / F.lit(rows_per_bucket)), F.lit(QUANTILES)).cast("int")
        hot = cuts.select(key, F.array_distinct(F.transform(
            F.sequence(F.lit(1), nb), lambda i: F.get("_q", (i * QUANTILES / nb).cast("int") - 1))).alias("_cuts"))
        memo[k] = (hot, int(st["k"]), int(st["b"] or 0))
    return memo[k]


def _bucketed(df: DataFrame, key: str, t0: str, rows_per_bucket: int, broadcast_limit: int,
              stats_from: DataFrame | None):
    """Attach ``_bucket`` (0 for ordinary keys, a bucket of about
    ``rows_per_bucket`` rows for hot keys) and ``_hot``; returns
    ``(staged, n_buckets)`` or ``None`` when no key is hot.

    Buckets are monotone in ``t0``, so rows with equal ``t0`` share a bucket
    and every bucket of a key precedes the next in the key's order."""
    src = stats_from if stats_from is not None else df
    hot, n_hot, n_buckets = _hot_keys(src, key, t0, rows_per_bucket, cache=stats_from is not None)
    if n_hot == 0:
        return None
    pos = _position(df, t0)
    bucket = F.when(F.col("_cuts").isNull() | pos.isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_cuts", lambda c: c < pos))).cast("long")
    # Keys of a superset that are absent from df simply find no partner.
    staged = (df.join(_maybe_broadcast(hot, n_hot, broadcast_limit), key, "left")
                .withColumns({"_bucket": bucket, "_hot": F.col("_cuts").isNotNull()})
                .drop("_cuts"))
    return staged, n_buckets


def lag_within(df: DataFrame, key: str, order_cols: list[str], value_cols: list[str],
               prev_col: str = "_prev", rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
               broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
               stats_from: DataFrame | None = None) -> DataFrame:
    """Add ``prev_col``: a struct of ``value_cols`` from the previous row of the
    same ``key`` in ``order_cols`` order (NULL on a key's first row).

    The first order column must be a timestamp or number; later ones break
    ties.  Rows with a NULL first order column sort first, as in a window.

    ``stats_from`` may name a cheaper table with the same rows per key (for
    example the base table that ``df`` was semi-joined from): the hot-key
    count then scans just ``key`` and the first order column of it instead
    of recomputing ``df``'s lineage.  Counts from a superset only make more
    keys "hot", which changes the plan, never the result.
    """
    vals = F.struct(*[F.col(v) for v in value_cols])
    b = _bucketed(df, key, order_cols[0], rows_per_bucket, broadcast_limit, stats_from)
    if b is None:
        w = Window.partitionBy(key).orderBy(*order_cols)
        return df.withColumn(prev_col, F.lag(vals).over(w))
    staged, n_buckets = b

    w = Window.partitionBy(key, "_bucket").orderBy(*order_cols)
    windowed = staged.withColumn(prev_col, F.lag(vals).over(w))

    order_struct = F.struct(*[F.col(c) for c in order_cols])
    last_per_bucket = (staged.filter(F.col("_hot"))
                       .groupBy(key, "_bucket")
                       .agg(F.max_by(vals, order_struct).alias("_last")))
    wb = Window.partitionBy(key).orderBy("_bucket")
    carry = (last_per_bucket
             .withColumn("_carry", F.lag("_last").over(wb))
             .select(key, "_bucket", "_carry"))

    return (windowed.join(_maybe_broadcast(carry, n_buckets, broadcast_limit), [key, "_bucket"], "left")
            .withColumn(prev_col, F.coalesce(F.col(prev_col), F.col("_carry")))
            .drop("_carry", "_bucket", "_hot"))


def running_max_within(df: DataFrame, key: str, order_col: str, value_cols: list[str],
                       rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                       broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                       stats_from: DataFrame | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<v>``: the max of ``v`` over the rows of the same ``key`` whose
    ``order_col`` is at most this row's (ties included, a RANGE frame).

    Hot keys are split into time buckets as in ``lag_within``: the running max
    runs per ``(key, bucket)`` and the max of all earlier buckets (a running
    max over the small per-bucket summary) is folded in."""
    frame = (Window.unboundedPreceding, Window.currentRow)
    b = _bucketed(df, key, order_col, rows_per_bucket, broadcast_limit, stats_from)
    if b is None:
        w = Window.partitionBy(key).orderBy(order_col).rangeBetween(*frame)
        return df.withColumns({f"{prefix}{v}": F.max(v).over(w) for v in value_cols})
    staged, n_buckets = b
    w = Window.partitionBy(key, "_bucket").orderBy(order_col).rangeBetween(*frame)
    windowed = staged.withColumns({f"{prefix}{v}": F.max(v).over(w) for v in value_cols})
    per_bucket = (staged.filter(F.col("_hot")).groupBy(key, "_bucket")
                  .agg(*[F.max(v).alias(f"_m_{v}") for v in value_cols]))
    wb = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(key, "_bucket", *[F.max(f"_m_{v}").over(wb).alias(f"_c_{v}") for v in value_cols])
    out = windowed.join(_maybe_broadcast(carry, n_buckets, broadcast_limit), [key, "_bucket"], "left")
    return (out.withColumns({f"{prefix}{v}": F.greatest(F.col(f"{prefix}{v}"), F.col(f"_c_{v}"))
                             for v in value_cols})
               .drop("_bucket", "_hot", *[f"_c_{v}" for v in value_cols]))
