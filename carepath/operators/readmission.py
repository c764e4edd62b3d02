"""Readmission flags from consecutive stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.expressions import days_between
from carepath.operators.sequence import DEFAULT_ROWS_PER_BUCKET, lag_within


def flag_readmissions(admissions: DataFrame, window_days: float = 30,
                      propagate_ids: bool = False, keep_gap: bool = False,
                      order_cols: list[str] | None = None,
                      rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                      stats_from: DataFrame | None = None) -> DataFrame:
    """Flag each stay that starts within ``window_days`` after the previous
    discharge of the same patient (W1, W2).

    Stays are ordered by ``admittime`` then ``hadm_id`` per ``subject_id``.
    The gap is ``admittime - previous dischtime`` in fractional days; a stay
    is a readmission when ``0 < gap <= window_days``.  Overlapping stays,
    a NULL previous discharge and first stays are not flagged.
    ``days_until_readmission`` holds the gap on flagged rows, else NULL.

    ``propagate_ids=True`` also flags every other row carrying the same
    ``hadm_id`` (W3); only needed when admission ids can repeat.
    ``keep_gap=True`` keeps the raw ``gap_days`` column for audit.
    ``order_cols`` replaces the ``admittime, hadm_id`` stay order.
    ``stats_from`` (e.g. the unfiltered admissions table) lets the hot-patient
    check scan two columns of a base table (see ``lag_within``).
    """
    order_cols = order_cols or ["admittime", "hadm_id"]
    lagged = lag_within(admissions, "subject_id", order_cols, ["dischtime"],
                        prev_col="_prev", rows_per_bucket=rows_per_bucket, stats_from=stats_from)
    gap = days_between(F.col("_prev.dischtime"), F.col("admittime"))
    flag = F.coalesce((gap > F.lit(0)) & (gap <= F.lit(float(window_days))), F.lit(False))
    out = (lagged.withColumn("gap_days", gap)
                 .withColumn("is_readmission", flag)
                 .withColumn("days_until_readmission",
                             F.when(F.col("is_readmission"), F.col("gap_days")))
                 .drop("_prev"))
    if propagate_ids:
        out = propagate_by_id(out, order_cols)
    if not keep_gap:
        out = out.drop("gap_days")
    return out


def propagate_by_id(flagged: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Give every row of an ``hadm_id`` the flag of any qualifying row.

    The gap written is the one from the last qualifying pair in patient,
    admit-time order (later assignments overwrite earlier ones).  Built as a
    partial aggregate per id joined back, so a hot id is folded map-side and
    the join can be split by AQE's skew handling.
    """
    per_id = (flagged.filter(F.col("is_readmission"))
              .groupBy("hadm_id")
              .agg(F.max_by("days_until_readmission",
                            F.struct("subject_id", *(order_cols or ["admittime", "hadm_id"])))
                   .alias("_days")))
    return (flagged.drop("is_readmission", "days_until_readmission")
            .join(per_id, "hadm_id", "left")
            .withColumn("is_readmission", F.col("_days").isNotNull())
            .withColumnRenamed("_days", "days_until_readmission"))


def readmission_rate(flagged: DataFrame) -> DataFrame:
    """Readmissions, admissions and their ratio (A7); rate NULL when empty."""
    f = F.col("is_readmission").cast("int")
    return flagged.agg(
        F.coalesce(F.sum(f), F.lit(0)).cast("long").alias("n_readmissions"),
        F.count(F.lit(1)).cast("long").alias("n_admissions"),
        F.avg(f).alias("readmission_rate"),
    )
