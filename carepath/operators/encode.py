"""Scaling and one-hot encoding.

Fitting collects only one-row statistics or bounded vocabularies to the
driver; applying them is a narrow ``select`` of literal expressions, so no
row data moves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.names import existing

MAX_CATEGORIES = 1000


@dataclass
class ScalerModel:
    """Population mean and standard deviation per column (F1)."""
    stats: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, (mean, std) in self.stats.items():
            if c not in df.columns:
                continue
            scale = std if (std is not None and std != 0.0) else 1.0
            centre = mean if mean is not None else 0.0
            exprs[c] = (F.col(c).cast("double") - F.lit(centre)) / F.lit(scale)
        return df.withColumns(exprs) if exprs else df


def fit_scaler(df: DataFrame, cols: list[str]) -> ScalerModel:
    """Mean and *population* std of each existing column in one aggregate;
    a zero (or undefined) std scales by 1, as scikit-learn does."""
    cols = existing(df, cols)
    if not cols:
        return ScalerModel({})
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return ScalerModel({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)})


def standard_scale(df: DataFrame, cols: list[str], fit_df: DataFrame | None = None
                   ) -> tuple[DataFrame, ScalerModel]:
    """``normalize_numerical_features``: z-score the columns that exist (F1).
    Statistics come from ``fit_df`` (e.g. the training rows) or ``df``."""
    model = fit_scaler(fit_df if fit_df is not None else df, cols)
    return model.transform(df), model


NULL_LABEL = "nan"


@dataclass
class OneHotModel:
    """Sorted categories per column; the first one is dropped."""
    categories: dict[str, list[str | None]] = field(default_factory=dict)
    drop_first: bool = True

    def output_columns(self) -> list[str]:
        return [name for _, _, name in self._slots()]

    def _slots(self):
        for c, cats in self.categories.items():
            kept = cats[1:] if self.drop_first else cats
            for v in kept:
                yield c, v, f"{c}_{NULL_LABEL if v is None else v}"

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each encoded column with its indicator columns.  A value not
        seen in fitting gets all zeros (``handle_unknown='ignore'``)."""
        if not self.categories:
            return df
        encoded = []
        for c, v, name in self._slots():
            hit = F.col(c).isNull() if v is None else F.coalesce(F.col(c) == F.lit(v), F.lit(False))
            encoded.append(hit.cast("double").alias(name))
        keep = [F.col(f"`{x}`") for x in df.columns if x not in self.categories]
        return df.select(*keep, *encoded)


def fit_one_hot(df: DataFrame, cols: list[str], drop_first: bool = True,
                max_categories: int = MAX_CATEGORIES) -> OneHotModel:
    """Collect sorted distinct values of every column in one job.

    The vocabulary is the only thing that reaches the driver; a column with
    more than ``max_categories`` values raises instead of widening the table
    without bound.  NULL is its own category, sorted last.
    """
    cols = existing(df, cols)
    if not cols:
        return OneHotModel({}, drop_first)
    pairs = (df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols]))
                .alias("p"))
               .select("p.k", "p.v").distinct())
    rows = pairs.limit(max_categories * len(cols) + 1).collect()
    cats: dict[str, list[str | None]] = {c: [] for c in cols}
    for r in rows:
        cats[r["k"]].append(r["v"])
    for c, vals in cats.items():
        if len(vals) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} categories")
        vals.sort(key=lambda v: (v is None, v or ""))
    return OneHotModel(cats, drop_first)


def one_hot(df: DataFrame, cols: list[str], fit_df: DataFrame | None = None,
            drop_first: bool = True) -> tuple[DataFrame, OneHotModel | None]:
    """``encode_categorical_features``: indicator columns named
    ``<col>_<value>`` with the alphabetically first value dropped (F2); fit on
    ``fit_df`` to encode unseen data (F3).  No columns -> unchanged, None."""
    if not cols:
        return df, None
    model = fit_one_hot(fit_df if fit_df is not None else df, cols, drop_first)
    return model.transform(df), model
