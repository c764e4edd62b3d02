"""Column-name helpers (P5, P8, P9, X16): driver-side work on the schema only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NON_WORD = re.compile(r"[^\w_]")


def clean_name(name: str) -> str:
    """Every non-word character becomes ``_``."""
    return _NON_WORD.sub("_", str(name))


def clean_feature_names(df: DataFrame) -> DataFrame:
    """Rename all columns with ``clean_name``; two names mapping to one raise."""
    new = [clean_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"cleaned column names collide: {dup}")
    return df.toDF(*new)


def existing(df: DataFrame, names: list[str]) -> list[str]:
    """Names from ``names`` that are columns of ``df``, in the given order."""
    cols = set(df.columns)
    return [n for n in names if n in cols]


def string_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Categorical discovery: string-typed columns not in ``exclude``."""
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]
