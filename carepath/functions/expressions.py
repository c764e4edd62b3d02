"""Scalar column expressions.

All of these are built-in Catalyst expressions: they stay in the JVM and
inside whole-stage codegen.  None needs a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days from ``start`` to ``end`` (X3); NULL if either is NULL.

    Microsecond difference, so it works for TIMESTAMP and TIMESTAMP_NTZ
    without a time-zone round trip (``datediff`` would give whole days).
    """
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(MICROS_PER_DAY)


def clip_lower(c: Column | str, lower: float = 0.0) -> Column:
    """``pandas.clip(lower=...)``: NULL stays NULL (``greatest`` would not)."""
    c = _c(c)
    return F.when(c < F.lit(lower), F.lit(lower).cast("double")).otherwise(c.cast("double"))


def any_prefix(c: Column | str, prefixes: Iterable[str]) -> Column:
    """OR of ``startswith`` tests (X1); each one is pushed to the Parquet scan."""
    c = _c(c)
    tests = [c.startswith(p) for p in prefixes]
    if not tests:
        return F.lit(False)
    return reduce(lambda a, b: a | b, tests)


def eq_flag(c: Column | str, value: str, case_insensitive: bool = False) -> Column:
    """``(col == value).astype(int)``; NULL compares unequal -> 0."""
    c = _c(c)
    if case_insensitive:
        c = F.upper(c)
        value = value.upper()
    return F.coalesce(c == F.lit(value), F.lit(False)).cast("int")


def python_title(c: Column | str) -> Column:
    """Python's ``str.title()``: upper-case the first letter of every run of
    letters, lower-case the rest.  ``initcap`` only starts words after
    white space, so letters are re-cased position by position against an
    ``initcap`` of the string with every non-letter turned into a space.
    (Letters whose title case is several letters, such as 'ß', keep one.)"""
    c = _c(c)
    spaced = F.initcap(F.regexp_replace(c, r"[^\p{L}]", " "))
    orig_chars = F.split(c, "(?!^)")
    cap_chars = F.split(spaced, "(?!^)")
    merged = F.zip_with(orig_chars, cap_chars,
                        lambda o, t: F.when(o.rlike(r"^\p{L}$"), t).otherwise(o))
    return F.when(c == F.lit(""), c).otherwise(F.array_join(merged, ""))


# Race overrides applied after first-token title-casing.
# The first key can never match a title-cased token; it is kept as given.
RACE_OVERRIDES = {
    "PORTUGUESE": "Latino",
    "Hispanic": "Latino",
    "Unknown": "Other",
}
MAJOR_RACES = ["White", "Black", "Asian", "Latino"]


def race_first_token(c: Column | str) -> Column:
    """First token by space, then by ``/``, title-cased; NULL -> 'Unknown' (X7, X8)."""
    filled = F.coalesce(_c(c), F.lit("Unknown"))
    tok = F.split(F.split(filled, " ").getItem(0), "/").getItem(0)
    return python_title(tok)


def race_standardized(c: Column | str) -> Column:
    """Standardised race label."""
    tok = race_first_token(c)
    expr = None
    for k, v in RACE_OVERRIDES.items():
        expr = F.when(tok == k, F.lit(v)) if expr is None else expr.when(tok == k, F.lit(v))
    return expr.otherwise(tok)


def row_sum(cols: Iterable[str]) -> Column:
    """Row-wise sum skipping NULLs, like ``DataFrame.sum(axis=1)`` (X11)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def threshold_class(p: Column | str, threshold: float = 0.5) -> Column:
    """``p >= threshold`` -> 1 else 0."""
    return F.when(_c(p) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def zero_safe(y: Column | str, eps: float = 1e-10) -> Column:
    """Replace an exact zero divisor with ``eps``."""
    y = _c(y)
    return F.when(y == F.lit(0), F.lit(eps)).otherwise(y.cast("double"))


def hash_key(key: Column | str, seed: int | str = 42) -> Column:
    """Deterministic 60-bit hash of ``seed|key`` from md5 (engine-independent).

    Used for splits, folds and subsets instead of a random generator, so the
    same row lands on the same side in every engine and on every re-run.
    """
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), _c(key).cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


HASH_SPACE = float(16 ** 15)


def hash_fraction(key: Column | str, seed: int | str = 42) -> Column:
    """``hash_key`` mapped to [0, 1)."""
    return hash_key(key, seed) / F.lit(HASH_SPACE)


def to_timestamp_col(c: Column | str, fmt: str | None = None) -> Column:
    """Parse a string column to a timestamp; unparsable text gives NULL
    (``try_to_timestamp``), an existing timestamp passes through."""
    c = _c(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def parse_timestamps(df, cols: list[str], fmt: str | None = None):
    """Parse the string-typed columns among ``cols``; others are left as they are."""
    from pyspark.sql import types as T
    types = {f.name: f.dataType for f in df.schema.fields}
    todo = {c: to_timestamp_col(c, fmt) for c in cols if isinstance(types.get(c), T.StringType)}
    return df.withColumns(todo) if todo else df
