"""Deterministic, exact stratified splits and their checks.

Rows are ordered inside each class by the md5-hash of seed|key (rows that
share a key, by a hash of the row); the
first ``round(share * n_class)`` rows of each class form the test side.
That is exact (like a stratified ``train_test_split``) and reproducible in
any engine, but an ordinary ``row_number`` window per class would put a
whole class into one task.  Instead the class cut point is *selected*:

1. a histogram of the hash's top 16 bits per class (partial aggregate,
   at most classes x 65,536 rows reach the driver);
2. the bin that holds the cut is refined on the next 16 bits, and so on,
   until it holds at most ``collect_limit`` rows, of which Spark picks one;
3. only where the cut falls between rows that share a key are these rows
   hashed as a whole: no other row's columns are read for it;
4. the cut ``(hash, row hash)`` per class becomes a literal, and the split is a
   plain per-row comparison: no shuffle of the row data at all.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.expressions import hash_key

HASH_BITS = 60
LEVEL_BITS = 16
COLLECT_LIMIT = 50_000
MAX_STRATA = 1024


def class_targets(counts: dict, share: float) -> dict:
    """Rows to select per class: ``floor(share * n + 0.5)``."""
    import math
    return {k: int(math.floor(share * n + 0.5)) for k, n in counts.items()}


#: A row hash above every row hash: all rows of the key belong to the test side.
WHOLE_KEY = 1 << HASH_BITS


def _select_cuts(narrow: DataFrame, wide: DataFrame, strata: str, targets: dict, collect_limit: int,
                 first_level: list | None = None) -> dict:
    """Return ``{class: (h, t)}`` of each class's k-th smallest row in the order
    ``(_h, _t)``, or ``None`` when k is 0, or ``"all"``.  ``narrow`` has the
    class and ``_h``; ``wide`` has ``_t`` too and is read for rows of one key only.

    ``_h`` and ``_t`` together are one key of 2 * HASH_BITS bits, refined level
    by level: a key that many rows share is refined on through ``_t``, so the
    driver receives histogram bins and one row per class, never rows."""
    cuts: dict = {s: None for s, k in targets.items() if k <= 0}

    def prefix_is(bits, value):
        if bits <= HASH_BITS:
            return F.shiftrightunsigned(F.col("_h"), HASH_BITS - bits) == F.lit(value)
        low = bits - HASH_BITS
        return ((F.col("_h") == F.lit(value >> low))
                & (F.shiftrightunsigned(F.col("_t"), HASH_BITS - low) == F.lit(value & ((1 << low) - 1))))

    # state per class: (prefix value, rank inside it); all open classes are at the same depth
    todo, depth = {s: (0, k) for s, k in targets.items() if k > 0}, 0
    while todo:
        column, used, df = ("_h", depth, narrow) if depth < HASH_BITS else ("_t", depth - HASH_BITS, wide)
        level = min(LEVEL_BITS, HASH_BITS - used)
        digit = F.shiftrightunsigned(F.col(column), HASH_BITS - used - level).bitwiseAND(F.lit((1 << level) - 1))
        if depth == 0 and first_level is not None:
            hist = first_level
        else:
            cond = F.lit(False)
            for s, (prefix, _) in todo.items():
                cond = cond | (F.col(strata).eqNullSafe(F.lit(s)) & prefix_is(depth, prefix))
            hist = df.filter(cond).groupBy(strata, digit.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).collect()
        by_class: dict = {}
        for r in hist:
            by_class.setdefault(r[strata], []).append((r["_b"], r["_n"]))
        depth += level
        nxt = {}
        for s, (prefix, k) in todo.items():
            acc = 0
            for b, n in sorted(by_class.get(s, [])):
                if acc + n >= k:
                    break
                acc += n
            else:  # fewer rows than asked: everything is selected
                cuts[s] = "all"
                continue
            rank, value = k - acc, (prefix << level) | b
            here = F.col(strata).eqNullSafe(F.lit(s)) & prefix_is(depth, value)
            if depth > HASH_BITS and (n <= collect_limit or depth >= 2 * HASH_BITS):
                rows = wide.filter(here).select("_h", "_t")
                if n <= collect_limit:
                    rows = rows.orderBy("_h", "_t").limit(rank)
                last = rows.agg(F.max(F.struct("_h", "_t")).alias("m")).first()["m"]
                cuts[s] = (last["_h"], last["_t"])
            elif n <= collect_limit:
                rows = narrow.filter(here)
                h = rows.select("_h").orderBy("_h").limit(rank).agg(F.max("_h")).first()[0]
                around = rows.agg(F.count_if(F.col("_h") < h).alias("less"), F.count_if(F.col("_h") == h).alias("same")).first()
                missing = rank - around["less"]
                if missing == around["same"]:
                    cuts[s] = (h, WHOLE_KEY)
                else:                      # the cut falls between rows of one key
                    tied = wide.filter(F.col(strata).eqNullSafe(F.lit(s)) & (F.col("_h") == F.lit(h))).select("_t")
                    cuts[s] = (h, tied.orderBy("_t").limit(missing).agg(F.max("_t")).first()[0])
            else:
                nxt[s] = (value, rank)
        todo = nxt
    return cuts


def stratified_flags(df: DataFrame, key: str, strata: str, share: float, seed: int = 42,
                     out: str = "is_test", collect_limit: int = COLLECT_LIMIT) -> DataFrame:
    """Add boolean ``out``: True for the exact per-class ``share`` of rows
    with the smallest hash of seed and key.  Rows that share a key are ordered
    by a hash of the whole row, so the share holds whatever the keys; only
    rows equal in every column stay together."""
    tie = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in df.columns]), 64 - HASH_BITS)
    base = df.withColumns({"_h": hash_key(F.col(key), seed), "_t": tie})
    # The selection jobs need two narrow columns only; keep them for the
    # few jobs instead of recomputing the input's lineage each time (the
    # hash is deterministic, so a recomputed partition is identical).
    narrow = base.select(strata, "_h").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A class is a value of the target; their number is counted before any bins are fetched.
        if narrow.select(strata).distinct().limit(MAX_STRATA + 1).count() > MAX_STRATA:
            raise ValueError(f"more than {MAX_STRATA} strata in {strata!r}")
        # The first histogram level also yields the class sizes: one job for both.
        top = (narrow.groupBy(strata, F.shiftrightunsigned(F.col("_h"), HASH_BITS - LEVEL_BITS).alias("_b"))
                     .agg(F.count(F.lit(1)).alias("_n")).collect())
        counts: dict = {}
        for r in top:
            counts[r[strata]] = counts.get(r[strata], 0) + r["_n"]
        cuts = _select_cuts(narrow, base, strata, class_targets(counts, share), collect_limit, first_level=top)
    finally:
        narrow.unpersist()
    flag = F.lit(False)
    for s, cut in cuts.items():
        if cut is None:
            continue
        sel = F.lit(True)
        if cut != "all":
            h, t = cut
            sel = F.col("_h") <= F.lit(h)
            if t != WHOLE_KEY:
                sel = (F.col("_h") < F.lit(h)) | ((F.col("_h") == F.lit(h)) & (F.col("_t") <= F.lit(t)))
        flag = F.when(F.col(strata).eqNullSafe(F.lit(s)), sel).otherwise(flag)
    return base.withColumn(out, flag).drop("_h", "_t")


def stratified_split(df: DataFrame, key: str = "hadm_id", target: str = "is_readmission",
                     test_size: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """``prepare_data_for_modeling``: a ``split`` column 'train' / 'test' (F6)."""
    flagged = stratified_flags(df, key, target, test_size, seed, out="_is_test")
    return (flagged.withColumn(out, F.when(F.col("_is_test"), F.lit("test")).otherwise(F.lit("train")))
                   .drop("_is_test"))


def tuning_sample(df: DataFrame, key: str = "hadm_id", target: str | None = "is_readmission",
                  share: float = 1.0, seed: int = 42) -> DataFrame:
    """Keep ``share`` of the rows, exact per class (F7).  The caller states the
    share; it never depends on the number of rows."""
    if share >= 1.0:
        return df
    if target is None:
        df = df.withColumn("_one", F.lit(1))
        return stratified_flags(df, key, "_one", share, seed, "_keep").filter("_keep").drop("_keep", "_one")
    return stratified_flags(df, key, target, share, seed, "_keep").filter("_keep").drop("_keep")


def split_disjoint(split_df: DataFrame, key: str = "hadm_id", split: str = "split") -> DataFrame:
    """Train/test sizes, ids on both sides and train-only ids.

    One aggregate per key, then one global aggregate: no join at all.
    """
    per_key = split_df.groupBy(key).agg(
        F.count_if(F.col(split) == "train").alias("_tr"),
        F.count_if(F.col(split) == "test").alias("_te"))
    return per_key.agg(
        F.coalesce(F.sum("_tr"), F.lit(0)).cast("long").alias("n_train"),
        F.coalesce(F.sum("_te"), F.lit(0)).cast("long").alias("n_test"),
        F.count_if((F.col("_tr") > 0) & (F.col("_te") > 0)).cast("long").alias("n_both"),
        F.count_if((F.col("_tr") > 0) & (F.col("_te") == 0)).cast("long").alias("n_train_only"))


def split_balance(split_df: DataFrame, target: str = "is_readmission", split: str = "split") -> DataFrame:
    """Size, positives and positive share per split."""
    t = F.col(target).cast("int")
    return split_df.groupBy(split).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.coalesce(F.sum(t), F.lit(0)).cast("long").alias("positives"),
        F.avg(t).alias("positive_share"))


def by_split(values: DataFrame, split_df: DataFrame, key: str = "hadm_id",
             split: str = "split") -> DataFrame:
    """Attach split membership by key, never by row position."""
    return values.join(split_df.select(key, split), key, "inner")


def sample_fixed(df: DataFrame, key: str, n: int = 50) -> DataFrame:
    """Deterministic fixed-size sample: the ``n`` rows with the smallest
    ``md5(key)`` (S11).  A distributed top-k, not a full sort."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)
