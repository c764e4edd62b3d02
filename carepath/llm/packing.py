"""Packing into optimal length buckets.

Documents are cut into pieces of at most ``max_len`` words.  Dynamic
programming over the histogram of all piece lengths (one row per length, so at
most ``max_len`` rows reach the driver) picks the ``n_buckets`` boundaries with
the least padding.  Inside a bucket, pieces in a seeded total order form
batches whose padded size, rows times boundary, stays within
``token_budget``.  The order is a global rank over range partitions, so a
bucket with most of the rows spreads over all tasks.

Defined cases: null or empty text makes no piece; a longer text makes several,
the last one short; repeated rows make pieces of their own; an empty table
makes no batch; other columns play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, global_rank, word_count

MAX_LEN, N_BUCKETS, TOKEN_BUDGET, SEED = 2048, 8, 16384, 73


def optimal_boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Boundaries (ascending, the last one the largest length) that minimise
    the sum over all pieces of boundary - length, with at most ``n_buckets``."""
    lengths = np.array(sorted(histogram), np.int64)
    m = len(lengths)
    if not m:
        return []
    below = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()])]).astype(float)
    best = below[1:] * lengths                       # one bucket: padded size up to each length
    cuts = []
    for _ in range(1, min(n_buckets, m)):
        now, cut_at = best.copy(), np.full(m, -1)
        for j in range(1, m):                        # last bucket is lengths[i + 1 .. j]
            cost = best[:j] + (below[j + 1] - below[1:j + 1]) * lengths[j]
            i = int(np.argmin(cost))
            if cost[i] < now[j]:
                now[j], cut_at[j] = cost[i], i
        cuts.append(cut_at)
        best = now
    out, j = [], m - 1
    for cut_at in reversed(cuts):
        out.append(int(lengths[j]))
        if cut_at[j] < 0:
            # fewer buckets do as well here; the earlier table has the same cost
            out.pop()
            continue
        j = int(cut_at[j])
    out.append(int(lengths[j]))
    return sorted(set(out))


def pieces(docs: DataFrame, id_col: str, text_col: str, max_len: int) -> DataFrame:
    """(_id, piece, n_tokens): runs of at most ``max_len`` words."""
    n = docs.select(F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("_n")).where("_n > 0")
    n = cut(n, "sizes")                              # the texts are read once
    return (n.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {max_len}"))))
            .select("_id", "piece", F.least(F.lit(max_len), F.col("_n") - F.col("piece") * max_len).cast("long").alias("n_tokens")))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET, seed: int = SEED) -> DataFrame:
    """(``id_col``, piece, start, n_tokens, bucket, bucket_len, batch, slot), a
    row per piece; ``start`` is the piece's first word, ``batch`` counts from 0
    in its bucket, ``slot`` is the row inside the batch."""
    if token_budget < max_len:
        raise ValueError("a batch must hold one piece of the largest length")
    cut_up = pieces(docs, id_col, text_col, max_len)
    histogram = {r["n_tokens"]: r["c"] for r in cut_up.groupBy("n_tokens").agg(F.count("*").alias("c")).collect()}
    bounds = optimal_boundaries(histogram, n_buckets) or [max_len]
    firsts = [sum(c for x, c in histogram.items() if x <= b) for b in [0, *bounds[:-1]]]
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    number = F.array_size(F.filter(array(bounds), lambda b: b < F.col("n_tokens")))
    ranked = global_rank(cut_up.withColumns({"bucket": number, "_h": F.xxhash64(F.lit(seed), "_id", "piece")}),
                         ["bucket", "_h", "_id", "piece", "n_tokens"])
    size = F.get(array(bounds), F.col("bucket"))
    index = F.col("_rank") - F.get(array(firsts), F.col("bucket"))
    rows = F.floor(F.lit(token_budget) / size).cast("long")
    return ranked.select(F.col("_id").alias(id_col), "piece", (F.col("piece") * max_len).alias("start"), "n_tokens", "bucket",
                         size.alias("bucket_len"), F.floor(index / rows).cast("long").alias("batch"), (index % rows).alias("slot"))
