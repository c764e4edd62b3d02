"""Approximate nearest neighbours by shifted space-filling curves.

1. Vectors are completed to equal norms (one more coordinate), which turns the
   largest inner product into the nearest vector; queries get 0 there.
2. Each of ``CURVES`` curves projects them on ``DIMS`` random orthogonal
   directions, shifts the grid by a random offset, and takes the Hilbert index
   of the cell.  All (curve, key) rows are sorted at once over range partitions
   and numbered: a row's place on a curve is its global rank.
3. The window is measured, not guessed: for a bounded sample of
   ``SAMPLE_QUERIES`` queries the exact neighbours are found by one pass over
   all rows, and for 1, 2 ... curves the half-width is the ``RECALL`` quantile of the least
   distance in rank, over these curves, between a query and its neighbours.
   The number of curves is taken that makes curves times window least, so
   data without structure come down to one curve read whole, which is exact
   search, and never cost more than that; clustered data get narrow windows on several.
4. Places are cut into blocks of ``BLOCK`` rows, and whole blocks into slabs, so
   long that a window touches at most ``SLABS`` + 1 of them.  A query goes to every
   slab its window touches, on every curve; a task multiplies the blocks of one slab, one
   after the other, by a bounded number of queries, in double precision, and
   returns each query's best of the slab: rows grow with queries, not with blocks.
5. The lists of all curves merge, without repeats, into the ``k`` best.

Scores are summed coordinate by coordinate on the original vectors, so they
don't depend on the block.  Every vector is indexed.

Defined cases: null, empty, zero or non-finite vectors and null ids take no part.
Vectors of different length never meet: each length is searched by itself.
Equal rows count once; other rows that share an id are queries and candidates
of their own, only a query's own row is left out.  Ties go to the smaller id; fewer
candidates than ``k`` are all returned; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, global_rank
from .rp_forest import unit_vectors

CURVES, DIMS, GRID_BITS, BLOCK, SLABS, TASKS, QUERIES_PER_TASK, SAMPLE_QUERIES, RECALL, SEED = 4, 6, 10, 2048, 4, 12, 4096, 128, 0.97, 89


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer grid cells (rows of ``cells``, ``bits`` bits a
    coordinate), by the transpose method."""
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for j in range(bits - 1, -1, -1):
        for row in x:
            out = (out << 1) | ((row >> j) & 1)
    return out


def _keys(dim: int, norm: float, curves: int):
    """Column function: (vector, is query) -> its Hilbert index on each curve."""
    rng = np.random.default_rng(SEED)
    planes = [np.linalg.qr(rng.standard_normal((dim + 1, min(DIMS, dim + 1))))[0] for _ in range(curves)]
    shifts = [rng.random(p.shape[1]) for p in planes]

    def keys(v: pd.Series, query: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        x = np.stack(v.to_list()).astype(float) / norm
        sizes = (x * x).sum(1)
        rest = np.where(query.to_numpy(bool), 0.0, np.sqrt(np.maximum(0.0, 1.0 - sizes)))
        scale = np.where(query.to_numpy(bool), np.sqrt(sizes), 1.0)
        x = np.column_stack([x, rest]) / scale[:, None]
        out = np.zeros((len(x), curves), np.int64)
        for c, (plane, shift) in enumerate(zip(planes, shifts)):
            z = np.clip((x @ plane) * np.sqrt(dim + 1), -4, 4)             # about standard normal
            cells = ((z + 4 + shift) / 9 * (1 << GRID_BITS)).astype(np.int64)
            out[:, c] = hilbert_index(np.minimum(cells, (1 << GRID_BITS) - 1), GRID_BITS)
        return pd.Series(list(out), dtype=object)

    return F.pandas_udf(keys, "array<long>")


def _best(queries, q_keys, items, keys, ids, k):
    """(query row, item row, score) of the k best items of each query, its own row left out."""
    take_q, take_i = [], []
    for s in range(0, len(queries), 256):
        score = queries[s:s + 256] @ items.T
        score[q_keys[s:s + 256][:, None] == keys[None, :]] = -np.inf
        n = min(k, len(keys))
        least = np.partition(score, len(keys) - n, axis=1)[:, len(keys) - n]
        # Within rounding of the last place all stay until scored exactly.
        slack = 1e-12 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        q, i = np.nonzero((score >= (least - slack)[:, None]) & np.isfinite(score))
        take_q.append(q + s)
        take_i.append(i)
    q, i = np.concatenate(take_q), np.concatenate(take_i)
    exact = np.zeros(len(q))
    for d in range(items.shape[1]):
        exact += queries[q, d] * items[i, d]
    order = np.lexsort((keys[i], ids[i], -exact, q))
    q, i, exact = q[order], i[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    ok = place < k
    return q[ok], i[ok], exact[ok]


class _Lists:
    """The ``k`` best items so far of each query of one slab."""

    def __init__(self, queries: np.ndarray, keys: np.ndarray, k: int):
        self.queries, self.keys, self.k = queries, keys, k
        self.q, self.item, self.id, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, float))

    def add(self, items: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        q, i, s = _best(self.queries, self.keys, items, keys, ids, self.k)
        q, s = np.concatenate([self.q, q]), np.concatenate([self.score, s])
        item, ids = np.concatenate([self.item, keys[i]]), np.concatenate([self.id, ids[i]])
        order = np.lexsort((item, ids, -s, q))
        order = order[np.arange(len(q)) - np.searchsorted(q[order], q[order]) < self.k]
        self.q, self.item, self.id, self.score = q[order], item[order], ids[order], s[order]

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"asked": self.keys[self.q], "key": self.item, "score": self.score})


def _met(batches, k: int, block: int):
    """Lists of a task's slabs: its rows come slab by slab, queries first, and are held a block at a time."""
    at, asked, lists, held, n = None, [], None, [], 0

    def arrays(parts):
        pdf = pd.concat(parts)
        return np.stack(pdf["v"].to_list()).astype(float), pdf["key"].to_numpy(np.int64), pdf["id"].to_numpy(np.int64)

    def flush():
        nonlocal lists, held, n
        if held and asked:
            if lists is None:
                queries, keys, _ = arrays(asked)
                lists = _Lists(queries, keys, k)
            lists.add(*arrays(held))
        held, n = [], 0

    for pdf in batches:
        for where, some in pdf.groupby(["curve", "slab", "salt"], sort=True):
            if where != at:
                flush()
                if lists is not None:
                    yield lists.rows()
                at, asked, lists = where, [], None
            query = some["part"].to_numpy() < 0
            if query.any():
                asked.append(some[query])
            some = some[~query]
            if len(some):
                held.append(some)
                n += len(some)
                if n >= block:
                    flush()
    flush()
    if lists is not None:
        yield lists.rows()


def _sample_neighbours(vectors: DataFrame, sample, k: int) -> DataFrame:
    """(asked, key): exact neighbours of a bounded sample of queries, by one pass over all rows."""
    q_keys = np.array([r["key"] for r in sample], np.int64)
    queries = np.array([r["v"] for r in sample], float)

    def task(batches):
        held = None
        for pdf in batches:
            if len(pdf):
                items, keys, ids = np.stack(pdf["v"].to_list()).astype(float), pdf["key"].to_numpy(), pdf["id"].to_numpy()
                q, i, s = _best(queries, q_keys, items, keys, ids, k)
                found = pd.DataFrame({"asked": q_keys[q], "key": keys[i], "id": ids[i], "score": s})
                held = found if held is None else (pd.concat([held, found]).sort_values(["asked", "score", "id", "key"], ascending=[True, False, True, True])
                                                   .groupby("asked").head(k))
        if held is not None:
            yield held

    found = vectors.select("key", "id", "v").mapInPandas(task, "asked long, key long, id long, score double")
    w = Window.partitionBy("asked").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("asked", "key")


def slab_length(width: int, block: int, places: int) -> int:
    """Places in a slab: whole blocks, so many that a window of this half-width touches at most ``SLABS`` + 1 slabs."""
    return block * max(1, -(-min(2 * width + 1, places) // (SLABS * block)))


def cheapest_curves(widths: list[int], block: int, places: int) -> int:
    """Number of curves, given the half-width that 1, 2 ... of them need, that reads the fewest places per query."""
    return 1 + min(range(len(widths)), key=lambda c: (c + 1) * min(2 * widths[c] + slab_length(widths[c], block, places), places))


def _search(vectors: DataFrame, dim: int, every: int, k: int, curves: int, block: int, recall: float) -> DataFrame | None:
    """(asked, key, score) lists of the vectors (key, id, v, norm) of one length, several per pair where curves share it."""
    norm = vectors.agg(F.max("norm")).first()[0]
    is_query = F.col("id") % every == 0
    n_rows, n_queries = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    if not n_queries:
        return None
    placed = vectors.select("key", "v", F.explode(F.when(is_query, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("query"))
    placed = placed.select("key", "query", F.posexplode(_keys(dim, norm, curves)("v", "query")).alias("curve", "place"))
    ranks = global_rank(placed, ["curve", "place", "key", "query"])
    places = n_rows + n_queries
    ranks = ranks.select("key", "query", "curve", (F.col("_rank") - F.col("curve") * F.lit(places)).alias("at"))

    sample = vectors.where(is_query).orderBy(F.xxhash64(F.lit(SEED), "id"), "id", "key").limit(SAMPLE_QUERIES).select("key", "v").collect()
    near = _sample_neighbours(vectors, sample, k)
    away = (near.join(ranks.where("query").select(F.col("key").alias("asked"), "curve", F.col("at").alias("here")), "asked")
            .join(ranks.where("not query").select("key", "curve", "at"), ["key", "curve"]).withColumn("away", F.abs(F.col("at") - F.col("here")))
            .groupBy("asked", "key").agg(*[F.min(F.when(F.col("curve") <= c, F.col("away"))).alias(f"w{c}") for c in range(curves)]))
    row = away.agg(*[F.percentile(f"w{c}", recall).alias(f"w{c}") for c in range(curves)]).first()
    widths = [int(np.ceil(row[f"w{c}"] or 0)) for c in range(curves)]
    used = cheapest_curves(widths, block, places)
    width = widths[used - 1]
    if used * (2 * width + slab_length(width, block, places)) >= places:    # one curve read whole costs no more
        used, width = 1, places
    ranks = ranks.where(F.col("curve") < used)

    slab = slab_length(width, block, places)
    # Queries that one slab can meet, dealt over as many tasks as needed, and over a few where there are few slabs.
    salts = max(-(-min(2 * width + slab, places) * n_queries // (n_rows * QUERIES_PER_TASK)), -(-TASKS * slab // (used * places)), 1)
    wide = vectors.select("key", "id", "v")
    asked = (ranks.where("query").withColumn("slab", F.explode(F.sequence(F.floor(F.greatest(F.col("at") - width, F.lit(0)) / slab),
                                                                          F.floor(F.least(F.col("at") + width, F.lit(places - 1)) / slab))))
             .withColumn("salt", F.pmod(F.xxhash64(F.lit(SEED), "key"), F.lit(salts)).cast("int")))
    offered = (ranks.where("not query").withColumn("slab", F.floor(F.col("at") / slab))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    # Queries come first (part -1), then the slab's blocks, one part each.
    dealt = (asked.select("curve", "slab", "salt", F.lit(-1).cast("long").alias("part"), "key")
             .unionByName(offered.select("curve", "slab", "salt", F.floor(F.col("at") / block).alias("part"), "key")).join(wide, "key")
             .repartition("curve", "slab", "salt").sortWithinPartitions("curve", "slab", "salt", "part"))

    def meet(batches):
        return _met(batches, k, block)

    return dealt.select("curve", "slab", "salt", "part", "key", "id", "v").mapInPandas(meet, "asked long, key long, score double")


def hilbert_ann(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
                curves: int = CURVES, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, ``id_col``, score): the ``k`` nearest found of every
    row whose id is divisible by ``every``, among all other rows."""
    spark = table.sparkSession
    vectors = cut(unit_vectors(table, id_col, vector_col).withColumn("key", F.monotonically_increasing_id()), "vectors")
    lengths = vectors.groupBy(F.size("v").alias("dim")).agg(F.count_if(F.col("id") % every == 0).alias("n")).where("n > 0").orderBy("dim").collect()
    parts = [_search(vectors.where(F.size("v") == r["dim"]), r["dim"], every, k, curves, block, recall) for r in lengths]
    if not parts:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    ids = vectors.select("key", "id")
    met = met.dropDuplicates(["asked", "key"]).join(ids, "key")
    w = Window.partitionBy("asked").orderBy(F.desc("score"), "id", "key")
    best = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return (best.join(ids.select(F.col("key").alias("asked"), F.col("id").alias("query_id")), "asked")
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
