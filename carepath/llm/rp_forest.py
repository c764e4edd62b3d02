"""Embedding near-dedup by a random-projection tree forest.

1. Equal vectors fold into one row with a count.
2. Every vector length has trees of its own.  Each tree has its own random directions, one per level.  A node splits its
   rows at a sparse one of a few quantiles of their projection (one mergeable
   sketch per node); rows within the spill (``SPILL`` of the spread that a pair
   at the least cosine has along a direction) of the split go to both sides.  A
   node stops when it has ``LEAF`` rows or fewer, or when the two sides of no
   split would have fewer pairs than the node: a dense knot of near copies
   stays whole and is compared exactly.  A leaf's rows are written once, when it closes.
3. Rows are compared within leaves, in blocks: a leaf of any size is dealt out
   in blocks of about ``BLOCK`` rows, and each task compares two blocks by
   matrix products in double precision.  A pair that shares several leaves is
   counted in the first of them only, found from the rows' own lists of leaves;
   so counts need no table of pairs, and a task returns one count per row and a
   spanning set of links.
4. Counts are summed and links joined into components.

Tables of about a row a vector are joined by sorting, as the hints say: their
files are so much smaller than their rows (a list of leaves: 40 bytes in the
file of memberships, 370 once broadcast) that Spark, which goes by files, would
send them through the driver.

With vectors scaled to length 1, a pair at cosine 0.95 is 0.316 apart, its
projections differ by N(0, 0.316 ** 2 / dim); a tree parts it with a
probability of some percent per level, ``TREES`` trees all part it hardly ever
(tests measure recall 1 on planted near copies, also in knots of thousands of
them that are split at no level).

Defined cases: null, empty, zero or non-finite vectors link with nothing and are
kept; vectors of different length never link; a null id links with nothing, is kept and has a null component.
Equal rows count once.  Rows that share an id but not the vector are vectors of
their own: each has its links, also with one another, and its component.  Ties
go to the smaller id; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, discard

TREES, DEPTH, LEAF, BLOCK, SPILL, SEED = 8, 24, 4096, 2048, 0.76, 83      # a spill of 0.03 at cosine 0.95 in 64 dimensions
STEPS = [x / 20 for x in range(4, 17)]      # quantiles a split is chosen from


def unit_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, norm) of the rows whose vectors can link, equal rows once."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    wide = F.col("v").cast("array<double>")
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.withColumn("norm", norm).where("norm > 0 and norm < double('infinity')")
    return rows.groupBy("id", "v").agg(F.first("norm").alias("norm"))


def _project(trees: int, depth: int):
    """Column function: unit vector -> its projections, ``depth`` per tree."""
    known: dict[int, np.ndarray] = {}

    def directions(dim):
        if dim not in known:
            known[dim] = np.random.default_rng(SEED).standard_normal((dim, trees * depth))
            known[dim] /= np.linalg.norm(known[dim], axis=0)
        return known[dim]

    def project(v: pd.Series) -> pd.Series:
        out = np.zeros((len(v), trees * depth), np.float32)
        sizes = v.map(len).to_numpy()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            x = np.stack(v.iloc[at].to_list()).astype(float)
            out[at] = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ directions(int(dim))
        return pd.Series(list(out), dtype=object)

    return F.pandas_udf(project, "array<float>")


def grow(points: DataFrame, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, spread: float = 0.24) -> DataFrame:
    """(key, tree, path) memberships of ``points`` (key, v); a leaf is (tree,
    path), and tree t of vectors of length d has the number d * ``trees`` + t.
    Rows within ``spread`` / sqrt(d) of a split go to both sides."""
    projected = points.select("key", F.size("v").alias("dim"), _project(trees, depth)("v").alias("p"))
    split_up = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.slice("p", t * depth + 1, depth))).alias("t", "p")
    open_rows = cut(projected.select("key", "dim", split_up)
                    .select("key", (F.col("dim") * trees + F.col("t")).alias("tree"), F.lit(1).cast("long").alias("path"), "p"), "forest")
    written, closed = [open_rows], []
    spill = F.lit(spread) / F.sqrt(F.floor(F.col("tree") / trees))
    for level in range(depth):
        x = F.get("p", F.lit(level)).cast("double")
        nodes = open_rows.groupBy("tree", "path").agg(F.count("*").alias("n"), F.percentile_approx(x, STEPS, 2000).alias("q")).withColumn("_s", spill)
        # The split: the quantile whose sides have the fewest pairs.  If that's no fewer than the node has, the node stays whole.
        share = lambda rows: F.when(rows < len(STEPS), STEPS[0] + 0.05 * rows).otherwise(1.0)
        pairs = lambda y: (F.pow(share(F.size(F.filter("q", lambda z: z < y + F.col("_s")))), 2)
                           + F.pow(share(F.size(F.filter("q", lambda z: z > y - F.col("_s")))), 2))
        choice = F.array_min(F.array(*[F.struct(pairs(F.get("q", F.lit(i))).alias("pairs"), F.get("q", F.lit(i)).alias("at")) for i in range(len(STEPS))]))
        nodes = nodes.where(F.col("n") > leaf).select("tree", "path", "_s", choice.alias("c")).where("c.pairs < 1").select("tree", "path", "_s", "c.at")
        sides = F.filter(F.array(F.when(x < F.col("at") + F.col("_s"), F.col("path") * 2), F.when(x > F.col("at") - F.col("_s"), F.col("path") * 2 + 1)),
                         lambda side: side.isNotNull())
        split = F.col("at").isNotNull()
        after = cut(open_rows.join(nodes, ["tree", "path"], "left")
                    .select("key", "tree", F.explode(F.when(split, sides).otherwise(F.array("path"))).alias("path"),
                            F.when(split, F.col("p")).alias("p")), "forest")
        written.append(after)
        closed.append(after.where("p is null").select("key", "tree", "path"))       # a leaf's rows stay in this level's table
        open_rows = after.where("p is not null")
        if open_rows.isEmpty():
            break
    else:
        closed.append(open_rows.select("key", "tree", "path"))
    out = closed[0]
    for part in closed[1:]:
        out = out.unionByName(part)
    out._written = written
    return out


def _compare(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Counts and spanning links of one pair of blocks of a leaf."""
    first = pdf["side"].to_numpy()
    x = np.stack(pdf["v"].to_list()).astype(float)
    norm, ids, copies = pdf["norm"].to_numpy(), pdf["id"].to_numpy(), pdf["copies"].to_numpy()
    here = int(pdf["leaf"].iloc[0])
    a, b = np.flatnonzero(first), np.flatnonzero(~first)
    if not len(b):                                        # a block with itself
        b = a
    link = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= cosine
    link &= ids[a][:, None] != ids[b][None, :]
    counts = np.zeros(len(ids), np.int64)
    edges = []
    if link.any():
        hit_a, hit_b = link.any(1), link.any(0)
        a, b, link = a[hit_a], b[hit_b], link[np.ix_(hit_a, hit_b)]
        # Leaves that come before this one and hold rows of either side.
        lists = pdf["leaves"].to_list()
        number: dict[int, int] = {}
        sets = [[number.setdefault(int(y), len(number)) for y in lists[i] if y < here] for i in np.concatenate([a, b])]
        if number:
            has = np.zeros((len(sets), len(number)), np.float32)
            for i, s in enumerate(sets):
                has[i, s] = 1
            fresh = link & ~((has[:len(a)] @ has[len(a):].T) > 0)
        else:
            fresh = link
        np.add.at(counts, a, fresh @ copies[b])
        if not first[b].any():
            np.add.at(counts, b, fresh.T @ copies[a])
        # Spanning links: sweep over the rows, joining what each one touches.
        root = np.arange(len(ids))
        for i, row in zip(a, link):
            for r in np.unique(root[b[row]]):
                if r != root[i]:
                    edges.append((ids[r], ids[i]))
                    root[root == r] = root[i]
    kept = np.flatnonzero(counts)
    out = pd.DataFrame({"id": ids[kept], "n": counts[kept], "b": pd.array([None] * len(kept), dtype="Int64")})
    if edges:
        e = pd.DataFrame(edges, columns=["id", "b"])
        out = pd.concat([out, pd.DataFrame({"id": e["id"], "n": 0, "b": e["b"].astype("Int64")})])
    return out


def rp_forest_dedup(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
                    trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, spill: float = SPILL) -> DataFrame:
    """(``id_col``, n_links, component_id, kept), one row per row of ``table``."""
    # Equal vectors: one row with a key of its own; the smallest id stands for all of them.
    folded = unit_vectors(table, id_col, vector_col).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("norm").alias("norm"))
    folded = cut(folded.withColumn("key", F.monotonically_increasing_id()), "vectors")
    grown = grow(folded.select("key", "v"), trees, spread=spill * (2 * (1 - cosine)) ** 0.5, leaf=leaf)
    members = cut(grown.withColumn("leaf", F.xxhash64("tree", "path")), "members")
    discard(*grown._written)
    sizes = members.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1")
    lists = members.groupBy("key").agg(F.collect_set("leaf").alias("leaves"))                  # at most the leaves of one vector
    rows = members.join(sizes, "leaf").join(lists.hint("merge"), "key").join(folded.select("key", "v", "norm", "copies").hint("merge"), "key")
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64(F.lit(SEED), "key", "leaf"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = rows.select(F.col("key").alias("id"), "v", "norm", "copies", "leaf", "leaves", F.least("own", "other").alias("i"),
                        F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("side"))
    found = cut(dealt.groupBy("leaf", "i", "j").applyInPandas(lambda pdf: _compare(pdf, cosine), "id long, n long, b long"), "links")
    counts = found.groupBy(F.col("id").alias("key")).agg(F.sum("n").alias("n"))
    nodes = connected_components(found.where("b is not null").select(F.col("id").alias("a"), "b")).withColumnRenamed("node", "key")
    least = nodes.hint("merge").join(folded.select("key", "rep"), "key").groupBy("component").agg(F.min("rep").alias("c"))
    nodes = nodes.join(least.hint("merge"), "component").select("key", "c")         # here, as most vectors are in no component
    known = (folded.select("v", "key", "rep", "copies").join(counts.hint("merge"), "key", "left").join(nodes.hint("merge"), "key", "left")
             .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "rep").alias("c")))
    every = table.select(F.col(id_col).cast("long").alias("id"), F.when(F.col(id_col).isNotNull(), F.col(vector_col)).alias("v"))
    return (every.join(known, "v", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"),
                    F.coalesce(F.col("id") == F.coalesce("c", "id"), F.lit(True)).alias("kept")))
