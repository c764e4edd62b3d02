"""Hard-negative mining with lists shared by clusters of anchors.

1. Components become integers (floor of 256 x), so scores are exact integer
   inner products.
2. Anchors are grouped by spherical k-means (centres from a bounded sample of
   them); a cluster knows the widest angle between its centre and a member.
3. For each cluster all rows are sorted once by an upper bound of their score
   with any member of length 1: their length times the cosine of their angle
   to the centre less that widest angle.  The list holds ids and bounds only,
   is sorted over range partitions and cut into pages of ``PAGE`` rows.
4. Every member walks its cluster's list from the top, in rounds of 1, 2, 4 ... pages.
   It stops where the bound of the next page times its own length is below what it
   still needs, which certifies that no later row can matter.  A page meets the
   members that ask for it in blocks of ``MEMBERS_PER_TASK``, by one matrix product.
5. The first walk finds the ``positives`` best rows of the anchor's label.
   Their scores set bands for negatives, and the second walk finds the best
   rows of other labels within each band.

A bound never depends on the data's shape: vectors without structure are walked
to the end, which is exact search; clustered vectors stop early.

Defined cases: rows with a null id or label, and vectors that are null, empty
or hold null or non-finite components, take no part; zero vectors do.
Components saturate at 2^24 after scaling.  Vectors of different length never
meet.  Repeated rows (same id, label and integers) count once; other rows that
share an id are rows of their own.  Ties go to the smaller id, then to a hash
of the row.  Fewer rows than asked for are all returned; an anchor without
another row of its label gives none.  Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard, global_rank

SCALE, LIMIT, SEED = 256, 1 << 24, 101
CLUSTER_MEMBERS, MAX_CLUSTERS, SAMPLE_ANCHORS, CENTRE_ROUNDS = 128, 64, 4096, 8
PAGE, MEMBERS_PER_TASK = 4096, 1024
SLACK, ANGLE_SLACK = 1e-9, 1e-7                                # of a bound and of an angle, for rounding


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str, shift_every: int, labels: int) -> DataFrame:
    """(id, tie, label, q, norm) of the rows that take part, each once; where
    the id is divisible by ``shift_every`` the label is the next of ``labels``."""
    wide = F.col("v").cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).cast("long").alias("label"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
                      & F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    whole = F.transform(wide, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    rows = rows.select("id", F.when(F.col("id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")).alias("label"),
                       whole.alias("q"))
    rows = rows.withColumn("tie", F.xxhash64("label", "q")).dropDuplicates(["id", "label", "q"])
    squares = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return rows.select("id", "tie", "label", "q", F.sqrt(squares).alias("norm"))


def cluster_centres(sample: list, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Unit centres per vector length, by a few rounds of spherical k-means."""
    rng = np.random.default_rng(SEED)
    out = {}
    for dim in sorted(counts):
        x = np.array([r["q"] for r in sample if len(r["q"]) == dim], float).reshape(-1, dim)
        x = x[(x != 0).any(1)]
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        k = min(MAX_CLUSTERS, -(-counts[dim] // CLUSTER_MEMBERS), max(1, len(x)))
        centres = x[rng.permutation(len(x))[:k]] if len(x) else np.eye(1, dim)
        for _ in range(CENTRE_ROUNDS if len(x) else 0):
            near = (x @ centres.T).argmax(1)
            for j in range(len(centres)):
                total = x[near == j].sum(0)
                if np.linalg.norm(total) > 0:
                    centres[j] = total / np.linalg.norm(total)
        out[dim] = centres
    return out


def _angles(q: pd.Series, centres: dict[int, np.ndarray]):
    """Per vector length: (rows, norms, angles to its centres, number of its first cluster)."""
    sizes = q.map(len).to_numpy()
    first = 0
    for dim, c in centres.items():
        at = np.flatnonzero(sizes == dim)
        if len(at):
            x = np.stack(q.iloc[at].to_list()).astype(float)
            norm = np.linalg.norm(x, axis=1)
            cosine = (x @ c.T) / np.where(norm > 0, norm, 1.0)[:, None]
            yield at, norm, np.arccos(np.clip(cosine, -1, 1)), first
        first += len(c)


def _membership(centres):
    """Column function: integers -> (cluster, angle to its centre)."""
    def assign(q: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"cluster": np.full(len(q), -1, np.int32), "angle": np.zeros(len(q))})
        for at, norm, angles, first in _angles(q, centres):
            near = angles.argmin(1)
            out.loc[at, "cluster"] = (first + near).astype(np.int32)
            out.loc[at, "angle"] = np.where(norm > 0, angles[np.arange(len(at)), near], 0.0)
        return out

    return F.pandas_udf(assign, "cluster int, angle double")


def _bounds(centres, widest: dict[int, float]):
    """Column function: integers -> (cluster, bound) for every cluster of this vector length that has members."""
    def bound(q: pd.Series) -> pd.Series:
        out = [[] for _ in range(len(q))]
        for at, norm, angles, first in _angles(q, centres):
            for j in range(angles.shape[1]):
                if first + j in widest:
                    most = norm * np.cos(np.maximum(0.0, angles[:, j] - widest[first + j] - ANGLE_SLACK))
                    for i, b in zip(at.tolist(), (most + SLACK * norm).tolist()):
                        out[i].append({"cluster": first + j, "bound": b})
        return pd.Series(out, dtype=object)

    return F.pandas_udf(bound, "array<struct<cluster:int,bound:double>>")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products as doubles where they fit, else as long integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return a.astype(float) @ b.astype(float).T if most < 1 << 52 else a @ b.T


def _best(score: np.ndarray, ok: np.ndarray, k: int):
    """(row, column) of each row's ``k`` best allowed columns; equal scores in column order."""
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.where(ok, score, np.iinfo(np.int64).min if score.dtype.kind == "i" else -np.inf)
    n = min(k, s.shape[1])
    least = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
    r, c = np.nonzero((s >= least[:, None]) & ok)
    order = np.lexsort((c, -s[r, c], r))
    r, c = r[order], c[order]
    first = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[first], c[first]


_FOUND = "a_id long, a_tie long, band int, id long, tie long, score long"


def _meet(k: int, same_label: bool):
    """applyInPandas function: members and rows of one page -> each member's best."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        member = pdf["member"].to_numpy(bool)
        mine, rows = pdf[member], pdf[~member].sort_values(["id", "tie"])
        out = []
        if len(mine) and len(rows):
            score = _products(np.stack(mine["q"].to_list()).astype(np.int64), np.stack(rows["q"].to_list()).astype(np.int64))
            alike = mine["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]
            if same_label:
                own = ((mine["id"].to_numpy()[:, None] == rows["id"].to_numpy()[None, :])
                       & (mine["tie"].to_numpy()[:, None] == rows["tie"].to_numpy()[None, :]))
                bands = [(0, alike & ~own)]
            else:                                               # bands as whole numbers: low <= score <= high
                most = max(map(len, mine["low"]))               # members with fewer bands have empty ones
                low, high = (np.array([[*x] + [pad] * (most - len(x)) for x in mine[c]], np.int64).reshape(len(mine), most)
                             for c, pad in (("low", 1), ("high", 0)))
                bands = [(j, ~alike & (score >= low[:, j:j + 1]) & (score <= high[:, j:j + 1])) for j in range(low.shape[1])]
            for band, ok in bands:
                r, c = _best(score, ok, k)
                out.append(pd.DataFrame({"a_id": mine["id"].to_numpy()[r], "a_tie": mine["tie"].to_numpy()[r], "band": np.int32(band),
                                         "id": rows["id"].to_numpy()[c], "tie": rows["tie"].to_numpy()[c], "score": score[r, c].astype(np.int64)}))
        if not out:
            return pd.DataFrame({c.split()[0]: pd.Series([], dtype="int32" if c.endswith("int") else "int64") for c in _FOUND.split(", ")})
        return pd.concat(out)

    return meet


def _walk(rows: DataFrame, listed: DataFrame, starts: DataFrame, members: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Best ``k`` rows per member and band: rounds over the pages of its list,
    until no member's next page can hold a row that it needs.  ``members`` has
    ``floors``, per band the least score of use (null: none)."""
    spark = rows.sparkSession
    best = cut(spark.createDataFrame([], _FOUND), "best")
    lo, width = 0, 1
    order = Window.partitionBy("a_id", "a_tie", "band").orderBy(F.desc("score"), "id", "tie")
    while True:
        # What a member still needs: in each band its k-th best so far, or the band's floor.
        kth = best.groupBy("a_id", "a_tie", "band").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k)
        kth = kth.groupBy("a_id", "a_tie").agg(F.map_from_entries(F.collect_list(F.struct("band", "s"))).alias("have"))
        need = F.array_min(F.transform("floors", lambda f, j: F.greatest(f, F.col("have")[j].cast("double"))))
        wanting = (members.select(F.col("id").alias("a_id"), F.col("tie").alias("a_tie"), "cluster", "block", "norm", "floors")
                   .join(kth, ["a_id", "a_tie"], "left").select("a_id", "a_tie", "cluster", "block", "norm", need.alias("need")))
        reach = F.col("bound") * F.col("norm")
        asked = cut(wanting.join(starts.where(F.col("page").between(lo, lo + width - 1)), "cluster")
                    .where(F.col("need").isNotNull() & (reach + F.abs(reach) * SLACK + SLACK >= F.col("need")))
                    .select("cluster", "page", "block", "a_id", "a_tie"), "asked")
        if asked.isEmpty():
            discard(asked)
            return best
        own = members.select(F.col("id").alias("a_id"), F.col("tie").alias("a_tie"), "label", "q", "low", "high")
        askers = asked.join(own, ["a_id", "a_tie"]).select("cluster", "page", "block", F.lit(True).alias("member"), F.col("a_id").alias("id"),
                                                           F.col("a_tie").alias("tie"), "label", "q", "low", "high")
        none = F.lit(None).cast("array<long>")
        offered = (listed.join(asked.select("cluster", "page", "block").distinct(), ["cluster", "page"]).join(rows, ["id", "tie"])
                   .select("cluster", "page", "block", F.lit(False).alias("member"), "id", "tie", "label", "q", none.alias("low"), none.alias("high")))
        found = askers.unionByName(offered).groupBy("cluster", "page", "block").applyInPandas(_meet(k, same_label), _FOUND)
        after = cut(best.unionByName(found).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n"), "best")
        discard(best, asked)
        best, lo, width = after, lo + width, 2 * width


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50,
                   shift_every: int = 7, labels: int = 10, positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row whose id is divisible by ``every`` and each
    of its best rows of the same label, the best rows of other labels that
    score between the two percentages of ``band`` of it."""
    spark = table.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = cut(integer_vectors(table, id_col, vector_col, label_col, shift_every, labels), "rows")
    anchors = rows.where(F.col("id") % every == 0)
    counts = {r["dim"]: r["n"] for r in anchors.groupBy(F.size("q").alias("dim")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], empty)
    sample = anchors.orderBy(F.xxhash64(F.lit(SEED), "id", "tie"), "id", "tie").limit(SAMPLE_ANCHORS).select("q").collect()
    centres = cluster_centres(sample, counts)
    placed = cut(anchors.withColumn("_m", _membership(centres)("q")).select("*", "_m.*").drop("_m"), "anchors")
    clusters = placed.groupBy("cluster").agg(F.max("angle").alias("widest"), F.count("*").alias("n")).collect()   # MAX_CLUSTERS a vector length
    blocks = F.create_map(*[F.lit(x) for r in clusters for x in (r["cluster"], -(-r["n"] // MEMBERS_PER_TASK))])[F.col("cluster")]
    members = (placed.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "id", "tie"), blocks).cast("int"))
               .withColumns({"low": F.array().cast("array<long>"), "high": F.array().cast("array<long>"),
                             "floors": F.array(F.lit(float("-inf")))}))

    # The shared lists, sorted once.
    bounds = _bounds(centres, {r["cluster"]: r["widest"] for r in clusters})
    entries = rows.where(F.size("q").isin(list(counts))).select("id", "tie", F.inline(bounds("q")))
    ranked = global_rank(entries.withColumn("_down", -F.col("bound")), ["cluster", "_down", "id", "tie"])
    first = ranked.groupBy("cluster").agg(F.min("_rank").alias("_first"))                          # a row per cluster
    listed = cut(ranked.join(F.broadcast(first), "cluster")
                 .select("cluster", F.floor((F.col("_rank") - F.col("_first")) / PAGE).cast("int").alias("page"), "id", "tie", "bound"), "lists")
    starts = cut(listed.groupBy("cluster", "page").agg(F.max("bound").alias("bound")), "pages")

    found = _walk(rows, listed, starts, members, positives, True)
    place = Window.partitionBy("a_id", "a_tie").orderBy(F.desc("score"), "id", "tie")
    liked = found.select("a_id", "a_tie", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                         (F.row_number().over(place) - 1).alias("band"))
    # Bands in whole numbers: 100 * low >= band[0] * positive, 100 * high <= band[1] * positive.
    rest = F.pmod("positive_score", F.lit(100))
    hundreds = F.expr("(positive_score - pmod(positive_score, 100)) div 100")
    limits = liked.select("a_id", "a_tie", "band", (hundreds * band[0] + F.ceil(rest * band[0] / 100)).alias("low"),
                          (hundreds * band[1] + F.floor(rest * band[1] / 100)).alias("high"))
    pick = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("band", c))), lambda x: x[c])
    limits = limits.groupBy("a_id", "a_tie").agg(pick("low").alias("low"), pick("high").alias("high"))
    floors = F.transform(F.arrays_zip("low", "high"), lambda x: F.when(x["low"] <= x["high"], x["low"].cast("double")).otherwise(float("inf")))
    seekers = cut(members.drop("low", "high", "floors").join(limits, (F.col("id") == F.col("a_id")) & (F.col("tie") == F.col("a_tie")))
                  .drop("a_id", "a_tie").withColumn("floors", floors), "seekers")
    hard = _walk(rows, listed, starts, seekers, negatives, False)
    rank = F.row_number().over(Window.partitionBy("a_id", "a_tie", "band").orderBy(F.desc("score"), "id", "tie"))
    return (hard.withColumn("rank", rank).join(liked, ["a_id", "a_tie", "band"])
            .select(F.col("a_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
