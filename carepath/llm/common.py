"""Helpers shared by the corpus operators: written intermediate tables,
global ranks over a total order, connected components, tokenising."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carepath.session import ensure_checkpoint_dir

#: Words of the corpus contracts: runs of anything but space and \x09-\x0D.
#: ``bytes.split()`` cuts at exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def free_shuffles(spark: SparkSession) -> None:
    """The shuffle files behind a written table serve no one any more; Spark
    deletes them once the driver's collector has seen that."""
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete written tables of ``cut`` that no later step reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(col) -> "F.Column":
    """Number of words of a text column (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def global_rank(df: DataFrame, cols: list[str], out: str = "_rank") -> DataFrame:
    """Add the row's 0-based position in the total order of ``cols``.

    Rows are range-partitioned and sorted (never gathered in one task); the
    sorted table is written once, and each partition's offset is a running
    sum over one row per partition.  ``cols`` must order the rows totally,
    else equal rows get their positions in any order.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    # The low 33 bits of the id count the rows of the partition; the high bits number it.
    part = cut(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
               .withColumn("_mid", F.monotonically_increasing_id()), "rank")
    scratch = part._scratch
    part = part.withColumns({"_pid": F.shiftrightunsigned("_mid", 33), "_pos": F.col("_mid").bitwiseAND((1 << 33) - 1)})
    sizes = part.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    ranked = (part.join(F.broadcast(offsets), "_pid")    # as many rows as shuffle partitions
              .withColumn(out, F.col("_off") + F.col("_pos")).drop("_pid", "_mid", "_pos", "_off"))
    ranked._scratch = scratch                            # for ``discard``
    return ranked


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``a``, ``b``),
    component = smallest node reachable.

    Alternating large-star / small-star rounds: every vertex hands its
    neighbours to the smallest one it knows.  Only minima are aggregated
    (map-side), so a hub costs one aggregate row per task, and the joins are
    plain sort-merge joins whose large partitions AQE may split (a hint, where
    Spark would go by the size of a file, which is far below that of its rows).
    Each round is written and reread.
    """
    spark = edges.sparkSession
    cur = cut(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")

    def signature(e: DataFrame):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    last = signature(cur)
    for _ in range(max_rounds):
        # large star: u's larger neighbours point to the least of u and its neighbours
        sym = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: u (the larger end) and its smaller neighbours point to the least of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2.hint("merge"), "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        old, cur = cur, cut(small, "cc")
        discard(old)
        now = signature(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    stars = cur.groupBy("u").agg(F.min("v").alias("component"))
    roots = stars.select(F.col("component").alias("node")).distinct()
    return (stars.select(F.col("u").alias("node"), "component")
            .union(roots.select("node", F.col("node").alias("component"))))


# --- tokenising inside tasks -------------------------------------------------

#: Texts of a batch are handled in runs of about this many bytes.
RUN_BYTES = 1 << 21


class WordHasher:
    """64-bit hashes of words, remembered per task up to ``limit`` words."""

    def __init__(self, seed: int = 0, limit: int = 1 << 19):
        self.seed, self.limit, self.known = seed, limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, seed = self.known, self.seed
        if len(known) > self.limit:
            known.clear()
        digest = xxhash.xxh3_64_intdigest
        for w in set(words).difference(known):
            known[w] = digest(w, seed)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def runs(texts, limit: int = RUN_BYTES):
    """Slices of ``texts`` (list of str or None) of about ``limit`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
