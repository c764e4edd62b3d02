"""MinHash near-dedup by a multi-index Hamming join.

1. *Signatures.*  A document's set is its distinct word shingles.  ``CHUNKS *
   WIDTH`` minhashes, ``BITS`` bits each, make its signature.  Equal sets fold
   into one class first, so thousands of copies cost one row each.
2. *Multi-index join.*  The signature is cut into ``CHUNKS`` chunks of
   ``WIDTH`` values.  Two signatures that differ in at most
   ``CHUNKS * (ERRORS + 1) - 1`` values have, by pigeonhole, a chunk that
   differs in at most ``ERRORS`` values; enumerating the ways to leave out
   ``ERRORS`` values of a chunk makes that chunk an exact key.  So every pair
   under this distance meets under a key (here 21 of 66 values; 13 are expected
   to differ at a similarity of 0.8), and most pairs beyond it as well: a pair
   at exactly 0.8 misses all keys with probability 0.345 ** 11 = 8e-6.
3. *Links without all pairs.*  Under each key the most widely colliding
   document is the hub.  Each document is confirmed on full sets against the
   widest of its hubs, and links are folded into components.  Documents that
   share a key share its hub; around hubs with several components, documents
   are compared in bounded blocks inside tasks, on full sets, and only links
   between components come out.  Pairs inside a component can't change the
   answer, and no table of pairs is made.
4. Confirming uses whole shingle sets and integers: 100 * |A & B| >= 80 * |A | B|.
   A document isn't tried on a hub whose signature differs in more than ``FAR`` values.

Defined cases: null or empty text has an empty set, links with nothing and is
kept; texts shorter than one shingle use the whole sequence; rows that share a doc_id
are each judged by their own text (classes with the same smallest doc_id count
as linked); a row without doc_id links with nothing, is kept, and its component
is null; ties go to the smaller doc_id; other columns play no part.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, connected_components, cut, encoded, runs

WIDTH, CHUNKS, ERRORS, BITS, FAR = 6, 11, 1, 16, 30
SEED = 20240607
BLOCK_ROWS, BLOCK_CHARS, COLUMNS = 256, 2 << 20, 1 << 14
_C1, _C2, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one text's word hashes."""
    n = len(words)
    if n == 0:
        return words
    take = min(size, n)
    h = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        h = _mix(h * _C1 + words[i:n - take + 1 + i])
    return np.unique(h)


def _sets(texts, size, hasher):
    parts = [encoded(t).lower().split() for t in texts]     # bytes.lower() changes A-Z only
    words = hasher([w for p in parts for w in p])
    ends = np.cumsum([len(p) for p in parts])
    return [shingle_set(words[e - len(p):e], size) for p, e in zip(parts, ends)]


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(_id, n, d1, d2, sig) per row of ``docs`` (_id, _text): set size, a
    128-bit digest of the set, and the signature."""
    rng = np.random.default_rng(SEED)
    mult = rng.integers(0, 1 << 63, WIDTH * CHUNKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, WIDTH * CHUNKS, dtype=np.uint64)

    def task(batches):
        hasher = WordHasher(2)
        for pdf in batches:
            ids, texts = pdf["_id"], pdf["_text"].tolist()
            for i, j in runs(texts):
                sets = _sets(texts[i:j], size, hasher)
                n = np.array([len(s) for s in sets])
                d1, d2 = np.zeros((2, j - i), np.uint64)
                sig = np.zeros((j - i, WIDTH * CHUNKS), np.uint16)
                full = np.flatnonzero(n)
                if len(full):
                    flat = np.concatenate(sets)
                    at = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                    d1[full] = np.add.reduceat(_mix(flat), at)
                    d2[full] = np.add.reduceat(_mix(flat * _C1 + _C2), at)
                    for m in range(WIDTH * CHUNKS):
                        low = np.minimum.reduceat(flat * mult[m] + add[m], at)
                        sig[full, m] = (_mix(low) >> np.uint64(64 - BITS)).astype(np.uint16)
                yield pd.DataFrame({"_id": ids[i:j].to_numpy(), "n": n, "d1": d1.view(np.int64),
                                    "d2": d2.view(np.int64), "sig": [r.tobytes() for r in sig]})

    return docs.select("_id", "_text").mapInPandas(task, "_id long, n long, d1 long, d2 long, sig binary")


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, rep): per class, one key for each chunk and way to leave out ``ERRORS`` of its values."""
    keep = np.array(list(combinations(range(WIDTH), WIDTH - ERRORS)))

    def task(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), CHUNKS, WIDTH).astype(np.uint64)
            h = np.arange(CHUNKS * len(keep), dtype=np.uint64).reshape(CHUNKS, len(keep))[None]
            h = np.broadcast_to(h, (len(pdf), CHUNKS, len(keep)))
            for c in range(keep.shape[1]):
                h = _mix(h * _C1 + sig[:, :, keep[:, c]])
            yield pd.DataFrame({"key": h.reshape(-1).view(np.int64),
                                "rep": np.repeat(pdf["rep"].to_numpy(), CHUNKS * len(keep))})

    return classes.select("rep", "sig").mapInPandas(task, "key long, rep long")


def _near(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, dist) of the pairs whose signatures differ in at most ``FAR`` values."""

    def task(batches):
        for pdf in batches:
            if len(pdf):
                x, y = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(len(pdf), -1) for c in ("sa", "sb"))
                dist = (x != y).sum(1)
                ok = dist <= FAR
                yield pd.DataFrame({"a": pdf["a"][ok], "b": pdf["b"][ok], "dist": dist[ok].astype(np.int32)})

    return (pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
            .mapInPandas(task, "a long, b long, dist int"))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the similarity."""

    def task(batches):
        hasher = WordHasher(2)
        for pdf in batches:
            last, other, good = None, None, []
            for b, ta, tb in zip(pdf["b"], pdf["ta"], pdf["tb"]):
                if b != last:
                    last, other = b, _sets([tb], size, hasher)[0]
                mine = _sets([ta], size, hasher)[0]
                both = len(np.intersect1d(mine, other, assume_unique=True))
                union = len(mine) + len(other) - both
                good.append(union > 0 and 100 * both >= percent * union)
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    return (pairs.select("a", "b")
            .join(texts.select(F.col("_id").alias("a"), F.col("_text").alias("ta")), "a")
            .join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("tb")), "b")
            .sortWithinPartitions("b").mapInPandas(task, "a long, b long"))


def _meet(pdf: pd.DataFrame, size: int, percent: int) -> pd.DataFrame:
    """(a, b) links between different components in one pair of blocks, one for each pair of components."""
    comp = pdf["comp"].to_numpy()
    if (comp == comp[0]).all():
        return pdf.iloc[:0][["a"]].assign(b=np.zeros(0, np.int64))
    sets = _sets(pdf["_text"].tolist(), size, WordHasher(2))
    n = np.array([len(x) for x in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    shingle, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    row, column = row[seen[column] > 1], column[seen[column] > 1]       # shingles of one document alone add nothing
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        i, j = np.searchsorted(column, [start, start + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[i:j], column[i:j] - start] = 1
        both += has @ has.T                                             # whole numbers: exact below 2 ** 24
    union = n[:, None] + n[None, :] - both
    x, y = np.nonzero(np.triu((100 * both.astype(np.int64) >= percent * union.astype(np.int64)) & (union > 0), 1) & (comp[:, None] != comp[None, :]))
    out = pd.DataFrame({"a": pdf["a"].to_numpy()[x], "b": pdf["a"].to_numpy()[y], "x": np.minimum(comp[x], comp[y]), "y": np.maximum(comp[x], comp[y])})
    return out.drop_duplicates(["x", "y"])[["a", "b"]]


def _across(star: DataFrame, tested: DataFrame, folded: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links between documents that share a key, hence a hub, but no component.

    The documents around a hub are dealt out in blocks of bounded rows and
    characters, and each task compares two blocks on full sets: work for a crowd
    around one hub spreads over tasks, and no table of pairs arises."""
    around = (star.join(tested.withColumn("done", F.lit(1)), ["a", "b"], "left").select(F.col("b").alias("hub"), "a", "done")
              .union(star.select(F.col("b").alias("hub"), F.col("b").alias("a"), F.lit(None).cast("int").alias("done")).distinct()))
    around = (around.join(folded, F.col("a") == F.col("node"), "left").select("hub", "a", "done", F.coalesce("component", "a").alias("comp"))
              .join(texts.select(F.col("_id").alias("a"), F.length("_text").alias("chars")).groupBy("a").agg(F.sum("chars").alias("chars")), "a"))
    crowds = (around.groupBy("hub").agg(F.count("*").alias("n"), F.count("done").alias("done"), F.sum("chars").alias("chars"),
                                        F.min("comp").alias("x"), F.max("comp").alias("y"))
              .where("x < y and not (n = 2 and done = 1)")
              .select("hub", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("chars") / BLOCK_CHARS)).cast("int").alias("blocks")))
    dealt = (around.join(crowds, "hub").withColumn("own", F.pmod(F.xxhash64(F.lit(SEED), "a", "hub"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", "a", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
             .join(texts.select(F.col("_id").alias("a"), "_text"), "a"))
    return dealt.groupBy("hub", "i", "j").applyInPandas(lambda pdf: _meet(pdf, size, percent), "a long, b long")


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 5, percent: int = 80) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept), one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    signed = cut(signatures(rows, shingle), "signed")
    classes = cut(signed.where("n > 0 and _id is not null").groupBy("n", "d1", "d2")
                  .agg(F.min("_id").alias("rep"), F.any_value("sig").alias("sig")), "classes")
    keys = index_keys(classes)
    crowded = keys.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    met = cut(keys.join(crowded, "key"), "met")                   # only keys that two classes share
    reach = met.groupBy("rep").agg(F.sum("crowd").alias("reach"))
    wanted = reach.select(F.col("rep").alias("_id"))
    texts = cut(rows.join(wanted, "_id", "left_semi"), "texts")

    hubs = met.join(reach, "rep").groupBy("key").agg(F.max_by("rep", F.struct("reach", -F.col("rep"))).alias("b"))
    star = cut(met.join(hubs, "key").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct(), "star")
    widest = cut(_near(star, classes).join(reach.select(F.col("rep").alias("b"), "reach"), "b")
                 .groupBy("a").agg(F.max_by("b", F.struct("reach", -F.col("b"))).alias("b")), "widest")
    links = cut(_confirmed(widest, texts, shingle, percent), "links")
    more = _across(star, widest, connected_components(links), texts, shingle, percent)
    nodes = connected_components(cut(links.union(more), "links"))

    of = (signed.select("_id", "n", "d1", "d2")
          .join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "left")
          .join(nodes, F.col("rep") == F.col("node"), "left")
          .select("_id", "n", F.when(F.col("_id").isNotNull(), F.coalesce("component", "rep", "_id")).alias("component_id")))
    return of.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                     F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less all but one row of each near-duplicate group.

    Rows are judged one by one, whatever their ids: of a group stays the row
    with the smallest id (null last), of equal ids the one with the least text
    hash, of equal rows the first written.  Rows without words all stay."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = cut(docs.withColumn(key, F.monotonically_increasing_id()), "rows")       # numbered once, hence written
    judged = minhash_dedup(rows.select(F.col(key).alias("row"), F.col(text_col).alias("t")), "row", "t", shingle, percent)
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(key).alias("row"))
    judged = judged.where("n_shingles > 0").select("row", "component_id").join(rows.select(place.alias("place"), F.col(key).alias("row")), "row")
    first = judged.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = judged.join(first.select("component_id", F.col("first.row").alias("stays")), "component_id").where("row <> stays")
    return rows.join(gone.select(F.col("row").alias(key)), key, "left_anti").select(*docs.columns)
