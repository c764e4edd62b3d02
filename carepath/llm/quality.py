"""Quality classifier: linear hinge loss on n-gram indicators scaled by naive
Bayes log-count ratios.

1. A text is the set of its n-grams, hashed into ``BUCKETS`` indicators: of
   bytes (1 to 3), of words (1 and 2), of word shapes (1 to 3) and of lines (1
   to 3).  A word's shape is the kinds of characters it has, how far back the
   same word stood and whether the same pair of words stood before; a line's
   is whether it was seen before.  So repetition counts in words never met.
2. How many labelled documents of each class hold an indicator is counted in
   Spark over labelled rows outside the held-out fold, at most ``MAX_COUNTED`` of each
   class; the log of the ratio of both classes' shares scales the indicator.  The
   ids of these rows are broadcast (bounded by that), so texts aren't shuffled.
3. A hinge-loss model on the scaled indicators (each document at length 1) is
   fitted by dual coordinate descent on a sample of at most ``MAX_GOOD`` +
   ``MAX_BAD`` of these of at most ``MAX_FIT_CHARS`` characters, on the driver.
   Both classes weigh the same.  All samples are the rows with the least id hashes.
4. Margins become scores by a logistic curve, fitted to margins that two
   models, each trained on half of the sample, give the other half.
5. Every whole text is scored in tasks that hold two numbers per bucket (2 MB).

Defined cases: null and empty texts have no indicators and get the score of the
bare bias; without labelled rows of both classes every score is the share of label 1 among the
rows learnt from (0.5 without any); of repeated labels the larger counts; rows that
share an id all count and are all scored, one of them (by text hash) may enter the sample; null
ids are scored and not held out; other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, encoded

BITS = 18
BUCKETS, BYTE_GRAMS, SHAPE_GRAMS, LINE_GRAMS = 1 << BITS, 3, 3, 3
MAX_COUNTED, MAX_GOOD, MAX_BAD, MAX_FIT_CHARS = 50_000, 3000, 3000, 20_000
COST, EPOCHS, SLICE, SEED, THRESHOLD = 1.0, 20, 1 << 20, 97, 0.3
_MUL = np.uint32(0x9E3779B1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK_ODD = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KIND = np.full(256, 2, np.uint8)                               # letters, and all bytes beyond ASCII
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 4
_FAR = np.array([0, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 5], np.uint32)     # how far back: 1, 2-3, 4-7, 8-15, more
_KIND[[*range(0x21), 0x7F]] = 0
_KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 8


def _bucket(codes: np.ndarray, stream: int) -> np.ndarray:
    """Hash buckets of the 32-bit codes of one stream of n-grams."""
    h = codes * _MUL + np.uint32(stream * 0x85EBCA6B & 0xFFFFFFFF)
    h ^= h >> np.uint32(15)
    h *= _MUL
    h >>= np.uint32(32 - BITS)
    return h


def _back(codes: np.ndarray) -> np.ndarray:
    """Distance to the entry's last occurrence before (0: none)."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    hit = np.flatnonzero(ranked[1:] == ranked[:-1])
    same = np.zeros(len(codes), np.int64)
    same[order[hit + 1]] = order[hit + 1] - order[hit]
    return same


class Indicators:
    """text -> rising buckets of its n-grams.  Texts beyond ``SLICE`` bytes are
    read in slices that end at a space, where there is one."""

    def __init__(self):
        self.flag = np.zeros(BUCKETS, bool)
        # Powers of an odd number and of its inverse (modulo 2^64): hashes of all words from one running sum.
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        data = encoded(text)
        start = 0
        while start < len(data):
            end = start + SLICE
            if end < len(data):
                end = max(data.rfind(b" ", start + 1, end), data.rfind(b"\n", start + 1, end)) + 1 or end
            self._slice(np.frombuffer(data[start:end + BYTE_GRAMS - 1], np.uint8), min(end, len(data)) - start)
            start = end
        eight = np.flatnonzero(self.flag.view(np.uint64))       # eight flags at a time
        at, low = np.nonzero(self.flag.reshape(-1, 8)[eight])
        out = eight[at] * 8 + low
        self.flag[out] = False
        return out

    def _slice(self, buf, size):
        self._grams(buf.astype(np.uint32), 8, BYTE_GRAMS, 1)
        buf = buf[:size]
        if size >= len(self.power):
            n = min(2 * size, SLICE) + 1
            self.power, self.inverse = np.full(n, _ODD), np.full(n, _BACK_ODD)
            for x in (self.power, self.inverse):
                x[0] = 1
                np.cumprod(x, out=x)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.power[:size], out=sums[1:])

        def pieces(mask):
            """(starts, ends, hashes) of the runs where ``mask`` holds."""
            edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
            first, last = edge[::2], edge[1::2]
            h = (sums[last] - sums[first]) * self.inverse[first]
            h ^= h >> np.uint64(29)
            return first, last, h * _ODD

        first, last, h = pieces(~_SPACE[buf])
        if not len(h):
            return
        pair = (h[:-1] >> np.uint64(1)) + h[1:] * _ODD
        self.flag[_bucket((h >> np.uint64(32)).astype(np.uint32), 2)] = True
        self.flag[_bucket((pair >> np.uint64(32)).astype(np.uint32), 3)] = True
        kinds = np.bitwise_or.reduceat(_KIND[buf], first).astype(np.uint32)       # white space has no kind
        far = _FAR[np.minimum(_back(h), 16)]
        again = np.zeros(len(h), np.uint32)
        again[1:] = _back(pair) > 0
        self._grams(kinds | (far << np.uint32(4)) | (again << np.uint32(7)), 8, SHAPE_GRAMS, 5)
        lines = pieces(buf != 10)[2]
        self._grams((_back(lines) > 0).astype(np.uint32), 1, LINE_GRAMS, 4)

    def _grams(self, symbols, bits, most, stream):
        """Mark the n-grams of a sequence of symbols, n from 1 to ``most``."""
        code = symbols
        for n in range(1, min(most, len(symbols)) + 1):
            if n > 1:
                code = (code[:-1] << np.uint32(bits)) | symbols[n - 1:]
            self.flag[_bucket(code, 8 * stream + n)] = True


def held_out(id_col: str) -> "F.Column":
    """The fold no label is learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- fitting -------------------------------------------------------------------------

def log_count_ratios(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ratio per bucket, documents per class) of ``rows`` (_text, _y)."""

    def task(batches):
        indicators, held, n = Indicators(), np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for pdf in batches:
            for text, y in zip(pdf["_text"], pdf["_y"]):
                held[y, indicators(text)] += 1
                n[y] += 1
        at = np.flatnonzero(held.any(0))
        yield pd.DataFrame({"bucket": at, "bad": held[0, at], "good": held[1, at]})
        yield pd.DataFrame({"bucket": [-1], "bad": n[:1], "good": n[1:]})       # the number of documents

    counted = (rows.mapInPandas(task, "bucket long, bad long, good long").groupBy("bucket")
               .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas().sort_values("bucket"))
    held, n = np.zeros((2, BUCKETS)), np.zeros(2)
    at = counted["bucket"].to_numpy(np.int64)
    both = counted[["bad", "good"]].to_numpy(float).T
    n += both[:, at < 0].sum(1)
    held[:, at[at >= 0]] = both[:, at >= 0]
    share = (held + 1) / (held + 1).sum(1, keepdims=True)
    return np.log(share[1] / share[0]), n


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int,
                            epochs: int = EPOCHS, tolerance: float = 1e-3) -> np.ndarray:
    """Weights w minimising |w|^2 / 2 + sum cost * max(0, 1 - y w.x) over
    sparse rows (places, values): one dual variable at a time, in random order."""
    rng = np.random.default_rng(SEED)
    w, alpha = np.zeros(size, np.float32), np.zeros(len(rows))
    squares = np.array([float(v @ v) for _, v in rows])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            slope = y[i] * float((w[at] * value).sum()) - 1.0          # no BLAS call: its threads would cost more than the sum
            if (alpha[i] <= 0 and slope >= 0) or (alpha[i] >= cost[i] and slope <= 0) or squares[i] == 0:
                continue
            worst = max(worst, abs(slope))
            new = min(max(alpha[i] - slope / squares[i], 0.0), cost[i])
            w[at] += np.float32((new - alpha[i]) * y[i]) * value
            alpha[i] = new
        if worst < tolerance:
            break
    return w


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))), by Newton steps; targets are drawn in
    a little, as both classes' counts allow, so that parted classes have a finite curve."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    theta = np.array([1.0, math.log((n1 + 1) / (n0 + 1))])

    def loss(th):
        z = x @ th
        return float((np.logaddexp(0, z) - t * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -60, 60)))
        grad = x.T @ (p - t)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """(pull per bucket, square per bucket, bias, curve), or the one score of all texts."""
    y = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_y is not null and _id is not null")
         .groupBy("_id").agg((F.max("_y") > 0).cast("int").alias("_y")).where(~held_out("_id")))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).where(~held_out("_id"))
    short = F.length("_text").between(1, MAX_FIT_CHARS)
    ids = cut(texts.groupBy("_id").agg(F.max(short).alias("_short")).join(y, "_id"), "labelled")

    def least(rows, good, bad):
        """The ids of each class with the least hashes, at most so many: a side to broadcast."""
        some = [rows.where(F.col("_y") == c).orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(n) for c, n in ((1, good), (0, bad))]
        return F.broadcast(some[0].union(some[1]).select("_id", "_y"))

    ratio, n = log_count_ratios(texts.join(least(ids, MAX_COUNTED, MAX_COUNTED), "_id").select("_text", "_y"))
    if not n.all():
        return float(n[1] / n.sum()) if n.sum() else 0.5
    sample = (texts.where(short).join(least(ids.where("_short"), MAX_GOOD, MAX_BAD), "_id")
              .groupBy("_id").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"), F.first("_y").alias("_y")))
    chosen = sorted(sample.collect(), key=lambda r: r["_id"])
    sign = np.array([1.0 if r["_y"] else -1.0 for r in chosen])
    if len(set(sign)) < 2:
        return float(n[1] / n.sum())
    indicators, rows = Indicators(), []
    for r in chosen:                                            # one more place, of value 1, is the bias
        at = indicators(r["_text"])
        value = ratio[at]
        value = value / max(1e-12, float(np.sqrt(value @ value)))
        rows.append((np.append(at, BUCKETS), np.append(value, 1.0).astype(np.float32)))
    cost = COST * np.where(sign > 0, len(sign) / (2 * (sign > 0).sum()), len(sign) / (2 * (sign < 0).sum()))
    half = np.zeros(len(sign), np.int64)
    for c in (1, -1):
        half[sign == c] = np.arange((sign == c).sum()) % 2
    margins = np.zeros(len(sign))
    for f in (0, 1):
        own = np.flatnonzero(half != f)
        w = dual_coordinate_descent([rows[i] for i in own], sign[own], cost[own], BUCKETS + 1)
        for i in np.flatnonzero(half == f):
            margins[i] = (w[rows[i][0]] * rows[i][1]).sum()
    w = dual_coordinate_descent(rows, sign, cost, BUCKETS + 1)
    return (ratio * w[:-1]).astype(np.float32), (ratio * ratio).astype(np.float32), float(w[-1]), logistic_curve(margins, sign)


def scorer(model):
    """Column function: text -> score in [0, 1]."""
    indicators = []

    def score(texts: pd.Series) -> pd.Series:
        if not indicators:
            indicators.append(Indicators())
        pull, square, bias, (a, b) = model
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            at = indicators[0](text)
            length = math.sqrt(float(square[at].sum(dtype=float)))
            margin = bias + (float(pull[at].sum(dtype=float)) / length if length > 0 else 0.0)
            out[i] = 1 / (1 + math.exp(-min(max(a * margin + b, -60.0), 60.0)))
        return pd.Series(out)

    return F.pandas_udf(score, "double") if not isinstance(model, float) else lambda text: F.lit(model)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            threshold: float = THRESHOLD) -> DataFrame:
    """(``id_col``, held_out, score, predicted), one row per row of ``docs``."""
    score = scorer(fit(docs, labels, id_col, text_col, label_col))
    return (docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
