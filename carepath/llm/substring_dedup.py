"""Substring dedup by seed and extend.

Each 35-word window (``min_words``) is put down to one winnowed anchor, the
leftmost least hash of its ``ANCHOR``-word grams, wherever the window stands.
So a repeated window can be found from repeated anchors alone:

1. *Seed.*  Per document, consecutive windows with the same anchor form a
   stretch; a row holds the anchor's hash, the stretch's hash and its place.
2. *Join documents on anchors.*  Anchors met once go.  Where all stretches of
   an anchor are equal, every window in them is repeated: a passage that
   thousands of documents share costs one row per occurrence and never a pair.
3. *Extend.*  Where an anchor has different stretches, one occurrence of each is
   extended window by window, and windows met in two stretches are marked: a
   bit mask per stretch, whose runs of set bits are the maximal repeats.
4. Marks go back to the documents, and covered words are removed.

Hash keys are 128 bits throughout (anchor hash with window hash).

Defined cases: null or empty text has no words and loses none; a document
shorter than ``min_words`` loses nothing; repeated rows are documents of their
own, so each loses the windows it shares with its twin; a null id is an
ordinary value; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, cut, discard, encoded, runs

MIN_WORDS = 35
ANCHOR = 16
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93          # odd: invertible modulo 2**64
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as asked."""

    def __init__(self, base: int):
        self.base, self.inv = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.base, np.uint64))])
                self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.inv, np.uint64))])
        return self.up, self.down


_P1, _P2 = _Powers(_B1), _Powers(_B2)


def _prefix(words: np.ndarray, powers: _Powers) -> np.ndarray:
    up, _ = powers.upto(len(words) + 1)
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=out[1:])
    return out


def _span_hash(prefix, powers, start, end):
    """Hash of words[start:end], whatever their place."""
    _, down = powers.upto(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def _leftmost(x: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost least of x[i:i+w] for every i, by doubling."""
    at, have = np.arange(len(x)), 1
    while have < w:
        step = min(have, w - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(x[a] <= x[b], a, b)
        have += step
    return at


def _stretches(words: np.ndarray, bounds: np.ndarray, min_words: int, k: int):
    """(doc index, first window, number of windows, anchor hash, stretch hash)
    of documents laid end to end; ``bounds`` are their ends."""
    n, w = len(words), min_words - k + 1
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if n < min_words:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    p1, p2 = _prefix(words, _P1), _prefix(words, _P2)
    at = np.arange(n - k + 1)
    gram = _span_hash(p1, _P1, at, at + k)
    s = np.arange(n - min_words + 1)
    s = s[s + min_words <= bounds[1:][doc[s]]]                     # windows inside one document
    anchor = _leftmost(gram, w)[s]
    new = np.ones(len(s), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[s[1:]] != doc[s[:-1]])
    i = np.flatnonzero(new)
    first, count = s[i], np.diff(np.append(i, len(s)))
    near = _span_hash(p2, _P2, first, first + count - 1 + min_words)
    shape = ((anchor[i] - first) * 1024 + count).astype(np.uint64)  # where the anchor stands in it
    near = (near ^ (shape * np.uint64(0xA24BAED4963EE407))) * np.uint64(_B2)
    return doc[first], first - bounds[:-1][doc[first]], count, gram[anchor[i]], near


def _hashed(texts, hasher):
    """Word hashes of texts laid end to end, with their bounds."""
    parts = [encoded(t).split() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return hasher([w for p in parts for w in p]), bounds


def find_stretches(docs: DataFrame, min_words: int = MIN_WORDS, k: int = ANCHOR) -> DataFrame:
    """(_key, first, h, near) of every stretch of ``docs`` (_key, _text)."""

    def task(batches):
        hasher = WordHasher(1)
        for pdf in batches:
            keys, texts = pdf["_key"].to_numpy(), pdf["_text"].tolist()
            for i, j in runs(texts):
                words, bounds = _hashed(texts[i:j], hasher)
                d, first, count, h, near = _stretches(words, bounds, min_words, k)
                yield pd.DataFrame({"_key": keys[i:j][d], "first": first.astype(np.int32), "n": count.astype(np.int32),
                                    "h": h.view(np.int64), "near": near.view(np.int64)})

    return docs.select("_key", "_text").mapInPandas(task, "_key long, first int, n int, h long, near long")


def extend(docs: DataFrame, spots: DataFrame, min_words: int) -> DataFrame:
    """(h, near, j, win): the windows of one occurrence per stretch.

    ``spots`` holds (_key, spots: array of (first, n, h, near))."""

    def task(batches):
        hasher = WordHasher(1)
        for pdf in batches:
            texts = pdf["_text"].tolist()
            cols = [pdf[c].tolist() for c in ("first", "n", "h", "near")]
            for i, j in runs(texts):
                words, bounds = _hashed(texts[i:j], hasher)
                prefix = _prefix(words, _P2)
                base = np.repeat(bounds[:-1], [len(x) for x in cols[0][i:j]])
                first, n, h, near = (np.concatenate(c[i:j]).astype(np.int64) for c in cols)
                r = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
                s = (base + first)[r] + step
                win = _span_hash(prefix, _P2, s, s + min_words)
                yield pd.DataFrame({"h": h[r], "near": near[r], "j": step.astype(np.int32), "win": win.view(np.int64)})

    joined = (docs.select("_key", "_text").join(spots, "_key")
              .select("_text", "spots.first", "spots.n", "spots.h", "spots.near"))
    return joined.mapInPandas(task, "h long, near long, j int, win long")


def _marks(docs: DataFrame, min_words: int, k: int) -> DataFrame:
    """(_key, spots: array of (first, mask)): bit j of a mask says that the
    window beginning at word first + j is repeated."""
    found = cut(find_stretches(docs, min_words, k), "stretches")
    again = cut(found.groupBy("h").agg(F.count("*").alias("c"), F.min("near").alias("x"), F.max("near").alias("y"))
                .where("c > 1").select("h", (F.col("x") < F.col("y")).alias("mixed")), "anchors")
    seen = cut(found.join(again, "h"), "repeated")
    discard(found, again)
    mixed = seen.where("mixed")
    classes = cut(mixed.groupBy("h", "near").agg(F.count("*").alias("c"), F.min(F.struct("_key", "first", "n")).alias("rep")), "classes")
    spots = (classes.select("rep._key", F.struct("rep.first", "rep.n", "h", "near").alias("s"))
             .groupBy("_key").agg(F.collect_list("s").alias("spots")))          # at most the stretches of one text
    windows = cut(extend(docs, spots, min_words), "windows")
    shared = (windows.groupBy("h", "win").agg(F.min("near").alias("x"), F.max("near").alias("y"))
              .where("x < y").drop("x", "y"))                                   # met in two stretches
    part = (windows.join(shared, ["h", "win"]).groupBy("h", "near").agg(F.expr("bit_or(shiftleft(1L, j))").alias("mask")))
    masks = cut(part.union(classes.where("c > 1").select("h", "near", F.lit(-1).cast("long")))
                .groupBy("h", "near").agg(F.bit_or("mask").alias("mask")), "masks")
    discard(windows, classes)
    every = F.when(F.col("n") < 63, F.expr("shiftleft(1L, n) - 1")).otherwise(F.lit(-1).cast("long"))
    marked = (seen.where("not mixed").select("_key", "first", every.alias("mask"))
              .union(mixed.join(masks, ["h", "near"]).select("_key", "first", F.col("mask").bitwiseAND(every))))
    out = cut(marked.groupBy("_key").agg(F.collect_set(F.struct("first", "mask")).alias("spots")), "marks")   # a set: repeated rows share a key
    discard(seen, masks)
    return out


def _covered(n: int, first, mask, min_words: int) -> np.ndarray:
    """Which of n words lie in a marked window."""
    edge = np.zeros(n + 1, np.int32)
    if first is not None and len(first):
        first, mask = np.asarray(first, np.int64), np.asarray(mask, np.int64)
        for j in range(int(mask.max()).bit_length()):
            s = first[(mask >> j) & 1 == 1] + j
            np.add.at(edge, s, 1)
            np.add.at(edge, s + min_words, -1)
    return np.cumsum(edge[:n]) > 0


def _applied(docs: DataFrame, id_col: str, text_col: str, min_words: int, anchor: int, texts: bool) -> DataFrame:
    """Input rows as the struct ``_row``, with the outcome as the struct ``_out``."""
    if not anchor <= min_words < anchor + 62:
        raise ValueError("anchor must be no longer than min_words, nor shorter by 62 words or more")
    # Repeated rows share a key and, being alike, the marks.
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text_col].alias("_text"),
                        F.xxhash64(F.lit(17), docs[id_col], docs[text_col]).alias("_key"))
    marks = _marks(keyed, min_words, anchor)

    def work(column: pd.Series, firsts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        out = []
        for text, first, mask in zip(column, firsts, masks):
            raw = encoded(text)
            words = raw.split()
            cov = _covered(len(words), first, mask, min_words)
            removed = int(cov.sum())
            kept = [w for w, c in zip(words, cov) if not c] if removed else words
            if texts and removed:
                pieces, last = [], 0
                for m, c in zip(_WORDS.finditer(raw), cov):
                    if not c:
                        pieces.append(raw[last:m.end()])
                    last = m.end()
                text = b"".join([*pieces, raw[last:]]).decode("utf-8", "surrogatepass")
            out.append((len(words), removed, hashlib.sha256(b" ".join(kept)).hexdigest(), text if texts else None))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])

    udf = F.pandas_udf(work, "n_words long, n_removed long, kept_sha256 string, kept_text string")
    return (keyed.join(marks, "_key", "left")
            .select("_row", udf("_text", F.col("spots.first"), F.col("spots.mask")).alias("_out")))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """(``id_col``, n_words, n_removed, kept_sha256), one row per row of ``docs``;
    ``kept_sha256`` digests the kept words joined by one space."""
    out = _applied(docs.select(id_col, text_col), id_col, text_col, min_words, anchor, texts=False)
    return out.select(F.col("_row")[id_col].alias(id_col), "_out.n_words", "_out.n_removed", "_out.kept_sha256")


def deduped_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the covered words cut out of the texts (white space before
    a cut word goes with it; ``n_chars``, where there is one, is counted anew)."""
    out = _applied(docs, id_col, text_col, min_words, anchor, texts=True)
    new = {text_col: F.col("_out.kept_text"), "n_chars": F.length("_out.kept_text")}
    return out.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("_row")[c]).alias(c) for c in docs.columns])
