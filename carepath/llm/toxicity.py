"""Toxicity by subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its byte n-grams (with word ends marked)
and of itself, all hashed into ``BUCKETS`` rows; a bag of words is the mean of
its words; a softmax over two classes reads the bag.  Vectors and softmax are
trained jointly in numpy: first on whole documents, then on the window of
``WINDOW`` words that looks most toxic in each document (to a model trained on
other documents), so a single word in a long text still counts.  A document's
score is the largest
window score, over its whole text.  Misspellings never seen share n-grams with
words that were.

Because the softmax is linear, a word's pull on the score is one number, so
scoring needs only ``BUCKETS`` numbers (a fixed 512 kB) in every task.

Training uses at most ``MAX_TOXIC`` + ``MAX_CLEAN`` labelled rows (those with
the least id hashes) of at most ``MAX_TRAIN_CHARS`` characters; it runs on the
driver, whose memory is bounded by these.  Scoring covers every row.

Defined cases: a text without words scores 0; without labelled rows of both
kinds every score is 0; of repeated labels the larger counts, of repeated ids the row
with the least text hash is learnt from; null ids score like any other (held_out is null-safe false); other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import encoded, runs

BUCKETS, DIM, NGRAMS, WINDOW, SHOWN = 1 << 16, 8, (3, 4, 5), 5, 0.5
MAX_TOXIC, MAX_CLEAN, MAX_TRAIN_CHARS, WINDOW_STEPS = 1500, 3000, 100_000, 450
WARM_EPOCHS, WINDOW_EPOCHS, BATCH, RATE, SEED = 3, 12, 256, 0.5, 79
THRESHOLD = 0.7
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[bytes]:
    return encoded((text or "").lower()).split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every n-gram of every word and of each word itself."""
    buf = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    end = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    power = _MUL ** np.arange(int(sizes.max(initial=1)) + 1, dtype=np.uint64)
    who, what = [], []
    for n in NGRAMS:
        if len(buf) < n:
            continue
        h = np.full(len(buf) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ buf[j:len(buf) - n + 1 + j]) * _MUL
            h ^= h >> np.uint64(29)
        ok = np.arange(len(h)) + n <= end[owner[:len(h)]]
        who.append(owner[:len(h)][ok])
        what.append(h[ok])
    offset = np.arange(len(buf)) - np.repeat(end - sizes, sizes)
    who.append(np.arange(len(words)))
    what.append(np.add.reduceat(buf * power[offset], end - sizes) if len(words) else np.zeros(0, np.uint64))
    h = np.concatenate(what) * _MUL
    return np.concatenate(who), (h >> np.uint64(48)).astype(np.int64) % BUCKETS


class _Bags:
    """Training documents as word numbers, with the n-grams of each word."""

    def __init__(self, texts: list[str]):
        number: dict[bytes, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number)) for w in _words(t)], np.int32) for t in texts]
        words, parts, counts = list(number), [], []
        del number
        for i in range(0, len(words), 1 << 15):                # a run of words at a time, for memory
            run = words[i:i + (1 << 15)]
            who, what = subwords(run)
            parts.append(what[np.argsort(who, kind="stable")].astype(np.uint16))
            counts.append(np.bincount(who, minlength=len(run)))
        self.bucket = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        self.count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.count)])

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``words``, bucket) of the n-grams of these words."""
        n = self.count[words]
        pos = np.repeat(np.arange(len(words)), n)
        step = np.arange(len(pos)) - np.repeat(np.cumsum(n) - n, n)
        return pos, self.bucket[np.repeat(self.at[words], n) + step]

    def word_scores(self, per_bucket: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.count))
        for i in range(0, len(total), 1 << 15):
            at = self.at[i:i + (1 << 15) + 1]
            total[i:i + (1 << 15)] = np.add.reduceat(per_bucket[self.bucket[at[0]:at[-1]]], at[:-1] - at[0])
        return total / self.count


def best_window(scores: np.ndarray) -> tuple[float, int]:
    """(largest mean score, start) over windows of ``WINDOW`` words, or of all if fewer."""
    n = min(WINDOW, len(scores))
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    means = (sums[n:] - sums[:-n]) / n
    i = int(np.argmax(means))
    return float(means[i]), i


def _step(bags: _Bags, model: dict, batch: list[np.ndarray], y: np.ndarray, rng) -> None:
    """One Adagrad step of vectors and softmax on a batch of bags.  Each word
    shows a random ``SHOWN`` of its n-grams, so that no few of them carry it
    and a misspelling, which changes some, still weighs."""
    e, w, b = model["e"], model["w"], model["b"]
    sizes = np.array([len(x) for x in batch])
    words, inverse = np.unique(np.concatenate(batch), return_inverse=True)
    row = np.repeat(np.arange(len(batch)), sizes)
    weight = np.repeat(1.0 / sizes, sizes)
    pos, bucket = bags.grams(words)
    shown = rng.random(len(pos)) < SHOWN
    pos, bucket = pos[shown], bucket[shown]
    share = 1.0 / np.maximum(1, np.bincount(pos, minlength=len(words)))
    vec = np.stack([np.bincount(pos, weights=e[bucket, d], minlength=len(words)) for d in range(DIM)], 1) * share[:, None]
    hidden = np.stack([np.bincount(row, weights=vec[inverse, d] * weight, minlength=len(batch)) for d in range(DIM)], 1)
    logits = hidden @ w + b
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    back = p @ w.T
    g_word = np.stack([np.bincount(inverse, weights=back[row, d] * weight, minlength=len(words)) for d in range(DIM)], 1) * share[:, None]
    g_e = np.stack([np.bincount(bucket, weights=g_word[pos, d], minlength=BUCKETS) for d in range(DIM)], 1)
    for name, grad in (("e", g_e), ("w", hidden.T @ p), ("b", p.sum(0))):
        seen = model["seen"][name]
        seen += grad * grad
        model[name] -= RATE * grad / np.sqrt(seen + 1e-8)


def train(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """(pull of each bucket, bias) of the log-odds of being toxic."""
    bags = _Bags(texts)
    kept = [i for i, d in enumerate(bags.docs) if len(d)]
    bags.docs = [bags.docs[i] for i in kept]
    y = np.array([labels[i] for i in kept], np.int64)
    if len(set(y.tolist())) < 2:
        return np.zeros(BUCKETS), -np.inf
    rng = np.random.default_rng(SEED)

    def fresh():
        model = {"e": rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), "w": np.zeros((DIM, 2)), "b": np.zeros(2)}
        return model | {"seen": {k: np.zeros_like(v) for k, v in model.items()}}

    def pull(model):
        return bags.word_scores(model["e"] @ (model["w"][:, 1] - model["w"][:, 0]))

    def epoch(model, examples, wanted):
        order = rng.permutation(len(examples))
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            _step(bags, model, [examples[j] for j in at], np.asarray(wanted)[at], rng)

    def windows(at, chooser, own):
        """Of toxic documents the window that ``chooser`` finds worst; of clean
        ones the window that the model itself does, and ordinary ones."""
        examples, wanted = [], []
        each = max(1, -(-MAX_CLEAN // max(1, int((y[at] == 0).sum()))))
        for k in at:
            d = bags.docs[k]
            starts = [best_window((chooser if y[k] else own)[d])[1]]
            if y[k]:
                starts *= (each + 1) // 2                     # few clean documents give many windows each; keep the balance
            else:
                starts += rng.integers(0, max(1, len(d) - WINDOW + 1), each).tolist()
            examples += [d[i:i + WINDOW] for i in starts]
            wanted += [y[k]] * len(starts)
        return examples, wanted

    # Two models, each trained on half of the documents, choose windows for one
    # another: a model that has learnt a document by heart finds nothing in it.
    half = np.zeros(len(y), np.int64)
    for label in (0, 1):
        half[y == label] = np.arange((y == label).sum()) % 2
    folds, models = [np.flatnonzero(half == f) for f in (0, 1)], [fresh(), fresh()]
    model = fresh()
    for at, m in [*zip(folds, models), (np.arange(len(y)), model)]:
        for _ in range(WARM_EPOCHS):
            epoch(m, [bags.docs[k] for k in at], y[at])
    for _ in range(WINDOW_EPOCHS // 3):
        pulls = [pull(m) for m in models]
        for f, (at, m) in enumerate(zip(folds, models)):
            epoch(m, *windows(at, pulls[1 - f], pulls[f]))
    # The model proper begins with their choice and ends with its own.
    pulls = [pull(m) for m in models]
    steps = -(-sum(len(windows(at, pulls[0], pulls[0])[1]) for at in folds) // BATCH)
    for turn in range(max(WINDOW_EPOCHS, -(-WINDOW_STEPS // max(1, steps)))):      # few documents are seen more often
        own = pull(model)
        for f, at in enumerate(folds):
            epoch(model, *windows(at, pulls[1 - f] if turn < WINDOW_EPOCHS // 3 else own, own))
    return model["e"] @ (model["w"][:, 1] - model["w"][:, 0]), float(model["b"][1] - model["b"][0])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, y): the bounded sample of labelled rows outside the held-out fold."""
    y = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_y is not null and _id is not null")
         .groupBy("_id").agg(F.max("_y").alias("_y")).where(~held_out("_id")))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .where(F.length("_text").between(1, MAX_TRAIN_CHARS)))
    fit = y.join(rows.select("_id").distinct(), "_id", "left_semi")
    some = [fit.where(cond).orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(n)
            for cond, n in (("_y > 0", MAX_TOXIC), ("_y <= 0", MAX_CLEAN))]
    sample = some[0].union(some[1])                            # at most MAX_TOXIC + MAX_CLEAN ids
    chosen = F.min_by("_text", F.struct(F.xxhash64("_text"), "_text"))     # of rows that share an id the same one in every run
    return (rows.join(F.broadcast(sample), "_id").groupBy("_id")
            .agg(chosen.alias("_text"), (F.first("_y") > 0).cast("int").alias("_y")))


def held_out(id_col: str) -> "F.Column":
    """The fold no label is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    rows = sorted(training_rows(docs, labels, id_col, text_col, label_col).collect(), key=lambda r: r["_id"])
    return train([r["_text"] for r in rows], [r["_y"] for r in rows])


def scorer(model):
    """Column function: text -> score in [0, 1]."""
    pull, bias = model
    known: dict[bytes, float] = {}

    def learn(words):
        new = list(set(words).difference(known))
        if new:
            if len(known) > 1 << 19:
                known.clear()
                new = list(set(words))
            who, bucket = subwords(new)
            total = np.bincount(who, weights=pull[bucket], minlength=len(new))
            known.update(zip(new, (total / np.bincount(who, minlength=len(new))).tolist()))

    def score(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        out = np.zeros(len(texts))
        for i, j in runs(texts):
            parts = [_words(t) for t in texts[i:j]]
            flat = [w for p in parts for w in p]
            if not flat or bias == -np.inf:
                continue
            learn(flat)
            pulls = np.fromiter(map(known.__getitem__, flat), float, len(flat))
            end = 0
            for k, p in enumerate(parts):
                if p:
                    logit = best_window(pulls[end:end + len(p)])[0] + bias
                    out[i + k] = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
                end += len(p)
        return pd.Series(out)

    return F.pandas_udf(score, "double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = THRESHOLD) -> DataFrame:
    """(``id_col``, held_out, score, predicted), one row per row of ``docs``."""
    score = scorer(fit(docs, labels, id_col, text_col, label_col))
    return (docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def clean_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't found toxic."""
    score = scorer(fit(docs, labels, id_col, text_col, label_col))
    return docs.where(score(docs[text_col]) < threshold)
