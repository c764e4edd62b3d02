"""Cross-tokenizer alignment by diagonal run skipping.

1. Every text is encoded by tokenizer A (byte-level BPE; reads a space and the
   text) and tokenizer B (pieces with byte fallback; adds that space itself).
   Both treat a single space between two other characters as a hard border, so
   a text is cut there into units and each unit is encoded once and
   remembered by the worker process, up to a bound; the ids are those of the
   whole text (a test compares them).
2. The byte offsets at which tokens end are two rising sequences.  At the current index
   shift their entries are compared in stretches of doubling length; a stretch
   that agrees is jumped in one comparison, one that doesn't is halved to
   the end of the one-to-one run.  What follows is an irregular group: it is
   walked token by token to the next common end, and the shift is updated.
3. Links are all A-B occurrence pairs of a group.  Rows are dealt in chunks of
   about ``CHUNK_CHARS`` characters; a chunk has a dictionary of its id pairs,
   with the number of its documents that hold each, and a document a list of places in it.
   Only dictionaries are summed over the corpus, and only the counts of a
   chunk's own pairs come back to it, so what is shuffled is the distinct pairs of each
   chunk, not links or documents times pairs.

Nothing is collected: a pair's count, and the highest count of an A id, are
grouped aggregates.

Defined cases: null and empty texts, and texts whose joined token bytes differ
from a space and the text (those with U+2581, which B reads as a space) have no
tokens: zeros and an empty digest.  Each row is a document of its own, also
where ids or whole rows repeat or ids are null.  An empty table gives no rows.
Other columns play no part.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, encoded, runs

TOKENIZERS, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_CHARS, RUN_CHARS, KNOWN_CHARS, JOIN = 1 << 24, 1 << 21, 3 << 24, 256
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ROW = "doc long, chunk long, n_a long, n_b long, n_groups long, n_links long, digest string, places binary, pairs array<long>, docs array<int>"


# --- tokenizers ---------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands
    for itself, the other bytes are numbered from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_str(text)
        self.encoder.encode_special_tokens = True
        vocab = self.encoder.get_vocab(with_added_tokens=False)
        added = {t["id"]: t["content"].encode() for t in json.loads(text)["added_tokens"]}
        byte = byte_level_alphabet()
        self.bytes = [b""] * (max([*vocab.values(), *added]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        for i, content in added.items():
            self.bytes[i] = content

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a ``sentencepiece`` model, which adds the space in front."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.encoder = SentencePieceProcessor(model_proto=model)
        sp = self.encoder
        self.bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode()
                      for i in range(sp.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.encode(texts, num_threads=1)


# --- alignment ------------------------------------------------------------------

def align(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Groups of two rising sequences of token ends with the same last entry:
    for each group the index after its last token in ``a`` and in ``b``."""
    to_a: list[int] = []
    to_b: list[int] = []
    i, shift, n = 0, 0, len(a)
    while i < n:
        j = i + shift
        if a[i] == b[j]:
            run, step = 1, 1
            while True:                                         # double while the whole stretch agrees
                x = a[i + run:i + run + step]
                if not x or x != b[j + run:j + run + step]:
                    break
                run += len(x)
                step *= 2
            while step > 1:                                     # halve to the end of the run
                step //= 2
                x = a[i + run:i + run + step]
                if x and x == b[j + run:j + run + step]:
                    run += len(x)
            i += run
            to_a.extend(range(i - run + 1, i + 1))
            to_b.extend(range(j + 1, j + run + 1))
        else:                                                   # an irregular group, to the next common end
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            to_a.append(i)
            to_b.append(j)
            shift = j - i
    return to_a, to_b


class _Aligner:
    """Encodes and aligns texts.  New units are encoded together and their ends
    aligned in one walk (a unit's end is a common end); what a unit adds to a
    text, its id pairs, counts and digest string, is remembered for as many
    units as ``KNOWN_CHARS`` allows."""

    def __init__(self, a, b):
        self.coders = (a, b)
        self.widths = [np.array([len(x) for x in c.bytes], np.int64) for c in self.coders]
        # Decimal ids with what may follow: a comma, the bar after a group's A ids, the semicolon after its B ids.
        self.words = [f"{i}{s}" for c, marks in zip(self.coders, (",|", ",;")) for s in marks for i in range(len(c.bytes))]
        self._forget()

    def _forget(self):
        self.number, self.strings, self.held = {}, [], 0
        self.stats = np.zeros((0, 4), np.int64)                 # tokens of A, of B, groups, links of each unit
        self.good, self.at, self.pairs = np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def _encode(self, units: list[str]):
        """(ids of A, of B, whether the unit's bytes come back) of these units."""
        joined = [units[i:i + JOIN] for i in range(0, len(units), JOIN)]
        texts = [" ".join(some) for some in joined]
        ids = [coder.encode(texts) for coder in self.coders]
        good = np.ones(len(units), bool)
        for k, (some, text) in enumerate(zip(joined, texts)):
            want = b" " + encoded(text)
            if any(b"".join(map(c.bytes.__getitem__, x[k])) != want for c, x in zip(self.coders, ids)):
                each = [c.encode(some) for c in self.coders]
                ok = [all(b"".join(map(c.bytes.__getitem__, x[n])) == b" " + encoded(u) for c, x in zip(self.coders, each))
                      for n, u in enumerate(some)]
                good[k * JOIN:k * JOIN + len(some)] = ok
                for x, y in zip(ids, each):
                    x[k] = [i for y_n, o in zip(y, ok) if o for i in y_n]
        return *(np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in ids), good

    def _learn(self, units: list[str]):
        ids_a, ids_b, good = self._encode(units)
        ends_a, ends_b = np.cumsum(self.widths[0][ids_a]), np.cumsum(self.widths[1][ids_b])
        to_a, to_b = (np.array(x, np.int64) for x in align(ends_a.tolist(), ends_b.tolist()))
        in_a, in_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        # All pairs of a group: each A token meets the B tokens of its group.
        each = np.repeat(in_b, in_a)
        start = np.cumsum(each) - each
        at_b = np.arange(int(each.sum())) + np.repeat(np.repeat(to_b - in_b, in_a) - start, each)
        pairs = np.repeat(ids_a, each) * len(self.widths[1]) + ids_b[at_b]
        # The units' borders, in tokens, groups, links.
        border = np.cumsum(np.fromiter((len(encoded(u)) + 1 for u in units), np.int64, len(units)) * good)
        bounds = [np.searchsorted(x, border, side="right") for x in (ends_a, ends_b, ends_a[to_a - 1] if len(to_a) else to_a)]
        links = np.concatenate([[0], np.cumsum(in_a * in_b)])[bounds[2]]
        self.stats = np.concatenate([self.stats, np.diff(np.stack([*bounds, links], 1), axis=0, prepend=0)])
        self.at = np.concatenate([self.at, self.at[-1] + links])
        self.pairs, self.good = np.concatenate([self.pairs, pairs]), np.concatenate([self.good, good])
        # The digest string: A token i of a group stands behind the B tokens of the groups before, B token j behind the A tokens up to its own.
        code = np.zeros(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[to_a - 1] = 1
        last_b[to_b - 1] = 1
        n_a, n_b = len(self.widths[0]), len(self.widths[1])
        code[np.arange(len(ids_a)) + np.repeat(to_b - in_b, in_a)] = ids_a + n_a * last_a
        code[np.arange(len(ids_b)) + np.repeat(to_a, in_b)] = 2 * n_a + ids_b + n_b * last_b
        words = list(map(self.words.__getitem__, code.tolist()))
        begin = 0
        for end in (bounds[0] + bounds[1]).tolist():
            self.strings.append("".join(words[begin:end]))
            begin = end
        self.number.update(zip(units, range(len(self.number), len(self.good))))
        self.held += sum(map(len, units)) + 64 * len(units)

    def run(self, texts: list[str | None]):
        """(n_a, n_b, n_groups, n_links, digest) per text, and the distinct
        (text, pair, links) triples in order."""
        parts = [_CUT.split(t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = list(itertools.chain.from_iterable(parts))
        if self.held > KNOWN_CHARS:
            self._forget()
        fresh = list(set(flat).difference(self.number))
        if fresh:
            self._learn(fresh)
        units = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), sizes)
        bad = np.zeros(len(texts), bool)
        bad[owner[~self.good[units]]] = True
        units, owner = units[~bad[owner]], owner[~bad[owner]]
        stats = [np.bincount(owner, weights=s[units], minlength=len(texts)).astype(np.int64).tolist() for s in self.stats.T]
        digests, at, word = [], 0, self.strings.__getitem__
        for n in np.bincount(owner, minlength=len(texts)).tolist():
            digests.append(hashlib.sha256("".join(map(word, units[at:at + n].tolist()))[:-1].encode()).hexdigest() if n else "")
            at += n
        links = self.stats[units, 3]
        start = np.cumsum(links) - links
        pair = self.pairs[np.arange(int(links.sum())) + np.repeat(self.at[units] - start, links)]
        span = len(self.widths[0]) * len(self.widths[1])
        key = np.repeat(owner, links) * span + pair
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        links = np.diff(new, append=len(key))
        key = key[new]
        return list(zip(*stats, digests)), key // span, key % span, links


def _aligner(files: tuple[str, bytes]) -> _Aligner:
    """The worker process's aligner for these files, with the units it knows
    from earlier tasks (they change the time only, not the result)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"              # a task has one core
    shelf = sys.modules.setdefault("_token_align_shelf", types.ModuleType("_token_align_shelf")).__dict__
    key = hashlib.sha256(files[0].encode() + files[1]).digest()
    if shelf.get("key") != key:
        shelf.update(key=key, aligner=_Aligner(ByteLevel(files[0]), Pieces(files[1])))
    return shelf["aligner"]


# --- packing of a document's places in its chunk's dictionary -------------------------

def _pack(places: np.ndarray, links: np.ndarray) -> bytes:
    """Rising places and their numbers of links (at least 1) as compressed bytes."""
    body = np.diff(places, prepend=0).astype("<u4").tobytes() + (links - 1).astype("<u4").tobytes()
    planes = np.frombuffer(body, np.uint8).reshape(-1, 4).T.tobytes()       # equal high bytes side by side
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    both = planes.reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[:len(both) // 2]), both[len(both) // 2:] + 1


def _encode_task(files: tuple[str, bytes], chunk_chars: int):
    """mapInArrow function: (doc, text) -> rows of documents and, one per chunk, its dictionary."""

    def finish(chunk, rows, held):
        doc, pair, links = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*held)) if held else (np.zeros(0, np.int64),) * 3
        pairs, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        border = np.searchsorted(doc, np.arange(len(rows) + 1))
        out = {k: [] for k in ("doc", "chunk", "n_a", "n_b", "n_groups", "n_links", "digest", "places", "pairs", "docs")}
        for i, (key, (n_a, n_b, n_groups, n_links, digest)) in enumerate(rows):
            here = slice(border[i], border[i + 1])
            for k, v in zip(out, (key, chunk, n_a, n_b, n_groups, n_links, digest,
                                  _pack(place[here], links[here]) if n_links else None, None, None)):
                out[k].append(v)
        if len(pairs):
            for k, v in zip(out, (None, chunk, None, None, None, None, None, None, pairs, docs.astype(np.int32))):
                out[k].append(v)
        types = (pa.int64(),) * 6 + (pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    def task(batches):
        from pyspark import TaskContext
        aligner = _aligner(files)
        number, rows, held, size = 0, [], [], 0
        chunk = lambda: (TaskContext.get().partitionId() << 32) + number
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in runs(texts, RUN_CHARS):
                found, doc, pair, links = aligner.run(texts[i:j])
                held.append((doc + len(rows), pair, links))
                rows += zip(keys[i:j], found)
                size += sum(len(t or "") for t in texts[i:j])
                if size >= chunk_chars:
                    yield finish(chunk(), rows, held)
                    number, rows, held, size = number + 1, [], [], 0
        if rows:
            yield finish(chunk(), rows, held)

    return task


def _count_task(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of one chunk: its documents with the counts of their pairs."""
    order = np.argsort(right["place"].to_numpy())
    count, best = right["count"].to_numpy()[order], right["best"].to_numpy(zero_copy_only=False)[order]
    n_best, total = [], []
    for data in left["places"].to_pylist():
        if data is None:
            n_best.append(0)
            total.append(0)
        else:
            place, links = _unpack(data)
            n_best.append(int(links[best[place]].sum()))
            total.append(int((links * count[place]).sum()))
    kept = left.select(["doc", "n_a", "n_b", "n_groups", "n_links", "digest"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def align_tokens(docs: DataFrame, tokenizers: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id",
                 text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256), one row per row of ``docs``.  The tokenizer files are read
    here, a few megabytes, and go to the tasks with their function."""
    with open(os.path.join(tokenizers, a_file), encoding="utf-8") as f:
        a = f.read()
    with open(os.path.join(tokenizers, b_file), "rb") as f:
        b = f.read()
    span = len(Pieces(b).bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    made = cut(rows.mapInArrow(_encode_task((a, b), chunk_chars), _ROW), "aligned")
    held = (made.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p"))
            .select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / span))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))       # at most one row per A id
    counts = counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    back = held.select("chunk", "place", "pair").join(counts, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    out = (made.where("pairs is null").groupBy("chunk").cogroup(back.groupBy("of"))
           .applyInArrow(_count_task, "doc long, n_a long, n_b long, n_groups long, n_links long, digest string, n_best long, count_sum long"))
    return out.select(F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("digest").alias("groups_sha256"))
