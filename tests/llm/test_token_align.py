"""Cross-tokenizer alignment against whole-text encodings and plain set arithmetic."""

import collections
import hashlib
import random

import pytest
import pyarrow.parquet as pq

from carepath.llm import token_align as ta
from carepath.llm.queries import op11_token_align

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    with open(f"{ta.TOKENIZERS}/{ta.A_FILE}", encoding="utf-8") as f:
        a = f.read()
    with open(f"{ta.TOKENIZERS}/{ta.B_FILE}", "rb") as f:
        return ta.ByteLevel(a), ta.Pieces(f.read())


def ends(ids, coder):
    out, at = [], 0
    for i in ids:
        at += len(coder.bytes[i])
        out.append(at)
    return out


def brute(rows, coders):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) per (id, text), from whole texts."""
    docs = []
    for _, text in rows:
        a, b = (c.encode([text or ""])[0] for c in coders)
        want = (" " + (text or "")).encode()
        if not text or any(b"".join(c.bytes[i] for i in x) != want for c, x in zip(coders, (a, b))):
            docs.append(None)
            continue
        ea, eb = ends(a, coders[0]), ends(b, coders[1])
        common = sorted(set(ea) & set(eb))
        group = {e: n for n, e in enumerate(common)}
        place = lambda e: next(group[c] for c in common if c >= e) if len(common) < 200 else group[common[__import__("bisect").bisect_left(common, e)]]
        ga, gb = collections.defaultdict(list), collections.defaultdict(list)
        for i, e in zip(a, ea):
            ga[place(e)].append(i)
        for i, e in zip(b, eb):
            gb[place(e)].append(i)
        docs.append((a, b, [(ga[n], gb[n]) for n in range(len(common))]))
    held = collections.Counter()
    for d in docs:
        if d:
            held.update({(x, y) for xs, ys in d[2] for x in xs for y in ys})
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if not d:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for xs, ys in d[2] for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in d[2])
        out.append((len(d[0]), len(d[1]), len(d[2]), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_align_is_the_common_ends_of_both_sequences():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 80)
        share = rng.choice([0.05, 0.5, 0.95])
        a, b = ([e for e in range(1, n) if rng.random() < share] + [n] for _ in range(2))
        common = sorted(set(a) & set(b))
        assert ta.align(a, b) == ([a.index(e) + 1 for e in common], [b.index(e) + 1 for e in common])
    assert ta.align([], []) == ([], [])
    assert ta.align([1, 2, 3], [1, 2, 3]) == ([1, 2, 3], [1, 2, 3])


def test_places_are_packed_and_read_back():
    import numpy as np
    places, links = np.array([0, 3, 70_000, 2_000_000_000]), np.array([1, 300, 1, 70_000])
    back = ta._unpack(ta._pack(places, links))
    assert back[0].tolist() == places.tolist() and back[1].tolist() == links.tolist()


def test_hard_cases_equal_the_whole_texts(spark, coders):
    rng = random.Random(7)
    bits = ["a", "é", "▁", " ", "  ", "\n", "\t", "'s", "don't", "<|endoftext|>", "<s>", "<0x41>", "\U0001f600", " ", "\x1f", "1234", "!!",
            "ß", "　", "中文", "word", "\x00", "​", "é", "%%%"]
    texts = [None, "", " ", "\n", "x", " x", "x ", "a  b", "a \nb", "▁", "a ▁ b", "<|endoftext|> a", "plain words only", "plain words only"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    texts += ["nospace" * 3000, "w " * 20000, " ".join(rng.choice(bits) for _ in range(3000))]
    rows = [(None if i % 50 == 9 else i // 2, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string").repartition(3)
    got = ta.align_tokens(df, chunk_chars=2000).collect()
    want = brute([(r.doc_id, r.text) for r in df.collect()], coders)
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    ids = [r.doc_id for r in df.collect()]
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in got), key=key) == sorted(((i, *w) for i, w in zip(ids, want)), key=key)
    assert ta.align_tokens(df.limit(0)).collect() == []


def test_query_equals_brute_force_on_whole_tables(spark, coders):
    docs = pq.read_table(f"{SF001}/documents.parquet").to_pydict()
    rows = list(zip(docs["doc_id"], docs["text"]))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op11_token_align(spark, SF001).collect()}
    assert got == {d: w for (d, _), w in zip(rows, brute(rows, coders))}


def test_forgotten_units_change_nothing(coders):
    texts = ["one two three", "two four ▁", "one two three", "five, six; seven"] * 3
    whole = ta._Aligner(*coders).run(texts)
    small = ta._Aligner(*coders)
    for i, t in enumerate(texts):
        small.held = ta.KNOWN_CHARS + 1
        one = small.run([t])
        assert one[0][0] == whole[0][i]
        at = whole[1] == i
        assert one[2].tolist() == whole[2][at].tolist() and one[3].tolist() == whole[3][at].tolist()
