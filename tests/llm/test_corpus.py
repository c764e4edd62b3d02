import base64
import collections
import hashlib
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from carepath.llm import chat_format, hilbert_ann, html_extract, mixing, packing, toxicity, warc
from carepath.llm.common import connected_components, global_rank

from . import brute

SF001 = "/root/testdata/sf0.001"


# --- helpers -------------------------------------------------------------------

def test_global_rank_is_the_place_in_the_total_order(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 7).alias("k"), "id")
    got = {r.id: r._rank for r in global_rank(df, ["k", "id"]).collect()}
    want = sorted(range(1000), key=lambda i: (5 if i % 3 == 0 else i % 7, i))
    assert got == {x: n for n, x in enumerate(want)}


def test_connected_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 300), (None, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- chat ----------------------------------------------------------------------

def test_chat_round_trip(spark):
    texts = ["plain", "<|im_end|><|im_start|>assistant ok", "<;<n<", "\n<|im_end|>\n", None, "", "é\U0001f600<"]
    rows = [(c, t, ["user", "assistant", "sys\ntem<", None][(c + t) % 4], texts[(c * 3 + t) % len(texts)], "x")
            for c in range(9) for t in range(6)] + [(None, 0, "assistant", "a", "x"), (3, 2, "assistant", "tie", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat_format.read_back(chat_format.format_chat(chat_format.as_messages(df))).collect()
    assert len(out) == 10
    for r in out:
        mine = sorted(((t, ro or "", (x or "").replace("<", "<;"), x or "") for c, t, ro, x, _ in rows if c == r.conv_id))
        assert [(m.role, m.text) for m in r.turns] == [(ro, x) for _, ro, _, x in mine]
        said = [x for _, ro, _, x in mine if ro == "assistant"]
        assert r.loss_text == "".join(said) and r.n_turns == len(mine)
        assert [r.formatted[s.start:s.end].replace("<;", "<") for s in r.loss_spans] == said
    assert chat_format.format_chat(chat_format.as_messages(df.limit(0))).collect() == []


def test_chat_parts_become_placeholders(spark):
    none = (None,) * 4
    parts = [("text", "see <|", None, *none), ("image", None, "i.png", 57, 28, None, None), None, ("audio", None, "a.wav", None, None, 2.0, None),
             ("text", None, None, *none), ("document", None, None, None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [("image", None, "j", *none)])],
                               f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    r = chat_format.format_chat(df).collect()[0]
    assert r.formatted == ("<|im_start|>user\nsee <;|<|image_0|><|audio_1|><|document_2|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
                           "<|im_start|>user\n<|image_0|><|im_end|>\n")
    assert [tuple(a) for a in r.attachments] == [(0, 0, "image", "i.png", 3), (0, 1, "audio", "a.wav", 50), (0, 2, "document", None, 2304),
                                                 (2, 0, "image", "j", 0)]


def test_chat_plan_has_no_python(spark):
    rows = spark.read.parquet(f"{SF001}/conversations.parquet")
    plan = chat_format.read_back(chat_format.format_chat(chat_format.as_messages(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- packing -------------------------------------------------------------------

def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_optimal_boundaries_against_brute_force():
    r = random.Random(7)
    for _ in range(60):
        histogram = {x: r.choice([1, 1, 5, 40]) for x in r.sample(range(1, 60), r.randint(1, 9))}
        k = r.randint(1, 5)
        top = max(histogram)
        best = min(padding(histogram, [*c, top]) for n in range(k) for c in itertools.combinations(sorted(histogram), n))
        got = packing.optimal_boundaries(histogram, k)
        assert len(got) <= k and got[-1] == top and padding(histogram, got) == best
    assert packing.optimal_boundaries({}, 3) == []


def test_packing_batches(spark):
    r = random.Random(8)
    sizes = {i: r.choice([0, 1, 3, 50, 100, 101, 250]) for i in range(80)}
    rows = [(i, " ".join(["w"] * n), "x") for i, n in sizes.items()] + [(200, None, "x"), (3, " ".join(["w"] * sizes[3]), "x")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, batch string"), max_len=100, n_buckets=3, token_budget=300).collect()
    assert sum(p.n_tokens for p in out) == sum(sizes.values()) + sizes[3]
    assert all(p.n_tokens <= p.bucket_len <= 100 and p.start == p.piece * 100 for p in out)
    batches = collections.defaultdict(list)
    for p in out:
        batches[p.bucket, p.batch].append(p)
    for b in batches.values():
        assert sorted(p.slot for p in b) == list(range(len(b))) and len(b) * b[0].bucket_len <= 300
    for bucket, group in itertools.groupby(sorted(batches), key=lambda x: x[0]):
        full = 300 // batches[bucket, 0][0].bucket_len
        sizes_of = [len(batches[g]) for g in group]
        assert all(n == full for n in sizes_of[:-1])
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- mixing --------------------------------------------------------------------

def water_fill(sizes):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        rest, heavy = total - sum(target.values()), sum(w[s] for s in free)
        over = [s for s in free if w[s] * rest > 3 * sizes[s] * heavy]
        if not over:
            target |= {s: w[s] * rest / heavy for s in free}
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= set(over)
    return target


def test_mixing_meets_targets(spark):
    r = random.Random(9)
    rows = []
    for i in range(400):
        s = r.choice(["a", "a", "a", "Z", "é", None, "tiny"]) if i % 50 else "b"
        n = 0 if i % 37 == 0 else r.choice([1, 4, 30, 300])
        rows.append((i, " ".join(f"{i}_{j}" for j in range(1 if s == "tiny" else n)) or None, s, "x"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mix(df, shard_words=700).collect()
    assert len(out) == len(rows)
    by = {d: s for d, _, s, _ in rows}
    sizes, taken = collections.Counter(), collections.Counter()
    for o in out:
        sizes[by[o.doc_id]] += o.size
        taken[by[o.doc_id]] += o.taken
        assert 0 <= o.taken <= 3 * o.size
    want = water_fill(sizes)
    for o in out:
        assert o.source_size == sizes[by[o.doc_id]] and o.target == pytest.approx(want[by[o.doc_id]], rel=1e-12)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.05 * t + 3 * mixing.BLOCK
    again = mixing.mix(df.repartition(5), shard_words=700).collect()
    assert {(o.doc_id, o.taken) for o in out} == {(o.doc_id, o.taken) for o in again}
    texts = mixing.mixed_texts(df, shard_words=700)
    assert texts.columns == df.columns
    words = collections.Counter(w for t in texts.collect() for w in t.text.split())
    assert sum(words.values()) == sum(taken.values()) and max(words.values()) <= 3


def test_sainte_lague_against_brute_force(spark):
    r = random.Random(10)
    items = [(g, i, r.choice([1, 5, 40, 1000, 77])) for g in range(6) for i in range(r.randint(1, 8))]
    seats = {g: r.choice([0, 1, 3, 20, 500]) for g in range(6)}
    df = spark.createDataFrame([(g, i, float(s), seats[g]) for g, i, s in items], "g int, i int, s double, n long")
    got = {(x.g, x.i): x.quota for x in mixing.sainte_lague(df, "g", "i", "s", "n").collect()}
    for g in range(6):
        mine, q = {i: s for h, i, s in items if h == g}, collections.Counter()
        for _ in range(seats[g]):
            q[max(mine, key=lambda i: (mine[i] / (2 * q[i] + 1), -i))] += 1
        assert {i: got[g, i] for i in mine} == {i: q[i] for i in mine}


def test_mixing_takes_seeded_blocks_spread_over_a_shard(spark):
    """The rest of a quota is whole blocks, exactly as many, not one run; equal or missing ids spread over shards."""
    rows = [(None if i % 2 else 7, " ".join(f"{i}_{j}" for j in range(50)), s) for i in range(2000) for s in (["big"] if i % 4 else ["big", "small"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, shard_words=8192).collect()
    size = {"big": 100_000, "small": 25_000}
    by = {r.source_size: (r.target, 0) for r in out}
    for r in out:
        by[r.source_size] = (r.target, by[r.source_size][1] + r.taken)
        assert r.taken == r.passes * r.size + sum(x.n for x in r.runs) and all(0 < x.n <= 64 and 0 <= x.start <= r.size - x.n for x in r.runs)
    for z, (target, taken) in by.items():
        assert abs(taken - target) <= 64 * (z // 8192 + 2)          # less than a block a shard
    assert set(by) == set(size.values())
    taken = [r.taken / r.size for r in out if r.source_size == size["small"]]
    assert len({round(t, 2) for t in taken}) > 5                      # some rows wholly, some in part
    primes = mixing.primes_from(100, 4)
    assert primes == [101, 103, 107, 109]
    for blocks, stride in ((64, mixing.STRIDES[0]), (4097, mixing.STRIDES[3])):
        assert sorted(b * stride % blocks for b in range(blocks)) == list(range(blocks))


def test_mixing_empty_and_wordless(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert sorted((o.doc_id, o.size, o.source_size, o.target, o.taken) for o in mixing.mix(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix(df.limit(0)).collect() == []


# --- WARC ----------------------------------------------------------------------

PAGES = [(3, "http://a/x", "<p>same</p>"), (1, "http://a/y", "<p>same</p>"), (2, None, "<p>é\U0001f600</p>" * 500), (4, "http://b\n/", None),
         (5, "", ""), (1, "http://a/z", "<p>same</p>"), (None, "u", "<p>same</p>"), (6, "http://c/" + "q" * 9000, "x")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    path = f"file://{tmp_path}/w"
    got = warc.archive(df, path).collect()
    assert len(got) == len(PAGES)
    assert collections.Counter((r.record_id, r.payload_digest, r.payload_length) for r in got) == collections.Counter(
        (f"urn:page:{'' if i is None else i}", digest(h), len((h or "").encode())) for i, _, h in PAGES)
    kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in got)
    assert ("urn:page:3", "revisit", "urn:page:1") in kinds and ("urn:page:", "revisit", "urn:page:1") in kinds
    assert ("urn:page:5", "revisit", "urn:page:4") in kinds and kinds.count(("urn:page:1", "response", None)) == 2
    full = spark.read.format("warc").load(path)
    texts = {r.record_id: bytes(r.payload) for r in full.where("record_type = 'response'").collect()}
    assert texts["urn:page:2"].decode() == PAGES[2][2] and texts["urn:page:6"] == b"x"
    assert full.where("target_uri like 'http://a/%'").count() == 3
    assert full.where("record_id in ('urn:page:3', 'urn:page:6') and payload_length > 1").count() == 1
    assert warc.archive(df.limit(0), f"file://{tmp_path}/none").collect() == []


def test_warc_pushes_header_predicates(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith
    warc.register(spark)
    warc.archive(spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    reader = warc.WarcReader(f"file://{tmp_path}/w", True, False, 1)
    left = GreaterThan(("payload_length",), 1)
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), left, StringStartsWith(("target_uri",), "http")])) == [left]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["record_id"] for r in rows} == {"urn:page:3"} and rows[0]["payload"] is None


def test_warc_foreign_files_and_damage(spark, tmp_path):
    import gzip
    warc.register(spark)
    one = warc.record({"record_id": "a", "payload": b"hello", "record_type": "response", "payload_digest": digest("hello")})
    two = warc.record({"record_id": "b", "payload": b"z" * 9000, "record_type": "metadata"})
    (tmp_path / "x.warc").write_bytes(one + two)
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(two) + gzip.compress(one))
    df = spark.read.format("warc").option("verify", "true").load(f"file://{tmp_path}")
    assert sorted((r.record_id, len(r.payload)) for r in df.collect()) == [("a", 5), ("a", 5), ("b", 9000), ("b", 9000)]
    assert df.where("record_type = 'response'").count() == 2
    (tmp_path / "z.warc").write_bytes(one.replace(b"hello", b"hullo"))
    with pytest.raises(Exception, match="digest"):
        df = spark.read.format("warc").option("verify", "true").load(f"file://{tmp_path}").collect()


# --- HTML ----------------------------------------------------------------------

def test_html_blocks():
    page = ("<html><head><title>t</title></head><body><header>h</header><nav><p>menu</p></nav><main><h1>A &amp; B&#33;</h1><p>one\n  two<b>3</b>"
            "<br>four<p>five<script>var x='<p>no</p>'</script><div class='ad-box'>buy</div><form>f</form><section id='comments'>c</section>"
            "<ul><li>x<li>y</ul>&lt;i&gt;</main><aside>s</aside><!-- c --><footer>f</footer>")
    assert [t for role, t in html_extract.blocks_of(page) if role == html_extract.MAIN] == ["A & B!", "one two3", "four", "five", "x", "y", "<i>"]
    assert html_extract.blocks_of(None) == html_extract.blocks_of("") == []
    assert html_extract.blocks_of("text <b>only") == [(html_extract.OPEN, "text only")]


def lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(11)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(0, 14)), rng.integers(0, 6, rng.integers(0, 14))
        on = html_extract.shared_lines(a, b)
        assert on.sum() == lcs(a, b)
        at = 0
        for x in a[on]:                                    # and it is a subsequence of b
            at = next(j for j in range(at, len(b)) if b[j] == x) + 1


def test_html_extract_differences_pages_without_an_article(spark):
    page = "<body><div>Top</div><p>own {0}</p><p>and {0}</p><div>Bottom</div></body>"
    rows = [(i, f"http://h/a/{i}?q", page.format(i), 1) for i in range(5)]
    rows += [(10, "http://alone/x", page.format(10), 1), (11, "http://h/a/0z", "<article><p>Top</p> kept</article><p>no</p>", 1),
             (12, None, None, 1), (13, "http://h/zz", "", 1), (14, "http://r/1", "<p>twin</p>", 1), (14, "http://r/1", "<p>twin</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_extract.html_extract(df).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [by[i] for i in range(1, 5)] == [f"own {i} and {i}" for i in range(1, 5)]
    assert by[10] == "Top own 10 and 10 Bottom" and by[11] == "Top kept" and by[12] == by[13] == "" and by[14] == "twin"
    assert html_extract.html_extract(df.limit(0)).collect() == []


def test_html_extract_keeps_copies_and_pairs_with_marked_pages(spark):
    page = "<body><div>Top</div><p>own {0}</p><div>Bottom</div></body>"
    marked = "<body><div>Top</div><article>{0}</article><div>Bottom</div></body>"
    rows = [(1, "http://c/a/1", page.format(1)), (2, "http://c/a/1b", page.format(1)), (2, "http://c/a/1b", page.format(1)), (3, "http://c/a/2", page.format(3)),
            (4, "http://d/1", page.format(4)), (5, "http://d/2", page.format(4)), (6, "http://e/1", marked.format("x")),
            (7, "http://e/2", page.format(7)), (8, "http://e/3", marked.format("y")), (9, "http://f/1", "<p>twin</p>"), (9, "http://f/1", "<p>twin</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id, r.text) for r in html_extract.html_extract(df).collect()) == [
        (1, "own 1"), (2, "own 1"), (2, "own 1"), (3, "own 3"), (4, "Top own 4 Bottom"), (5, "Top own 4 Bottom"), (6, "x"),
        (7, "own 7"), (8, "y"), (9, "twin"), (9, "twin")]
    assert html_extract.html_extract(df.limit(0)).collect() == []


def test_html_names_drop_as_a_whole_and_on_containers_only():
    kept = lambda page: " ".join(t for _, t in html_extract.blocks_of(page))
    page = ("<article><section id='related-work'><h2>Related</h2></section><h1 id='alert-handling'>Alerts</h1><p class='notice'>Mind</p>"
            "<div class='article-header'><h1>Title</h1></div><div class='ad'>buy</div><div class='box cookie-banner'>ok</div>"
            "<div id='comments-area'>c</div><aside>s</aside>end</article>")
    assert kept(page) == "Related Alerts Mind Title end"
    for name in ("ad", "Ads", "site-footer", "main_nav", "x sidebar", "newsletter-box", "comments", "share"):
        assert kept(f"<div class='{name}'>gone</div><div>stays</div>") == "stays", name
    for name in ("related-work", "admin", "headers-and-more", "share-price", "navy", "reader-notice-history", "footnotes"):
        assert kept(f"<div class='{name}'>here</div><div>stays</div>") == "here stays", name
    assert kept("<article class='comment'>no</article><article class='related'>yes</article><p class='ad'>no</p>") == "yes"


def test_html_missing_end_tags_do_not_empty_a_page():
    kept = lambda page: " ".join(t for _, t in html_extract.blocks_of(page))
    assert kept("<nav><a>menu</a><article><p>text</p></article>") == "text"
    assert kept("<div class='ad'>buy <main>text</main>") == "text"
    assert kept("<nav><a>menu</a><div><p>text</p></div>") == "menu text"          # nothing else would be left
    assert kept("<aside><article>teaser</article></aside><p>text</p>") == "text"    # closed: the teaser goes with it
    assert kept("<script>var a = 1; <p>text") == ""


def test_html_extract_near_copies_and_teasers_keep_their_text(spark):
    near = "<p>alpha one</p><p>beta two</p><p>gamma three{0}</p>"
    long = ["".join(f"<p>paragraph {i} of a long text with its own words {i * i}</p>" for i in range(20))] * 2
    long[1] = long[1].replace("paragraph 7 of a long", "something quite else, not")
    page = "<div>Top of the site</div>{0}<div>Bottom of the site</div>"
    texts = {i: f"<p>story {i} {'abcdefgh'[i % 8]}{i} about</p><p>thing{i} thing{i + 50}</p>" for i in range(12)}
    teaser = "<article>teaser</article><div>the page's real text stands beside it</div>"
    rows = [(1, "http://n/1", near.format("")), (2, "http://n/2", near.format(" changed")),
            (3, "http://l/1", long[0]), (4, "http://l/2", long[1]),
            (5, "http://t/1", teaser), (6, "http://u/x", "<article>whole article text here</article><div>side</div>")]
    rows += [(100 + i, f"http://m/a/{i:02d}", page.format(texts[i // 3] + f"<p>version {i}</p>")) for i in range(12)]     # runs of near copies
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
    assert got[1] == "alpha one beta two gamma three" and got[2] == "alpha one beta two gamma three changed"
    assert got[3].count("paragraph") == 20 and got[4].count("paragraph") == 19 and "something quite else" in got[4]
    assert got[5] == "teaser the page's real text stands beside it" and got[6] == "whole article text here"
    for i in range(12):
        assert got[100 + i] == f"story {i // 3} {'abcd'[i // 3]}{i // 3} about thing{i // 3} thing{i // 3 + 50} version {i}"


def test_html_extract_differences_marked_pages_too(spark):
    page = "<main><div>Read on paper</div><article><p>own {0} text</p><p>said again</p></article><div>Written by {0}</div></main><div>Bottom</div>"
    short = "<div>Welcome to the long line on top</div><article><p>{0}</p><p>said again</p></article>"
    rows = [(i, f"http://h/a/{i}", page.format(i)) for i in range(4)]
    rows += [(10 + i, f"http://m/{i}", f"<main><p>{i} and its words</p><p>said again</p></main>") for i in range(3)]     # main without an article
    rows += [(20 + i, f"http://s/{i}", short.format(t)) for i, t in enumerate(("alpha one stands here", "beta two lies below", "gamma 3 runs away"))]
    rows += [(30, "http://x/1", "<div>Read on paper</div><p>all its own</p>"), (31, "http://x/2", page.format(31)), (32, "http://y/1", page.format(32))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
    for i in range(4):
        assert got[i] == f"own {i} text said again Written by {i}"      # lines around the article go where pages share them
    assert [got[10 + i] for i in range(3)] == [f"{i} and its words said again" for i in range(3)]
    assert [got[20 + i] for i in range(3)] == ["alpha one stands here said again", "beta two lies below said again", "gamma 3 runs away said again"]
    assert got[30] == "Read on paper all its own" and got[31] == "own 31 text said again Written by 31"     # the only marked page pairs with another
    assert got[32] == "Read on paper own 32 text said again Written by 32"                                      # a page alone loses nothing


def test_html_extract_on_the_pages_table(spark):
    import html
    import re
    df = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
    for r in df.collect():
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


# --- toxicity ------------------------------------------------------------------

def test_toxicity_learns_and_generalises_to_misspellings(spark):
    r = random.Random(12)
    syllables = ["ta", "re", "mo", "li", "sen", "dor", "pu", "kan"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 3)))
    bad = ["zloxful", "grunkish", "vrakhead"]
    docs, labels = [], []
    for i in range(700):
        words = [word() for _ in range(r.choice([12, 60, 200]))]
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words), "x"))
        if i < 600:
            labels.append((i, int(toxic), "y"))
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, " ".join(word() for _ in range(300)) + " ZLOXFULL, " + word(), "x"), (None, word(), "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    la = spark.createDataFrame(labels + [(3, None, "y"), (5, 0, "y"), (None, 1, "y")], "doc_id long, toxic int, text string")
    out = {x.doc_id: x for x in toxicity.toxicity(d, la).collect()}
    assert len(out) == len(docs)
    import zlib
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in out.items() if i is not None)
    hits = [out[i].predicted == (i % 4 == 0) for i in range(700) if out[i].held_out or i >= 600]
    assert np.mean(hits) > 0.97
    assert out[1000].score == out[1001].score == 0
    # One word misspelt among 300 clean ones stands out from all but a few clean texts.
    clean = [out[i].score for i in range(700) if i % 4]
    assert np.mean(np.array(clean) < out[1002].score) > 0.97
    kept = toxicity.clean_documents(d, la)
    assert kept.columns == d.columns and {x.doc_id for x in kept.collect()} == {i for i, x in out.items() if not x.predicted}
    none = toxicity.toxicity(d, la.where("toxic = 0")).collect()
    assert {x.score for x in none} == {0.0}
    assert toxicity.toxicity(d.limit(0), la).collect() == []


# --- nearest neighbours --------------------------------------------------------

def test_hilbert_index_visits_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = cells[np.argsort(hilbert_ann.hilbert_index(cells, bits))]
        assert sorted(hilbert_ann.hilbert_index(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def exact_neighbours(data, k=20):
    good = {i: np.array(v, float) for i, v in data if v is not None and len(v) == 16 and np.all(np.isfinite(v)) and np.any(v)}
    out = {}
    for q in good:
        if q % 20 == 0:
            out[q] = sorted(((-float(sum(x * y for x, y in zip(good[q], v))), i) for i, v in good.items() if i != q))[:k]
    return out


def test_ann_is_exact_in_one_block_and_close_in_many(spark):
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((30, 16))
    data = [(i, (centres[i % 30] + rng.standard_normal(16) * 0.4).tolist()) for i in range(1500)]
    data += [(2000, None), (2001, [0.0] * 16), (2020, [float("inf")] * 16), (2003, [1.0]), (2040, data[40][1]), (2041, data[40][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<double>, score string")
    want = exact_neighbours(data)

    def run(**options):
        out = collections.defaultdict(list)
        for r in sorted(hilbert_ann.hilbert_ann(df, **options).collect(), key=lambda r: (r.query_id, r.rank)):
            out[r.query_id].append((-r.score, r.vec_id))
            assert r.rank == len(out[r.query_id])
        return out

    assert {q: [i for _, i in v] for q, v in run().items()} == {q: [i for _, i in v] for q, v in want.items()}
    some = run(block=64)
    hits = sum(len({i for _, i in some[q]} & {i for _, i in v}) for q, v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_ann_small_and_empty(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.0]), (22, [3.0, 1.0]), (None, [1.0, 1.0]), (21, [0.5, 0.0])],
                               "vec_id long, embedding array<float>")
    assert sorted(map(tuple, hilbert_ann.hilbert_ann(df).collect())) == [(20, 1, 22, 3.0), (20, 2, 21, 0.5)]
    assert hilbert_ann.hilbert_ann(df.limit(0)).collect() == []
    assert hilbert_ann.hilbert_ann(df.where("vec_id <> 20")).collect() == []


def test_hilbert_ann_searches_every_length_and_every_row_of_an_id(spark):
    rng = np.random.default_rng(21)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, dim)]) for dim in (2, 5) for i in rng.integers(0, 60, 80)]
    rows += [rows[0], (20, [1.0, 2.0]), (20, [1.0, 2.0, 2.0, 2.0, 2.0]), (40, [9.0]), (41, None), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, key string")
    units = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and any(v)})
    want = []
    for i, q in units:
        if i % 20 == 0:
            near = sorted((-sum(x * y for x, y in zip(q, v)), j) for j, v in units if len(v) == len(q) and (j, v) != (i, q))[:20]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    assert sorted(map(tuple, hilbert_ann.hilbert_ann(df).collect())) == sorted(want)


def test_hilbert_ann_never_reads_more_than_exact_search():
    assert hilbert_ann.cheapest_curves([5000, 4900, 4800, 4700], 1024, 10_000) == 1
    assert hilbert_ann.cheapest_curves([4000, 300, 250, 240], 64, 10_000) == 2


def test_hilbert_ann_lists_grow_with_queries_not_with_blocks(spark):
    # Vectors without structure are read whole: each query's lists come per slab, however many blocks these have.
    rng = np.random.default_rng(5)
    data = [(i, rng.standard_normal(16).tolist()) for i in range(2000)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = hilbert_ann.cut(hilbert_ann.unit_vectors(df, "vec_id", "embedding").withColumn("key", F.monotonically_increasing_id()), "vectors")
    met = hilbert_ann._search(vectors, 16, 20, 20, hilbert_ann.CURVES, 16, 1.0).groupBy("asked").count().collect()
    assert len(met) == 100 and max(r["count"] for r in met) <= 20 * (hilbert_ann.SLABS + 1) * hilbert_ann.CURVES
    got = collections.defaultdict(list)
    for r in sorted(hilbert_ann.hilbert_ann(df, block=16, recall=1.0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert sum(len(set(got[q]) & {i for _, i in v}) for q, v in exact_neighbours(data).items()) >= 0.97 * 2000


def test_met_streams_slabs_over_batches():
    rng = np.random.default_rng(6)
    rows = []
    for slab in range(3):
        rows += [(0, slab, 0, -1, 1000 * slab + i, i, rng.standard_normal(4)) for i in range(5)] * (slab != 1)
        rows += [(0, slab, 0, i // 8, 1000 * slab + i, i, rng.standard_normal(4)) for i in range(40)]
    pdf = pd.DataFrame(rows, columns=["curve", "slab", "salt", "part", "key", "id", "v"])
    want = set()
    for slab in (0, 2):
        some = pdf[pdf.slab == slab]
        for _, q in some[some.part < 0].iterrows():
            near = sorted((-float(q.v @ r.v), r.id, r.key) for _, r in some[some.part >= 0].iterrows() if r.key != q.key)[:6]
            want |= {(q.key, key) for _, _, key in near}
    for size in (7, 1000):
        met = pd.concat(hilbert_ann._met((pdf[i:i + size] for i in range(0, len(pdf), size)), 6, 8))
        assert len(met) == len(want) and set(zip(met.asked, met.key)) == want
