import collections

import corpus_pipeline

from carepath.llm.common import cut

from . import brute

SF001 = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][1:] == ["minhash near-dedup", "substring dedup", "mixing to target weights", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = cut(stage(spark, docs, SF001), "test")
        rows = out.collect()
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").where("toxic = 1 and crc32(cast(doc_id as string)) % 3 <> 1").collect()}
            kept = {r.doc_id for r in rows}
            assert len(kept & toxic) <= 0.2 * len(toxic) and len(kept) >= 0.8 * (len(before) - len(toxic))
        if name == "minhash near-dedup":
            assert sorted(r.doc_id for r in rows) == [d for d, _, _, keep in brute.near_duplicates(before, 5) if keep]
        if name == "substring dedup":
            want = {d: (n - gone) for d, n, gone, _ in brute.substring(before)}
            assert {r.doc_id: len(brute.WORDS.findall(r.text)) for r in rows} == want
        if name == "mixing to target weights":
            words = sum(len(brute.WORDS.findall(t)) for _, t in before)
            assert abs(sum(len(brute.WORDS.findall(r.text)) for r in rows) - words) < 0.05 * words
        if name == "packing":
            assert sum(r.n_tokens for r in rows) == sum(len(brute.WORDS.findall(t)) for _, t in before)
            batches = collections.Counter((r.bucket, r.batch, r.bucket_len) for r in rows)
            assert all(n * size <= 16384 for (_, _, size), n in batches.items())
        else:
            assert out.columns == columns
        docs = out


def test_near_dedup_judges_rows_not_ids(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    rows = [(0, t), (1, t), (1, "quite another text of its own"), (7, u), (7, u), (None, u), (None, None), (None, ""), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x or ""), 5) for i, x in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, component_id int")
    out = dict(corpus_pipeline.STAGES)["minhash near-dedup"](spark, docs, SF001)
    assert out.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=key) == sorted(
        [(0, t), (1, "quite another text of its own"), (7, u), (None, None), (None, ""), (3, ""), (3, "")], key=key)


def test_defined_cases_in_every_stage(spark):
    """Null ids, repeated rows, null and empty texts and columns with clashing names go through all stages."""
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    passage = words("p", 60)
    rows = [(1, words("a", 80)), (1, words("b", 80)), (2, words("c", 40) + " " + passage), (3, words("d", 40) + " " + passage),
            (None, words("e", 90)), (None, words("f", 90)), (4, None), (5, ""), (None, None), (6, words("g", 70)), (6, words("g", 70))]
    names = ["_row", "size", "taken", "_text", "component_id", "kept", "bucket", "score"]
    docs = spark.createDataFrame([(i, x, "en", None if j % 3 else "s", len(x or ""), *range(len(names))) for j, (i, x) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    stages = dict(corpus_pipeline.STAGES)
    text = lambda df: sorted((r.text or "") for r in df.collect())
    clean = cut(stages["toxicity"](spark, docs, SF001), "cases")
    assert clean.columns == docs.columns and text(clean.where("text is null or text = ''")) == [""] * 3
    unique = cut(stages["minhash near-dedup"](spark, docs, SF001), "cases")
    assert unique.columns == docs.columns and unique.count() == len(rows) - 1           # one of the equal rows goes
    cut_out = cut(stages["substring dedup"](spark, unique, SF001), "cases")
    assert cut_out.columns == docs.columns and cut_out.count() == unique.count() and cut_out.where("text is null").count() == 2
    assert not any("p1 " in t for t in text(cut_out)) and sum("c39" in t for t in text(cut_out)) == 1
    mixed = cut(stages["mixing to target weights"](spark, cut_out, SF001), "cases")
    assert mixed.columns == docs.columns and {r._row for r in mixed.collect()} == {0} and mixed.where("text is null or text = ''").isEmpty()
    total = sum(len((t or "").split()) for t in text(cut_out))
    assert abs(sum(len(t.split()) for t in text(mixed)) - total) <= 2
    packed = stages["packing"](spark, mixed, SF001).collect()
    assert sum(r.n_tokens for r in packed) == sum(len(t.split()) for t in text(mixed))


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF001), "empty")
        assert docs.count() == 0
