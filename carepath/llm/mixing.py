"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Every source's target is its weight's share of all words, stopped at
   ``max_repeat`` times its size; what is over goes to the other sources by
   weight until none is above.
2. The targets, in equal blocks of ``block`` words (one-word blocks for sources
   of fewer than ``MIN_BLOCKS`` blocks, which are apportioned among themselves), are apportioned to the
   sources by highest quotients target / (2 q + 1), then each source's blocks
   to its hash shards by highest quotients size / (2 q + 1): integer quotas.
3. Inside a shard the documents lie end to end in a seeded order and are cut
   into blocks.  A quota makes whole passes over the shard, and the rest are
   seeded blocks: those whose number, put through a seeded permutation of the
   shard's blocks (times a prime, plus an offset), comes out below the rest.  So exactly
   that many blocks are taken, spread over the shard, and each row finds its
   own without a table of blocks.

A shard holds about ``shard_words`` words, by hash of id and text, and a source
has as many as its size asks for: a source with a third of all rows is many window
groups, not one, and so are rows that share an id or have none.  Sizes are
counted once and written.  The quota tables have a row per source and per shard and stay in
Spark; only scalars (totals and the words left to share) pass through the driver.

Defined cases: null text has size 0; a document without words takes nothing; a
null source is a source of its own, last in order; repeated rows are documents
of their own (equal rows are interchangeable and share a shard); with no words at all every target is 0;
other columns are carried along by ``mixed_texts`` and play no part in the choice.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut, global_rank, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT, BLOCK, MIN_BLOCKS, SHARD_WORDS, SEED = 3, 64, 64, 1 << 18, 71


def primes_from(start: int, n: int) -> list[int]:
    """The first ``n`` primes that aren't below ``start``."""
    out, x = [], start | 1
    while len(out) < n:
        if all(x % d for d in range(3, int(x ** 0.5) + 1, 2)):
            out.append(x)
        x += 2
    return out


#: Larger than any number of blocks in a shard, hence without a common factor.
STRIDES = primes_from(1_500_000_000, 16)


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add weight and target to (_s, source, source_size)."""
    ranked = global_rank(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"])
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    src = cut(ranked.withColumn("weight", w).drop("_null", "_rank"), "sources")
    big = "decimal(38,0)"
    cap = (F.col("source_size") * max_repeat).cast(big)
    total, heavy = src.agg(F.sum(F.col("source_size").cast(big)), F.sum("weight")).first()
    rest, heavy = int(total or 0), int(heavy or 0)
    whole, stopped = rest, -1
    while heavy:                       # the set of stopped sources only grows
        over = F.col("weight").cast(big) * F.lit(rest).cast(big) > cap * F.lit(heavy).cast(big)
        n, used, w_used = src.where(over).agg(F.count("*"), F.sum(cap), F.sum("weight")).first()
        if n == stopped:
            break
        stopped, rest = n, whole - int(used or 0)
        heavy = int(src.agg(F.sum("weight")).first()[0]) - int(w_used or 0)
    if not heavy:
        return src.withColumn("target", cap.cast("double"))
    share = F.col("weight") * F.lit(float(Fraction(rest, heavy)))
    over = F.col("weight").cast(big) * F.lit(rest).cast(big) > cap * F.lit(heavy).cast(big)
    return src.withColumn("target", F.when(over, cap.cast("double")).otherwise(share))


def sainte_lague(items: DataFrame, group: str, item: str, size: str, seats: str) -> DataFrame:
    """(group, item, quota): the group's seats by highest quotients size / (2 q + 1).

    A divisor that surely gives too few and one that surely gives too many
    bound every quota; only quotients between the two (at most about two per
    item) are ranked."""
    stats = items.groupBy(group).agg(F.sum(size).alias("_w"), F.count("*").alias("_k"),
                                     F.max(size).alias("_top"), F.max(seats).alias("_n"))
    k2 = F.col("_k") / 2
    stats = stats.select(group, "_n", (F.col("_w") / (F.col("_n") + k2)).alias("_low"),
                         F.when(F.col("_n") > k2, F.col("_w") / (F.col("_n") - k2))
                         .otherwise(F.col("_top") * 2.0000001).alias("_high"))
    at = lambda d: F.when(F.col(d) > 0, F.floor(F.col(size) / F.col(d) + 0.5)).otherwise(0).cast("long")
    base = cut(items.join(stats, group).select(group, item, size, "_n", at("_high").alias("_few"), at("_low").alias("_many")), "seats")
    left = base.groupBy(group).agg((F.max("_n") - F.sum("_few")).alias("_left"))
    quotients = (base.where("_many > _few")
                 .select(group, item, size, F.explode(F.sequence(F.col("_few") + 1, F.col("_many"))).alias("_q"))
                 .withColumn("_neg", -F.col(size) / (F.col("_q") - 0.5)))
    ranked = global_rank(quotients, [group, "_neg", item, "_q"])
    firsts = ranked.groupBy(group).agg(F.min("_rank").alias("_first"))
    won = (ranked.join(firsts, group).join(left, group).where("_rank - _first < _left")
           .groupBy(group, item).agg(F.count("*").alias("_won")))
    return (base.join(won, [group, item], "left")
            .select(group, item, (F.col("_few") + F.coalesce("_won", F.lit(0))).alias("quota")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block: int = BLOCK, shard_words: int = SHARD_WORDS,
        seed: int = SEED, carry: bool = False) -> DataFrame:
    """Per row: ``id_col``, size, source_size, target, taken, and the parts
    taken: passes (whole repeats), runs (array of (start, n) in words).  With
    ``carry`` the whole input row comes along as the struct ``_row``."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_h"),
                       *([F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if carry else []))
    rows = cut(rows.withColumn("_s", F.xxhash64(F.col("source").isNull(), "source")), "sizes")
    sources = rows.groupBy("_s", "source").agg(F.sum("size").alias("source_size"))
    src = cut(targets(sources, weights, max_repeat).withColumn("_unit", F.when(F.col("source_size") >= MIN_BLOCKS * block, block).otherwise(1)), "targets")
    rows = rows.join(src.select("_s", "source_size", "target", "_unit", F.ceil(F.col("source_size") / shard_words).alias("_n")), "_s")
    rows = rows.withColumn("_shard", F.when(F.col("_n") > 0, F.pmod(F.xxhash64(F.lit(seed + 1), "_h"), F.col("_n"))).otherwise(0)).drop("_n")

    seats = src.join(src.groupBy("_unit").agg(F.round(F.sum("target") / F.first("_unit")).cast("long").alias("_seats")), "_unit")
    per_source = sainte_lague(seats, "_unit", "_s", "target", "_seats").select("_s", "_unit", F.col("quota").alias("_seats"))
    shards = cut(rows.where("size > 0").groupBy("_s", "_shard").agg(F.sum("size").alias("_z")), "shards")
    quotas = sainte_lague(shards.join(per_source, "_s"), "_s", "_shard", "_z", "_seats")
    seeded = F.xxhash64(F.lit(seed + 2), "_s", "_shard")
    plan = cut(shards.join(quotas, ["_s", "_shard"]).join(per_source.select("_s", "_unit"), "_s")
               .withColumn("_blocks", F.ceil(F.col("_z") / F.col("_unit")))
               .withColumn("_quota", F.least("quota", F.col("_blocks") * max_repeat))
               .select("_s", "_shard", "_blocks", F.floor(F.col("_quota") / F.col("_blocks")).cast("int").alias("passes"),
                       (F.col("_quota") % F.col("_blocks")).alias("_rest"), F.pmod(seeded, F.col("_blocks")).alias("_offset"),
                       F.element_at(F.array(*[F.lit(x).cast("long") for x in STRIDES]),
                                    (F.pmod(F.shiftrightunsigned(seeded, 32), F.lit(len(STRIDES))) + 1).cast("int")).alias("_stride")), "plan")

    w = Window.partitionBy("_s", "_shard").orderBy("_h", "_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = rows.where("size > 0").withColumn("_end", F.sum("size").over(w)).withColumn("_begin", F.col("_end") - F.col("size"))
    sized = sized.join(plan, ["_s", "_shard"])
    unit = F.col("_unit")

    def part(b):
        low, high = F.greatest(b * unit, F.col("_begin")), F.least((b + 1) * unit, F.col("_end"))
        return F.when(F.pmod(b * F.col("_stride") + F.col("_offset"), F.col("_blocks")) < F.col("_rest"),
                      F.struct((low - F.col("_begin")).alias("start"), (high - low).alias("n")))

    blocks = F.sequence(F.expr("_begin div _unit"), F.expr("(_end - 1) div _unit"))
    sized = sized.withColumn("runs", F.filter(F.transform(blocks, part), lambda p: p.isNotNull()))
    taken = F.col("passes") * F.col("size") + F.aggregate("runs", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    cols = ["_id", "size", "source_size", "target", "taken", "passes", "runs"] + (["_row"] if carry else [])
    sized = sized.withColumn("taken", taken).select(*cols)
    bare = (rows.where("size = 0").withColumns({"taken": F.lit(0).cast("long"), "passes": F.lit(0),
                                                "runs": F.array().cast("array<struct<start:bigint,n:bigint>>")}).select(*cols))
    return sized.unionByName(bare).withColumnRenamed("_id", id_col)


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per whole pass of a
    document and one for its part (the words of its blocks, joined by one space).
    ``n_chars``, where there is one, is counted anew on parts."""
    mixed = mix(docs, id_col, text_col, source_col, carry=True, **options).where("taken > 0")
    # One row per pass, and one that is the part.
    copies = F.concat(F.array_repeat(F.lit(False), F.col("passes")), F.array_repeat(F.lit(True), F.when(F.size("runs") > 0, 1).otherwise(0)))
    mixed = mixed.select("_row", "runs", F.explode(copies).alias("_is_part"))
    words = F.regexp_extract_all(F.col("_row")[text_col], F.lit(WORD_PATTERN), F.lit(0))
    some = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(words, (r["start"] + 1).cast("int"), r["n"].cast("int")))), " ")
    mixed = mixed.select("_row", "_is_part", F.when(F.col("_is_part"), some).alias("_part"))
    cols = []
    for c in docs.columns:
        col = F.col("_row")[c]
        if c == text_col:
            col = F.when(F.col("_is_part"), F.col("_part")).otherwise(col)
        elif c == "n_chars":
            col = F.when(F.col("_is_part"), F.length("_part").cast(docs.schema[c].dataType)).otherwise(col)
        cols.append(col.alias(c))
    return mixed.select(*cols)
