"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source's documents lie one after the other in a seeded order, cut into blocks of
``block`` words. The words of the mix are whole blocks: their number per source and shard is
apportioned by highest quotients, and a source's blocks are drawn from a seeded start,
around and around. Everything but the word counts is arithmetic on sources and on positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL = 1.5
REPEAT_LIMIT = 2.0
BLOCK_WORDS = 16
SHARDS = 8
SEED = 7

_WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` and the keys ``_src`` (never null) and ``_key`` (place in the seeded order)."""
    return docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        word_count().alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_src"),
        F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("_key"),
    )


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, limit: float = REPEAT_LIMIT
) -> DataFrame:
    """``_src, source_size, place, target``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``total`` times all words. No target
    exceeds ``limit`` times its source: the smallest ratios of limit to weight are filled up first, what is left is
    shared by weight among the others. Windows over all sources hold one row per source.
    """
    sums = sized.groupBy("_src", "source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    places = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    weighed = (
        sums.withColumn("place", places)
        .withColumn("w", weight)
        .withColumn("most", F.col("source_size") * F.lit(limit))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * F.lit(total))
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after)
    levelled = weighed.withColumn("level", level)
    open_ = F.col("most") > F.col("w") * F.col("level")
    # The level at the first source that its share does not fill holds for all after it.
    first = F.min(F.when(open_, F.struct(F.col("most") / F.col("w"), "place", "level"))).over(Window.partitionBy())
    return levelled.withColumn("share", first["level"]).select(
        "_src",
        "source_size",
        "place",
        F.coalesce(F.least("most", F.col("w") * F.col("share")), F.col("most")).alias("target"),
    )


def block_quotas(targets: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """``_src, shard, upto``: blocks that a source gives to the shards 0 to ``shard`` together.

    Sainte-Lague: the seats of a house go to the highest quotients target / (2k + 1). A house of more seats gives
    every source as many or more, so the difference of two cumulative houses is a shard's quota. Rounding lets a
    source's seats differ from its ideal share by half a seat plus its share of half a seat per source; only
    those seats compete, the ones below are sure.
    """
    houses = targets.withColumns(
        {"sum": F.sum("target").over(Window.partitionBy()), "sources": F.count(F.lit(1)).over(Window.partitionBy())}
    ).where("target > 0")
    houses = houses.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "seats", F.floor(F.round(F.col("sum") / block) * (F.col("shard") + 1) / shards)
    )
    ideal = F.floor(F.col("target") / F.col("sum") * F.col("seats"))
    width = F.ceil(F.col("target") / F.col("sum") * F.col("sources") / 2) + 1
    sure = houses.withColumn("sure", F.greatest(F.lit(0), ideal - width)).withColumn("open", ideal + width - F.col("sure"))
    left = sure.withColumn("left", F.col("seats") - F.sum("sure").over(Window.partitionBy("shard")))
    rivals = left.withColumn("k", F.explode(F.expr("sequence(sure, sure + open)")))
    best = Window.partitionBy("shard").orderBy(F.desc(F.col("target") / (2 * F.col("k") + 1)), "place", "k")
    won = rivals.withColumn("rank", F.row_number().over(best))
    return won.groupBy("_src", "shard").agg(
        (F.max("sure") + F.sum(F.when(F.col("rank") <= F.col("left"), 1).otherwise(0))).cast("bigint").alias("upto")
    )


def mixed_ranges(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    total: float = TOTAL,
    limit: float = REPEAT_LIMIT,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
) -> DataFrame:
    """What the mix takes of each row of ``docs``: ``doc_id, source, size, source_size, target, full`` (times that it
    is taken whole), ``ranges`` (word ranges [from, to) taken once more), ``shard`` (of its first copy, null if
    none is taken) and ``taken`` words.

    A null text has no words; null sources are one source. The order within a source follows from the id, so reruns
    agree; rows with equal ids and sizes are interchangeable. A source's order is summed up in 256 parts, so one that holds
    a third of the rows is no single group. An empty table gives no rows.
    """
    sized = land(sized_documents(docs), "sized")
    part = F.substring("_key", 1, 2)
    targets = land(source_targets(sized, weights, total, limit), "targets")
    quotas = block_quotas(targets, block, shards).groupBy("_src").agg(
        F.sort_array(F.collect_list(F.struct("shard", "upto"))).alias("quotas")
    )
    sources = targets.join(quotas, "_src", "left").withColumns(
        {
            "blocks": F.ceil(F.col("source_size") / block),
            "seeded": F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), "_src").cast("binary")), 1, 8), 16, 10).cast("bigint"),
        }
    )
    whole = F.greatest("blocks", F.lit(1))
    sources = sources.withColumn(
        "drawn", F.least(F.coalesce(F.element_at("quotas", -1)["upto"], F.lit(0)), (F.col("blocks") * limit).cast("bigint"))
    ).select(
        "_src",
        "source_size",
        "target",
        "quotas",
        "blocks",
        F.expr("drawn div greatest(blocks, 1)").alias("full"),
        (F.col("seeded") % whole).alias("start"),
        ((F.col("seeded") % whole) + F.col("drawn") % whole).alias("stop"),
    )
    sums = sized.groupBy("_src", part.alias("_part")).agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("_src", "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first"))
    within = (
        Window.partitionBy("_src", "_part").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        sized.withColumn("_part", part)
        .join(firsts, ["_src", "_part"])
        .withColumn("_end", F.col("_first") + F.sum("size").over(within))
        .withColumn("_begin", F.col("_end") - F.col("size"))
        .join(sources, "_src")
    )

    def overlap(start: Column, stop: Column) -> Column:
        low = F.greatest(F.col("_begin"), start * block) - F.col("_begin")
        high = F.least(F.col("_end"), stop * block) - F.col("_begin")
        return F.struct(low.cast("bigint").alias("from"), high.cast("bigint").alias("to"))

    around = F.greatest(F.col("stop") - F.col("blocks"), F.lit(0))
    ranges = F.array_compact(
        F.transform(
            F.array(overlap(F.lit(0), around), overlap(F.col("start"), F.least("stop", "blocks"))),
            lambda r: F.when(r["to"] > r["from"], r),
        )
    )
    extra = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda s, r: s + r["to"] - r["from"])
    first_word = F.when(F.col("full") > 0, F.col("_begin")).otherwise(F.col("_begin") + F.element_at("ranges", 1)["from"])
    draw = F.pmod(F.floor(first_word / block) - F.col("start"), F.greatest("blocks", F.lit(1)))
    shard = F.element_at(F.filter("quotas", lambda q: draw < q["upto"]), 1)["shard"]
    return (
        placed.withColumn("ranges", ranges)
        .withColumn("taken", F.col("full") * F.col("size") + extra)
        .withColumn("shard", F.when(F.col("taken") > 0, shard))
        .select("doc_id", "source", "size", "source_size", "target", "full", "ranges", "shard", "taken")
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of the mix: a document comes as often as it is taken whole, and once more for each range.

    Rows of a range that leaves words out hold the range's words joined by blanks, and ``n_chars``, if there
    is one, anew; other rows stay as they are. Columns stay those of ``docs``. Rows with equal id, source
    and size are told apart by their number, so each gets the copies of one of them.
    """
    names = docs.columns
    same = ["_id", "_src", "_size"]
    taken = mixed_ranges(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("n")).alias("_id"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_src"),
        F.col("size").alias("_size"),
        F.col("full").alias("_full"),
        F.col("ranges").alias("_ranges"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in names])  # its columns cannot clash in there
    left = docs.select(
        row.alias("_row"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("n")).alias("_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_src"),
        word_count().alias("_size"),
    ).withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("_row.text"))))
    right = taken.withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy("_full", F.size("_ranges"))))
    whole = F.array_repeat(F.expr("named_struct('from', 0L, 'to', _size)"), F.col("_full").cast("int"))
    copies = left.join(right, [*same, "_nth"]).withColumn("_copy", F.explode(F.concat(whole, F.col("_ranges"))))
    words = F.slice(
        F.regexp_extract_all("_row.text", F.lit(_WORD), F.lit(0)),
        (F.col("_copy.from") + 1).cast("int"),
        (F.col("_copy.to") - F.col("_copy.from")).cast("int"),
    )
    cut = (F.col("_copy.to") - F.col("_copy.from")) < F.col("_size")
    out = copies.withColumn("_cut", cut).withColumn(
        "_text", F.when(F.col("_cut"), F.array_join(words, " ")).otherwise(F.col("_row.text"))
    )
    mixed = F.col("_row").withField("text", F.col("_text"))
    if "n_chars" in names:
        size = F.length("_text").cast(docs.schema["n_chars"].dataType)
        mixed = mixed.withField("n_chars", F.when(F.col("_cut"), size).otherwise(F.col("_row.n_chars")))
    return out.select(mixed.alias("_row")).select("_row.*")


SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
            coalesce('s' || source, 'n') AS src, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
 s0 AS (SELECT src, source, sum(size) AS source_size FROM d GROUP BY src, source),
 s1 AS (SELECT src, CAST(source_size AS DOUBLE) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s0),
 s2 AS (SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, ss * {REPEAT_LIMIT}::DOUBLE AS most,
         sum(ss) OVER () * {TOTAL}::DOUBLE AS al FROM s1),
 s3 AS (SELECT *, (al - coalesce(sum(most) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM s2),
 s4 AS (SELECT *, (SELECT arg_min(lv, struct_pack(r := most / w, p := place)) FROM s3 WHERE most > w * lv) AS share FROM s3),
 t AS (SELECT src, ss, place, coalesce(least(most, w * share), most) AS target FROM s4),
 h AS (SELECT *, floor(round((SELECT sum(target) FROM t) / {BLOCK_WORDS})) AS seats, (SELECT sum(target) FROM t) AS al,
        (SELECT count(*) FROM t) AS n FROM t WHERE target > 0),
 q0 AS (SELECT *, CAST(greatest(0, floor(target / al * seats) - ceil(target / al * n / 2) - 1) AS BIGINT) AS sure,
        CAST(floor(target / al * seats) + ceil(target / al * n / 2) + 1 AS BIGINT) AS top FROM h),
 q1 AS (SELECT *, seats - sum(sure) OVER () AS lft FROM q0),
 q2 AS (SELECT *, unnest(range(sure, top + 1)) AS kk FROM q1),
 q3 AS (SELECT *, row_number() OVER (ORDER BY target / (2 * kk + 1) DESC, place, kk) AS rk FROM q2),
 q AS (SELECT src, max(sure) + count(*) FILTER (WHERE rk <= lft) AS drawn FROM q3 GROUP BY src),
 b AS (SELECT t.src, t.ss, t.target, CAST(ceil(ss / {BLOCK_WORDS}) AS BIGINT) AS nb, coalesce(drawn, 0) AS drawn0,
        CAST(('0x' || substr(md5('{SEED}:' || t.src), 1, 8)) AS BIGINT) AS seeded FROM t LEFT JOIN q USING (src)),
 c AS (SELECT *, least(drawn0, 2 * nb) AS drawn, greatest(nb, 1) AS n1 FROM b),
 e AS (SELECT src, ss, target, nb, drawn // n1 AS ful, seeded % n1 AS st, seeded % n1 + drawn % n1 AS sp FROM c),
 p AS (SELECT d.*, sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS en FROM d),
 o AS (SELECT p.*, en - size AS be, ss, target, nb, ful, st, sp FROM p JOIN e USING (src))
SELECT doc_id, size, CAST(ss AS BIGINT) AS source_size, target,
 CAST(ful * size + greatest(0, least(en, greatest(sp - nb, 0) * {BLOCK_WORDS}) - be)
  + greatest(0, least(en, least(sp, nb) * {BLOCK_WORDS}) - greatest(be, st * {BLOCK_WORDS})) AS BIGINT) AS taken
FROM o"""


@query("op5_sainte_lague_mixing", SQL)
def _(spark, sf):
    """Words that the mix takes of every document, with its source's size and target."""
    return mixed_ranges(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")
