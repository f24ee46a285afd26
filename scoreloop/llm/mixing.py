"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks.

1. Targets: the sources share the words of all documents by weight; a target
   stops at ``max_repeat`` times its source's words and the excess goes to the
   others by weight (water filling, in closed form over the sources sorted by
   limit / weight).
2. Quotas: the mix is cut into blocks of ``block`` words, dealt to the sources
   by highest quotients target / (2 seats + 1). A bisection finds the divisor,
   ties go to the source that sorts first. The method never takes a seat back
   when the house grows, so shard k gets the seats between two house sizes and
   every shard's quotas are integers close to the targets.
3. Selection: a source's documents lie in seeded order on a word line cut into
   blocks. Whole rounds of the quota take every word once; the rest takes the
   blocks that a seeded permutation of the block numbers (a * b + c mod n)
   places first. No block becomes a row: a document sums over the blocks it
   overlaps. ``dealt`` gives every shard its quota of the selected blocks.

Word positions come from a two-level prefix sum: 4096 seeded buckets per
source, then rows inside a bucket, so a source with a third of all rows is
spread over all tasks. The table of sources is assumed to fit one task.

Null text and text without words have size 0 and are never taken. Null is a
source of its own, sorted last. Rows with equal ids and texts are documents of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.llm.common import SPACE_CLASS, cut

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
BLOCK = 16
SHARDS = 8
SEED = 6
#: Primes used as multipliers; a block count is divisible by two of them at most.
PRIMES = (1299709, 1299721, 1299743)


def n_words(text: str = "text") -> F.Column:
    """Number of words (null: 0)."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS + "+"), "")).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> with sid, weight and target."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    s = (sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
         .withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(max_repeat))))
    line = Window.orderBy(F.col("limit") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (s.withColumn("full", F.coalesce(F.sum("limit").over(line), F.lit(0.0)))
         .withColumn("used", F.coalesce(F.sum("weight").over(line), F.lit(0.0)))
         .withColumn("level", (F.sum("source_size").over(everything) - F.col("full"))
                     / (F.sum("weight").over(everything) - F.col("used"))))
    # the first source below its limit sets the level of all sources below theirs
    below = F.when(F.col("limit") > F.col("weight") * F.col("level"), F.struct(F.col("limit") / F.col("weight"), "sid", "level"))
    s = s.withColumn("level", F.min(below).over(everything).getField("level"))
    return s.select("source", "source_size", "sid", "weight",
                    F.least("limit", F.coalesce(F.col("weight") * F.col("level"), F.col("limit"))).alias("target"))


def quotas(tgt: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(sid, shard, quota): integer block quotas per shard and source."""
    house = f"cast(round(aggregate(line, 0D, (a, x) -> a + x.t) / {block}) as long)"
    seats_at = "aggregate(line, 0D, (a, x) -> a + floor(x.t * {m} + 0.5D))"
    mid = "((b.lo + b.hi) / 2)"
    bisect = ("aggregate(sequence(1, 100), struct(0D as lo, if(total > 0, (house + size(line)) / total, 0D) as hi), "
              f"(b, i) -> if({seats_at.format(m=mid)} <= house, struct({mid} as lo, b.hi as hi), struct(b.lo as lo, {mid} as hi)), b -> b.lo)")
    one = tgt.agg(F.sort_array(F.collect_list(F.struct("sid", F.col("target").alias("t")))).alias("line"))
    k = (one.withColumn("all_seats", F.expr(house))
         .select("line", F.expr("aggregate(line, 0D, (a, x) -> a + x.t)").alias("total"), "all_seats",
                 F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("upto"))
         .withColumn("house", F.expr(f"(all_seats * upto) div {shards}"))
         .withColumn("m", F.expr(bisect))
         .select("upto", "house", "m", F.explode("line").alias("x"))
         .select("upto", "house", F.col("x.sid").alias("sid"), F.col("x.t").alias("t"),
                 F.floor(F.col("x.t") * F.col("m") + 0.5).cast("long").alias("base")))
    by_quotient = Window.partitionBy("upto").orderBy((F.col("t") / (2 * F.col("base") + 1)).desc(), "sid")
    left = F.col("house") - F.sum("base").over(Window.partitionBy("upto"))
    k = k.withColumn("seats", F.col("base") + (F.row_number().over(by_quotient) <= left).cast("long"))
    before = F.coalesce(F.lag("seats").over(Window.partitionBy("sid").orderBy("upto")), F.lit(0))
    return k.select("sid", (F.col("upto") - 1).alias("shard"), (F.col("seats") - before).alias("quota"))


def plan(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block: int = BLOCK,
         shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document: size, source_size, target, taken, and what is taken.

    ``docs`` has doc_id, source, size and any further columns. ``rounds`` says how
    often the whole document is taken, ``pick`` which of its blocks are taken once
    more, ``quota`` the source's blocks per shard.
    """
    key = F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = cut(docs.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3)))
    sums = cut(rows.groupBy("source", "_bucket").agg(F.sum("size").alias("n")))
    src = cut(targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, max_repeat))
    q = (quotas(src, block, shards).groupBy("sid")
         .agg(F.sum("quota").alias("blocks"),
              F.transform(F.sort_array(F.collect_list(F.struct("shard", "quota"))), lambda x: x["quota"]).alias("quota")))
    words = F.least(F.col("blocks") * block, F.col("source_size") * max_repeat)
    n = F.expr(f"(source_size + {block - 1}) div {block}")
    prime = F.expr("element_at(filter(array({}), p -> n_blocks % p <> 0), 1)".format(", ".join(f"{p}L" for p in PRIMES)))
    src = (src.join(q, "sid").withColumn("words", words).withColumn("n_blocks", F.greatest(n, F.lit(1)))
           .withColumn("rounds", F.expr("if(source_size = 0, 0, words div source_size)"))
           .withColumn("extra", F.expr(f"if(source_size = 0, 0, cast(round((words - rounds * source_size) / {block}) as long))"))
           .withColumn("mul", prime)
           .withColumn("add", F.expr(f"pmod(conv(substring(md5(concat('{seed}-', cast(sid as string))), 1, 8), 16, 10), n_blocks)").cast("long"))
           .withColumnRenamed("source", "_source"))
    starts = sums.select(F.col("source").alias("_src"), F.col("_bucket").alias("_b"),
                         F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("_bucket")
                                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = (rows.withColumn("_pos", F.coalesce(F.sum("size").over(inside), F.lit(0)))
         .join(starts, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_bucket") == F.col("_b")))
         .withColumn("_pos", F.col("_pos") + F.col("_start"))
         .join(src, F.col("source").eqNullSafe(F.col("_source"))))
    picked = f"filter(if(size > 0 and extra > 0, sequence(_pos div {block}, (_pos + size - 1) div {block}), array()), b -> (mul * b + add) % n_blocks < extra)"
    extra = F.expr(f"aggregate({picked}, 0L, (a, b) -> a + least((b + 1) * {block}, _pos + size) - greatest(b * {block}, _pos))")
    d = d.withColumn("_extra", extra)
    pick = F.struct(F.col("_pos").alias("pos"), F.lit(block).alias("block"), "mul", "add", "n_blocks", "extra")
    keep = [c for c in docs.columns if c not in ("source_size", "target", "taken", "rounds", "pick", "quota")]
    return d.select(*keep, "source_size", "target", (F.col("rounds") * F.col("size") + F.col("_extra")).alias("taken"),
                    "rounds", pick.alias("pick"), "quota")


def dealt(d: DataFrame) -> DataFrame:
    """The words of ``plan``'s rows dealt to the shards by the quotas: the columns of ``d``,
    ``shard`` and ``shard_words``, one row per document and shard that gets words of it.

    A source's seats are the places of its permuted blocks, round after round; every shard
    owns as many of them as its quota says, in shard order. The last shard takes the few seats beyond
    all quotas (a source's last block may be short). A document's words add up to ``taken``. No
    shuffle: each document's blocks know their seats. Columns named shard or shard_words are replaced."""
    seats = F.expr("""flatten(transform(sequence(pick.pos div pick.block, (pick.pos + size - 1) div pick.block), b ->
        transform(filter(sequence(0L, rounds), r -> r < rounds or (pick.mul * b + pick.add) % pick.n_blocks < pick.extra), r ->
            struct(r * pick.n_blocks + (pick.mul * b + pick.add) % pick.n_blocks as seat,
                   least((b + 1) * pick.block, pick.pos + size) - greatest(b * pick.block, pick.pos) as words))))""")
    shares = F.expr("""filter(transform(sequence(1, size(quota)), k -> struct(k - 1 as shard,
        aggregate(filter(_seats, s -> s.seat >= aggregate(slice(quota, 1, k - 1), 0L, (a, x) -> a + x)
                                      and (k = size(quota) or s.seat < aggregate(slice(quota, 1, k), 0L, (a, x) -> a + x))),
                  0L, (a, s) -> a + s.words) as shard_words)), x -> x.shard_words > 0)""")
    d = d.drop("shard", "shard_words").filter("taken > 0").withColumn("_seats", seats)
    return (d.withColumn("_share", F.explode(shares)).drop("_seats")
            .withColumn("shard", F.col("_share.shard")).withColumn("shard_words", F.col("_share.shard_words")).drop("_share"))


def taken_texts(d: DataFrame, text: str = "text") -> DataFrame:
    """One row per copy the mix takes: ``rounds`` times the whole text, then, if only
    some blocks of it are taken once more, those words joined by spaces (all: the text as it is)."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS + "+"), "")
    part = F.expr("array_join(filter(_words, (w, i) -> (pick.mul * ((pick.pos + i) div pick.block) + pick.add) % pick.n_blocks < pick.extra), ' ')")
    more = F.col("taken") - F.col("rounds") * F.col("size")
    copies = F.concat(F.when((F.col("rounds") > 0) & (F.col("size") > 0), F.array_repeat(F.lit(True), F.col("rounds").cast("int")))
                      .otherwise(F.array().cast("array<boolean>")),
                      F.when(more > 0, F.array(more == F.col("size"))).otherwise(F.array().cast("array<boolean>")))
    d = d.withColumn("_words", F.when((more > 0) & (more < F.col("size")), words))
    d = d.withColumn("_part", F.when(F.col("_words").isNotNull(), part)).drop("_words")
    return (d.withColumn("_whole", F.explode(copies))
            .withColumn(text, F.when(F.col("_whole"), F.col(text)).otherwise(F.col("_part"))).drop("_whole", "_part"))
