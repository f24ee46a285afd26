"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Every input partition counts its rows.
2. The matrix "rows of partition i that go to shard j" is drawn from the
   multivariate hypergeometric law, so its row sums are the partition sizes and
   its column sums the shard sizes, exactly. The draw walks down a tree of
   partitions with fan-out ``FAN``: a node deals its shard capacities to its
   children one after the other, each node on its own.
3. Every partition permutes its rows locally and cuts them by its matrix row.
4. The rows are exchanged, and permuted again inside their shard.

The result is a uniformly random permutation with gapless slots; shard sizes
differ by one row at most. All steps are DataFrame expressions; the local
permutations are windows over one partition or one (shard, bucket), both of
bounded size, so neither a hot source nor a group of copies meets in one task.

Nulls and equal rows are rows like any other. An empty table gives an empty
result. Input columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.llm.common import cut

FAN = 64
BUCKET_ROWS = 50_000
#: Values farther than this many standard deviations from the mean have less
#: probability than the 53-bit uniform draw can resolve.
SPAN = 12


def _draw(pop: str, good: str, draws: str, u: str) -> str:
    """SQL of one hypergeometric draw by inversion around the mean.

    The weights follow from w(k+1)/w(k) = (K-k)(n-k) / ((k+1)(N-K-n+k+1)), so
    no factorial is needed; one fold sums them, a second finds the quantile.
    """
    ratio = "(p.k - k) * (p.n - k) / ((k + 1) * (p.r - p.n + k + 1))"
    total = f"aggregate(sequence(p.a, p.b), struct(1D as w, 0D as t), (s, k) -> struct(s.w * ({ratio}) as w, s.t + s.w as t), s -> s.t)"
    pick = (f"aggregate(sequence(p.a, p.b), struct(1D as w, 0D as t, p.a as x), (s, k) -> "
            f"struct(s.w * ({ratio}) as w, s.t + s.w as t, if(s.t + s.w <= p.u * p.t, k + 1, s.x) as x), s -> least(s.x, p.b))")
    args = f"struct(cast({pop} as double) as pp, cast({good} as double) as k, cast({draws} as double) as n, cast({pop} - {good} as double) as r, {u} as u)"
    mean, sd = "q.n * (q.k / greatest(q.pp, 1D))", ("sqrt(q.n * (q.k / greatest(q.pp, 1D)) * (q.r / greatest(q.pp, 1D)) "
                                                     "* (greatest(q.pp - q.n, 0D) / greatest(q.pp - 1, 1D)))")
    lo, hi = "greatest(0L, cast(q.n - q.r as long))", "cast(least(q.n, q.k) as long)"
    bounds = (f"struct(q.k as k, q.n as n, q.r as r, q.u as u, "
              f"greatest({lo}, cast(floor({mean} - {SPAN} * {sd}) as long) - {SPAN}) as a, "
              f"least({hi}, cast(ceil({mean} + {SPAN} * {sd}) as long) + {SPAN}) as b)")
    full = f"struct(p.k as k, p.n as n, p.r as r, p.u as u, p.a as a, p.b as b, {total} as t)"
    return (f"transform(transform(transform(array({args}), q -> {bounds}), p -> {full}), p -> if(p.a >= p.b, p.a, {pick}))[0]")


def _matrix_rows(shards: int, seed: int) -> str:
    """SQL: deals the capacities ``caps`` of a node to its ``children`` in turn."""
    u = f"(shiftrightunsigned(xxhash64({seed}L, ch.d, ch.c, j), 11) / {float(1 << 53)}D)"
    x = _draw("g.pop", "st.caps[j]", "g.rows", u)
    row = (f"aggregate(sequence(0, {shards - 1}), struct(ch.rows as rows, aggregate(st.caps, 0L, (a, b) -> a + b) as pop, cast(array() as array<bigint>) as got), "
           f"(g, j) -> transform(array({x}), x -> struct(g.rows - x as rows, g.pop - st.caps[j] as pop, array_append(g.got, x) as got))[0], g -> g.got)")
    return (f"aggregate(children, struct(caps as caps, cast(array() as array<struct<c: bigint, caps: array<bigint>>>) as made), "
            f"(st, ch) -> transform(array({row}), got -> struct(zip_with(st.caps, got, (a, b) -> a - b) as caps, "
            f"array_append(st.made, struct(ch.c as c, got as caps)) as made))[0], st -> st.made)")


def communication_matrix(counts: DataFrame, n_parts: int, sizes: list[int], seed: int) -> DataFrame:
    """(src, caps): how many rows of partition src go to each shard.

    ``counts`` has (src, rows), src in [0, n_parts); ``sizes`` are the exact shard sizes.
    """
    spark, depth = counts.sparkSession, 1
    while FAN ** depth < n_parts:
        depth += 1
    caps = spark.range(1).select(F.col("id").alias("node"), F.array(*[F.lit(int(s)).cast("long") for s in sizes]).alias("caps"))
    for level in range(1, depth + 1):
        child = F.expr(f"src div {FAN ** (depth - level)}")
        kids = (counts.groupBy(child.alias("c")).agg(F.sum("rows").alias("rows"))
                .groupBy(F.expr(f"c div {FAN}").alias("node"))
                .agg(F.sort_array(F.collect_list(F.struct("c", "rows", F.lit(level).alias("d")))).alias("children")))
        caps = (caps.join(kids, "node").select(F.explode(F.expr(_matrix_rows(len(sizes), seed))).alias("m"))
                .select(F.col("m.c").alias("node"), F.col("m.caps").alias("caps")))
    return caps.select(F.col("node").alias("src"), "caps")


def shard(df: DataFrame, n_shards: int = 8, seed: int = 20) -> DataFrame:
    """All rows with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    cols = [c for c in df.columns if c not in ("shard", "slot")]
    rows = cut(df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                         F.spark_partition_id().cast("long").alias("src"),
                         F.monotonically_increasing_id().alias("at")))
    counts = cut(rows.groupBy("src").agg(F.count("*").alias("rows")))
    n, last = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.max("src"), F.lit(0))).first()
    sizes = [n // n_shards + (j < n % n_shards) for j in range(n_shards)]
    matrix = communication_matrix(counts, last + 1, sizes, seed).select(
        "src", F.expr("transform(sequence(1, size(caps)), i -> aggregate(slice(caps, 1, i), 0L, (a, b) -> a + b))").alias("upto"))
    local = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed + 1), "at"), "at")
    sent = (rows.withColumn("pos", F.row_number().over(local)).join(matrix, "src")
            .withColumn("shard", F.expr("size(filter(upto, c -> c < pos))"))
            .withColumn("key", F.xxhash64(F.lit(seed + 2), "at"))
            .withColumn("bucket", F.expr(f"pmod(key, {max(1, -(-n // (n_shards * BUCKET_ROWS)))})"))
            .select("row", "shard", "bucket", "key", "at"))
    starts = (sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")
                                                              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
    again = Window.partitionBy("shard", "bucket").orderBy("key", "at")
    return (sent.withColumn("pos", F.row_number().over(again)).join(starts, ["shard", "bucket"])
            .select("row.*", "shard", (F.col("start") + F.col("pos") - 1).alias("slot")))
