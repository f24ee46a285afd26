"""Size-checked broadcast and a distributed global rank.

Derived lookup tables (language profiles, vocabularies, token weights) are
small in practice but nothing bounds them by construction. ``bounded_lookup``
materialises such a table once in the shared checkpoint folder, counts it,
and only then marks it for broadcast; beyond the bound the caller's join
stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop.config import SIZING
from scoreloop.session import ensure_checkpoint_dir


def row_bytes(df: DataFrame):
    """Bytes of a row of ``df``: strings and binaries by their real length."""
    size = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, T.BinaryType):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2
        else:
            size = size + 8
    return size.cast("long")


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``, one aggregate."""
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return n, total


def bounded_lookup(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Checkpoint ``df`` (cuts lineage), count it, broadcast it only if both its
    row count and its measured size are within bounds; otherwise return it
    unhinted so the join stays a (skew-aware) shuffle join."""
    limit = SIZING.max_broadcast_rows if max_rows is None else max_rows
    byte_limit = SIZING.max_broadcast_bytes if max_bytes is None else max_bytes
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    n, total = measured(df)
    small = n <= limit and total <= byte_limit
    return F.broadcast(df) if small else df


def tiered_lookup(df: DataFrame, weight: str | None = None, max_rows: int | None = None,
                  max_bytes: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows to broadcast, the others or None): all rows within the bounds of ``bounded_lookup``, else those with the
    greatest ``weight`` (a count) that keep within them, in steps of powers of two (at most 64 rows are counted)."""
    limit = SIZING.max_broadcast_rows if max_rows is None else max_rows
    byte_limit = SIZING.max_broadcast_bytes if max_bytes is None else max_bytes
    df = materialize(df)
    n, total = measured(df)
    if n <= limit and total <= byte_limit:
        return F.broadcast(df), None
    if weight is None:
        return F.broadcast(df.limit(0)), df
    level = F.coalesce(F.floor(F.log2(F.greatest(F.col(weight), F.lit(1)))), F.lit(0)).cast("int")
    cut, rows, size = 64, 0, 0
    for r in sorted(df.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum(row_bytes(df)).alias("b")).collect(), reverse=True):
        rows, size = rows + r["n"], size + r["b"]
        if rows > limit or size > byte_limit:
            break
        cut = r["level"]
    return F.broadcast(df.filter(level >= cut)), df.filter(level < cut)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back:
    later uses (several aggregates, scalar subqueries) scan the result
    instead of recomputing its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rank") -> DataFrame:
    """1-based rank over the whole table without a single-partition window.

    Range-partitioned sort, then per-partition counts (one row per
    partition), a running offset over those few rows, and a broadcast join
    back. The sorted table is checkpointed so both passes see the same
    partitioning.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sorted_df = (df.orderBy(*order_cols)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    # monotonically_increasing_id = (partition index << 33) + position in partition
    local = sorted_df.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = local.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    # one row per partition: a bounded broadcast
    ranked = local.join(F.broadcast(offsets), "_pid")
    return (ranked.withColumn(rank_col, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1)
            .drop("_pid", "_mid", "_pos", "_off"))
