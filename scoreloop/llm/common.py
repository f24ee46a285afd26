"""Helpers the operators share: tables, lineage cuts, connected components."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.session import ensure_checkpoint_dir

#: The ASCII white space that separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: One list per running ``scratch_of_call``: the scratch folders written inside it and not deleted yet.
_OWNERS: list[list[str]] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, as Spark reads it (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows go to the shared checkpoint folder once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into a fresh scratch folder; (reread table, folder)."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    for owner in _OWNERS[-1:]:
        owner.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that no later step reads."""
    for path in paths:
        for owner in _OWNERS:
            if path in owner:
                owner.remove(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Rows of a batch sent to Python while the body runs (for rows of several MB)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextlib.contextmanager
def scratch_of_call(spark: SparkSession, keep: list[str]):
    """Deletes at its end what the body has written and neither deleted nor put into ``keep``.

    A lazy result reads its scratch folders until it is stored; who stores it within the body
    leaves nothing behind. Folders of other calls stay."""
    _OWNERS.append([])
    try:
        yield
    finally:
        mine = _OWNERS.pop()
        drop_scratch(spark, *[p for p in mine if p not in keep])


def rest(doc_id: str, mod: int) -> F.Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def unit(*cols) -> F.Column:
    """A seeded draw from [0, 1) with 53 random bits: a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has long columns u and v. Large-star and small-star rounds
    alternate until the edge set stands still; then every edge points from
    a node to its component's smallest node. Every step is a map-side
    combined aggregation or a join that AQE can split where a hub is hot.
    Returns (node, component_id); nodes without edges are not listed.
    """
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    last = None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        e = cut(small)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not converge")
    tops = e.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(tops)
