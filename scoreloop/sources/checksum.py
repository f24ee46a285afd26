"""Checksums of files of any size.

``file_checksums`` gives the SHA-256 of each file. SHA-256 reads its input in order, so one
file is one task; a file above ``row_limit`` is streamed in pieces instead of read as one row.

``file_tree`` splits the work inside a file: leaf k is the SHA-256 of bytes
[k * chunk, (k + 1) * chunk), a parent the SHA-256 of the lower-case hex digests
of up to ``fanout`` children in order, a lone node is the root. Byte ranges of a
large file are read by different tasks; no group holds more than ``fanout`` digests.

Files are listed by Spark's reader with the contents pruned, so nothing is listed or
collected on the driver. Small files are hashed in the JVM from any file system Spark reads;
large ones are opened in the tasks by pyarrow (local paths and the schemes it knows).
Spark's reader lists no empty files, so they have no row. Empty text has one leaf, the hash
of no bytes. Both forms give the same digests.
"""

from __future__ import annotations

import hashlib
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_LIMIT = 256 << 20  # bytes of a file that may travel as one row
CHUNK = 64 << 20
FANOUT = 1024
PIECE = 1 << 20        # bytes a task holds at once


def _open(path: str):
    """A readable stream of a file named as Spark names it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem().open_input_file(path)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def range_digest(path: str, start: int, size: int) -> str:
    """SHA-256 of ``size`` bytes from ``start``, a piece at a time. A file that has shrunk raises."""
    h = hashlib.sha256()
    with _open(path) as f:
        f.seek(start)
        while size:
            data = f.read(min(PIECE, size))
            if not data:
                raise OSError(f"{path} ended {size} bytes early")
            h.update(data)
            size -= len(data)
    return h.hexdigest()


def _digest_ranges(ranges: DataFrame) -> DataFrame:
    """``ranges`` (path, size_bytes, k, start, size) with ``h`` instead of start and size."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("path"), b.column("size_bytes"), b.column("k"),
                 pa.array([range_digest(r["path"], r["start"], r["size"]) for r in rows], pa.string())],
                names=["path", "size_bytes", "k", "h"])

    # a number of partitions of its own: the rows are tiny, the bytes behind them are not
    tasks = 4 * ranges.sparkSession.sparkContext.defaultParallelism
    return (ranges.repartition(tasks, "path", "k")
            .mapInArrow(run, "path string, size_bytes long, k long, h string"))


def _files(spark: SparkSession, path_glob: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path_glob)


def file_checksums(spark: SparkSession, path_glob: str, row_limit: int = ROW_LIMIT) -> DataFrame:
    """path, size_bytes and the SHA-256 of each file."""
    files = _files(spark, path_glob)
    small = files.filter(F.col("length") <= row_limit).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > row_limit).select(
        "path", F.col("length").alias("size_bytes"), F.lit(0).cast("long").alias("k"),
        F.lit(0).cast("long").alias("start"), F.col("length").alias("size"))
    return small.unionByName(_digest_ranges(large).select("path", "size_bytes", F.col("h").alias("sha256")))


def n_chunks(size: Column, chunk: int) -> Column:
    """Leaves of ``size`` bytes: at least one."""
    return F.greatest(F.ceil(size / F.lit(chunk)), F.lit(1)).cast("long")


def leaf_digests(content: Column, size: Column, chunk: int) -> Column:
    """Array of the leaves' SHA-256 of a binary column; the content itself is never repeated."""
    return F.transform(F.sequence(F.lit(0).cast("long"), n_chunks(size, chunk) - 1),
                       lambda k: F.sha2(F.substring(content, (k * chunk + 1).cast("int"), F.lit(chunk)), 256))


def hash_tree(leaves: DataFrame, by: list[str], most: int, fanout: int = FANOUT) -> DataFrame:
    """``by`` columns, n_chunks and root of (by, n, k, h) rows: leaf k of n with digest h.

    ``by`` tells the inputs apart, ``most`` is the largest n. One grouping per level; a
    level's rows are a ``fanout``-th of the one below."""
    tree = leaves.withColumn("left", F.col("n"))
    while most > 1:
        children = F.transform(F.array_sort(F.collect_list(F.struct("k", "h"))), lambda c: c["h"])
        tree = (tree.withColumn("up", F.expr(f"k div {fanout}"))
                .groupBy(*by, "n", "left", "up").agg(children.alias("c"))
                .select(*by, "n", F.expr(f"(left + {fanout - 1}) div {fanout}").alias("left"), F.col("up").alias("k"),
                        F.when(F.col("left") == 1, F.col("c")[0]).otherwise(F.sha2(F.array_join("c", ""), 256)).alias("h")))
        most = -(-most // fanout)
    return tree.select(*by, F.col("n").alias("n_chunks"), F.col("h").alias("root"))


def text_tree(df: DataFrame, key: str, text: str, chunk: int, fanout: int) -> DataFrame:
    """The tree over the UTF-8 bytes of a text column (null: none): key, n_bytes, n_chunks, root."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = F.octet_length(raw).cast("long")
    most = df.agg(F.max(n_chunks(size, chunk))).first()[0] or 1
    leaves = (df.select(key, size.alias("n_bytes"), leaf_digests(raw, size, chunk).alias("hs"))
              .select(key, "n_bytes", F.size("hs").cast("long").alias("n"), F.posexplode("hs").alias("k", "h"))
              .withColumn("k", F.col("k").cast("long")))
    return hash_tree(leaves, [key, "n_bytes"], most, fanout)


def file_tree(spark: SparkSession, path_glob: str, chunk: int = CHUNK, fanout: int = FANOUT,
              row_limit: int = ROW_LIMIT) -> DataFrame:
    """path, size_bytes, n_chunks and root of each file's tree."""
    files = _files(spark, path_glob)
    small = (files.filter(F.col("length") <= row_limit)
             .select("path", F.col("length").alias("size_bytes"), leaf_digests(F.col("content"), F.col("length"), chunk).alias("hs"))
             .select("path", "size_bytes", F.posexplode("hs").alias("k", "h")).withColumn("k", F.col("k").cast("long")))
    start = F.col("k") * chunk
    large = (files.filter(F.col("length") > row_limit)
             .select("path", F.col("length").alias("size_bytes"),
                     F.explode(F.sequence(F.lit(0).cast("long"), n_chunks(F.col("length"), chunk) - 1)).alias("k"))
             .select("path", "size_bytes", "k", start.alias("start"),
                     F.least(F.lit(chunk).cast("long"), F.col("size_bytes") - start).alias("size")))
    leaves = small.unionByName(_digest_ranges(large)).withColumn("n", n_chunks(F.col("size_bytes"), chunk))
    most = files.agg(F.max(n_chunks(F.col("length"), chunk))).first()[0] or 1
    return hash_tree(leaves, ["path", "size_bytes"], most, fanout)
