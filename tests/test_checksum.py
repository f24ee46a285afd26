"""Checksums and hash trees of files against hashlib, in both forms."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from scoreloop.sources import checksum as CS


def tree(data: bytes, chunk: int, fanout: int) -> tuple[int, str]:
    level = [hashlib.sha256(data[k:k + chunk]).hexdigest() for k in range(0, max(len(data), 1), chunk)]
    n = len(level)
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[k:k + fanout]).encode()).hexdigest() for k in range(0, len(level), fanout)]
    return n, level[0]


@pytest.fixture()
def files(tmp_dir):
    data = {"empty": b"", "one": b"\x00", "even": bytes(range(256)) * 4, "odd": os.urandom(1003),
            "same": bytes(range(256)) * 4, "with space": "ä\n\r\n".encode() * 70, "long": os.urandom(20_011)}
    for name, raw in data.items():
        with open(f"{tmp_dir}/{name}.bin", "wb") as f:
            f.write(raw)
    del data["empty"]  # Spark's reader lists no empty files
    return tmp_dir, data


def named(df, *cols):
    return {os.path.basename(r["path"])[:-4]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("row_limit", [0, 1003, 1 << 20])
def test_files_equal_hashlib(spark, files, row_limit):
    folder, data = files
    got = named(CS.file_checksums(spark, f"{folder}/*.bin", row_limit), "size_bytes", "sha256")
    assert got == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in data.items()}


@pytest.mark.parametrize("row_limit", [0, 1003, 1 << 20])
@pytest.mark.parametrize("chunk,fanout", [(64, 2), (64, 5), (100, 1024), (1 << 20, 2)])
def test_tree_equals_brute_force(spark, files, row_limit, chunk, fanout):
    folder, data = files
    got = named(CS.file_tree(spark, f"{folder}/*.bin", chunk, fanout, row_limit), "size_bytes", "n_chunks", "root")
    assert got == {k: (len(v), *tree(v, chunk, fanout)) for k, v in data.items()}


def test_file_above_the_array_limit(spark, tmp_dir):
    """A sparse file of 2 GB and a few bytes does not fit a row; ranges of it do."""
    size = (2 << 30) + 17
    with open(f"{tmp_dir}/big.bin", "wb") as f:
        f.truncate(size - 3)
        f.seek(size - 3)
        f.write(b"end")
    chunk = 256 << 20
    zero = hashlib.sha256(bytes(chunk)).hexdigest()
    leaves = [zero] * 8 + [hashlib.sha256(bytes(14) + b"end").hexdigest()]
    want = hashlib.sha256("".join(leaves).encode()).hexdigest()
    assert named(CS.file_tree(spark, f"{tmp_dir}/big.bin", chunk), "size_bytes", "n_chunks", "root") == {"big": (size, 9, want)}


def test_text_tree_edges(spark):
    texts = [(1, None), (2, ""), (3, "ä" * 50), (4, "x" * 1000), (5, "x" * 1000), (6, "ab\n")]
    df = spark.createDataFrame(texts, "id long, text string").withColumn("h", F.lit("clash"))
    got = {r["id"]: (r["n_bytes"], r["n_chunks"], r["root"]) for r in CS.text_tree(df, "id", "text", 16, 3).collect()}
    assert got == {k: (len((t or "").encode()), *tree((t or "").encode(), 16, 3)) for k, t in texts}
    assert CS.text_tree(df.limit(0), "id", "text", 16, 3).count() == 0


def test_bytes_are_not_read_for_the_listing(spark, files):
    folder, _ = files
    plan = CS.file_tree(spark, f"{folder}/*.bin", 64, 4, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "length" in plan and "Join" not in plan


def test_shrunk_file_raises(files):
    folder, _ = files
    with pytest.raises(OSError):
        CS.range_digest(f"{folder}/odd.bin", 1000, 100)
