"""Key index beside the feedback store: lookups read only their prefixes, crashes lose nothing."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from scoreloop.operators import ingest as IN
from scoreloop.sources.files import append_feedback, read_feedback_store
from scoreloop.sources.keyindex import KeyIndex, prefix

SCHEMA = "id long, text_hash string, event_timestamp timestamp_ntz"


def sha(k):
    return hashlib.sha256(str(k).encode()).hexdigest()


def rows(spark, ids, hashes=None):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, sha(i) if hashes is None else hashes[n], at + dt.timedelta(hours=i)) for n, i in enumerate(ids)], SCHEMA)


def keys(df):
    return {r.text_hash for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_reads_only_its_prefixes(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    append_feedback(rows(spark, range(2000)), path)
    index = KeyIndex(spark, path)
    assert index.catch_up() > 0 and index.catch_up() == 0
    few = rows(spark, [3, 5, 5, 9000, 9001], None)
    found = index.seen(few)
    assert keys(found) == {sha(3), sha(5)}
    wanted = {sha(k)[:2] for k in (3, 5, 9000, 9001)}
    p = plan(index._keys(0).filter(F.col("prefix").isin(sorted(wanted))))
    assert "PartitionFilters: [prefix" in p or "PartitionFilters: [isnotnull(prefix" in p
    scan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "prefix" in scan
    # bytes: the files of the lookup lie in the folders of its prefixes
    files = index._keys(0).filter(F.col("prefix").isin(sorted(wanted))).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and {r.f.split("prefix=")[1].split("/")[0] for r in files} <= wanted
    # the index side meets the keys where it lies: the only exchanges are the broadcast and the final distinct
    assert "BroadcastHashJoin" in plan(found) and "SortMergeJoin" not in plan(found)


def test_keys_without_digits_and_nulls(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    odd = ["", "Zz", "0", "ABCD", sha(1), None]
    append_feedback(rows(spark, range(6), odd), path)
    found = keys(KeyIndex(spark, path).seen(rows(spark, range(8), [*odd, "no", "0a"])))
    assert found == {"", "Zz", "0", "ABCD", sha(1)}
    assert {r[0] for r in spark.createDataFrame([(x,) for x in odd], "k string").select(prefix("k")).collect()} == {"_", sha(1)[:2]}


def test_crash_between_store_and_index(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    append_feedback(rows(spark, range(10)), path, batch_id=0)
    index = KeyIndex(spark, path)
    assert keys(index.seen(rows(spark, [1]))) == {sha(1)}
    # files that reached the store only
    rows(spark, range(10, 20)).withColumn("batch_id", F.lit(1).cast("long")).withColumn("event_date", F.to_date("event_timestamp")) \
        .write.mode("append").partitionBy("event_date").parquet(path)
    assert keys(index.seen(rows(spark, [1, 15, 30]))) == {sha(1), sha(15)}
    # keys that were written, but not marked as read: they come again, lookups stay right
    index._write(rows(spark, range(10)).select("text_hash", F.lit(0).cast("long").alias("batch_id")), 0)
    assert index.seen(rows(spark, [1, 15])).count() == 2


def test_a_retried_batch_judges_as_before(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    append_feedback(rows(spark, range(5)), path, batch_id=7)
    assert keys(KeyIndex(spark, path, skip_batch=7).seen(rows(spark, range(8)))) == set()
    assert keys(KeyIndex(spark, path, skip_batch=8).seen(rows(spark, range(8)))) == {sha(k) for k in range(5)}
    append_feedback(rows(spark, range(8)), path, batch_id=7)  # the retry adds what the first attempt did not
    assert sorted(r.id for r in read_feedback_store(spark, path).collect()) == list(range(8))
    append_feedback(rows(spark, range(8)), path)
    assert read_feedback_store(spark, path).count() == 8


def test_compaction_keeps_every_key(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    index = KeyIndex(spark, path, digits=1)
    assert index.seen(rows(spark, [1])).count() == 0  # no store yet
    index.compact()
    for k in range(3):
        append_feedback(rows(spark, range(100 * k, 100 * k + 100)), path, batch_id=k)
        index.catch_up()
    index.compact()
    assert index.generation() == 1 and index.catch_up() == 0
    files = index._keys(1).select(F.input_file_name().alias("f"), "prefix").distinct().groupBy("prefix").count().collect()
    assert all(r["count"] == 1 for r in files)
    assert keys(index.seen(rows(spark, [5, 150, 299, 400]))) == {sha(5), sha(150), sha(299)}
    append_feedback(rows(spark, [500]), path, batch_id=9)
    assert keys(index.seen(rows(spark, [500, 5]))) == {sha(500), sha(5)}


@pytest.mark.parametrize("tasks", [1, 7])
def test_flags_equal_the_store_scan(spark, tmp_dir, tasks):
    path = f"{tmp_dir}/store"
    append_feedback(rows(spark, range(0, 60, 3)), path)
    hashes = [sha(k % 40) for k in range(200)] + [None, None]
    inc = rows(spark, range(1000, 1202), hashes).repartition(tasks)
    a, b = ({(r.id, r.is_duplicate) for r in IN.flag_duplicates(inc, s).collect()} for s in (KeyIndex(spark, path), read_feedback_store(spark, path)))
    assert a == b and len(a) == 202
