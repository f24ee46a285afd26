"""First arrival in state equals the batch rule, whatever the order and the batches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from scoreloop.streaming import unique as U

SCHEMA = "id long, text string, event_timestamp timestamp_ntz"


def rows(seed, n=60):
    rnd = random.Random(seed)
    at = dt.datetime(2024, 1, 1)
    out = [(i, rnd.choice(["a", "b", "c", "", None, f"t{i % 20}"]), rnd.choice([None, at + dt.timedelta(minutes=rnd.randint(0, 9))])) for i in range(n)]
    out += rnd.sample(out, 10)  # redelivered
    rnd.shuffle(out)
    return out


def stream(spark, tmp, batches, stored=None, stop_after=None):
    """Runs the batches as files of a stream, a query per call of ``availableNow``."""
    src, out, ck = (os.path.join(tmp, d) for d in ("src", "out", "ck"))
    old = spark.conf.get(U.PROVIDER[0])
    for part in batches:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        # a new query each time: state and decisions come back from the checkpoint
        q = U.start_unique(spark.readStream.schema(SCHEMA).parquet(src), out, ck, stored)
        q.awaitTermination()
        assert q.exception() is None and spark.conf.get(U.PROVIDER[0]) == old
    return sorted(tuple(r) for r in U.settled(spark, out).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_on_shuffled_input(spark, tmp_dir, seed):
    data = rows(seed)
    stored = spark.createDataFrame([("a",), ("t3",), ("not here",), (None,)], "text string").select(F.sha2("text", 256).alias("text_hash"))
    cut = sorted(random.Random(seed).sample(range(1, len(data)), 2))
    got = stream(spark, tmp_dir, [data[:cut[0]], data[cut[0]:cut[1]], data[cut[1]:]], stored)
    want = sorted(tuple(r) for r in U.unique_batch(spark.createDataFrame(data, SCHEMA), stored).collect())
    assert got == want
    taken = {r[0] for r in stored.collect()}
    assert sum(r[4] for r in want) == len({r[0] for r in want} - taken) and {r[0] for r in want} & taken  # one holder a key, none of a stored one


def test_late_earlier_copy_takes_the_key(spark, tmp_dir):
    at = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    batches = [[(5, "x", at)], [(6, "x", at + day), (7, "x", at - 400 * day)], [(8, "x", at - day), (9, "y", None)]]
    got = {r[1]: r[4] for r in stream(spark, tmp_dir, batches)}
    assert got == {5: False, 6: False, 7: True, 8: False, 9: True}
    d = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert {(r.id, r.decision) for r in d.collect()} == {(5, "kept"), (6, "duplicate"), (7, "kept"), (5, "replaced"), (8, "duplicate"), (9, "kept")}


def test_batch_rule_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert U.unique_batch(empty).count() == 0
    nulls = spark.createDataFrame([(1, None, None), (2, "x", None), (2, "x", None)], SCHEMA)
    assert [(r.id, r.copies, r.kept) for r in U.unique_batch(nulls).collect()] == [(2, 2, True)]


def test_keys_of_a_bucket_share_their_state(spark, tmp_dir, monkeypatch):
    """The state store is called once a bucket, not once a key; one bucket gives what many give."""
    data = rows(3)
    monkeypatch.setattr(U, "BUCKETS", 1)
    stored = spark.createDataFrame([("b",)], "text string").select(F.sha2("text", 256).alias("text_hash"))
    got = stream(spark, tmp_dir, [data[:30], data[30:]], stored)
    assert got == sorted(tuple(r) for r in U.unique_batch(spark.createDataFrame(data, SCHEMA), stored).collect())


def test_state_calls_follow_buckets():
    import pandas as pd

    class Value:
        value, calls = None, 0

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.calls = value, self.calls + 1

    p = U.FirstArrival()
    p.holders = Value()
    p.handleInitialState((0,), pd.DataFrame({"text_hash": ["s"]}), None)
    chunk = pd.DataFrame({"text_hash": [f"k{i % 500}" for i in range(1000)] + ["s"], "at": [-i for i in range(1000)] + [-9999], "id": range(1001)})
    out = pd.concat(p.handleInputRows((0,), iter([chunk]), None))
    assert p.holders.calls == 2 and len(p.holders.value[0]) == 501
    assert out["decision"].value_counts().to_dict() == {"duplicate": 501, "kept": 500}
    assert set(out[out["decision"] == "kept"]["id"]) == set(range(500, 1000))
