"""Unique for ever, in state.

Every text hash has one entry in state that never expires: the arrival that holds the key, the earliest by time and
id. Keys are dealt to ``BUCKETS`` groups, whose entries are read and written together: a call of the
state store for every key would take most of the time. ``start_unique`` runs it as a stateful stream (RocksDB holds the state outside the heap), started from the
keys of a store, and emits one row for each decision:

- ``kept``: this arrival holds the key now;
- ``replaced``: the arrival that held it before; an earlier one has come late;
- ``duplicate``: a later copy, for the side output.

No watermark is involved, so no arrival is too late to count. The last decision on an arrival (they carry the batch
they were made in) is final: ``settled`` folds the decisions, and equals ``unique_batch`` on the same
rows in whatever order and batches they came. A stored key is never replaced: the store has won.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scoreloop.functions import scalars as S
from scoreloop.operators.sizing import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The setting a session needs, and its fixed value (Spark's own provider class).
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
LAST = 1 << 62  # time of arrivals without one: they come last
HOLDERS = "text_hash array<string>, stored array<boolean>, at array<long>, id array<long>"
DECISIONS = "text_hash string, id long, at long, decision string"
#: Decisions that are passed on at once.
CHUNK = 10_000
#: Groups of keys in the state; fixed, like the partitions, once a stream has begun.
BUCKETS = 4096


def bucket(key: str = "text_hash"):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")


def arrivals(requests: DataFrame) -> DataFrame:
    """(text_hash, at, id): microseconds of the arrival; requests without a text have no key and are left out."""
    hashed = requests if "text_hash" in requests.columns else requests.withColumn("text_hash", S.text_hash("text"))
    at = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    return hashed.filter(F.col("text_hash").isNotNull()).select("text_hash", F.coalesce(at, F.lit(LAST)).alias("at"), "id")


class FirstArrival(StatefulProcessor):
    """Keeps the holders of a bucket's keys; reads the rows in the chunks they come in."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.holders = handle.getValueState("holders", HOLDERS)

    def held(self) -> dict:
        """text_hash -> (stored, at, id)"""
        if not self.holders.exists():
            return {}
        keys, *values = self.holders.get()
        return dict(zip(keys, zip(*values)))

    def hold(self, held: dict) -> None:
        self.holders.update((list(held), *map(list, zip(*held.values()))))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.hold(self.held() | dict.fromkeys(initialState["text_hash"].tolist(), (True, -1, -1)))

    def handleInputRows(self, key, rows, timerValues):
        held, changed, out = self.held(), {}, []
        for pdf in rows:
            for k, at, i in zip(pdf["text_hash"].tolist(), pdf["at"].tolist(), pdf["id"].tolist()):
                first = changed.get(k) or held.get(k)
                if first is not None and (first[0] or first[1:] <= (at, i)):
                    out.append((k, i, at, "duplicate"))
                else:  # the one that was first so far is a later copy after all
                    if first is not None:
                        out.append((k, first[2], first[1], "duplicate" if k in changed else "replaced"))
                    changed[k] = (False, at, i)
            if len(out) >= CHUNK:
                yield frame(out)
                out = []
        if changed:
            self.hold(held | changed)
            out += [(k, i, at, "kept") for k, (_, at, i) in changed.items()]
        yield frame(out)

    def close(self) -> None:
        pass


def frame(rows):
    return pd.DataFrame(rows, columns=["text_hash", "id", "at", "decision"])


def start_unique(requests: DataFrame, decisions_path: str, checkpoint_path: str, stored: DataFrame | None = None, trigger: dict | None = None,
                 partitions: int | None = None):
    """Start the stream; ``stored`` (text_hash) are the keys that are taken before it begins (read on its first
    start only). Decisions are written with their batch, a retried batch overwrites its own. ``partitions`` of the
    state are fixed at the first start (None: the session's shuffle setting)."""
    spark = requests.sparkSession
    keys = None
    if stored is not None:
        # written once: the plan of the first state goes to the tasks, a scan or a subquery in it would not
        keys = materialize(stored.select("text_hash").filter("text_hash is not null").distinct().withColumn("bucket", bucket())).groupBy("bucket")
    made = arrivals(requests).withColumn("bucket", bucket()).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=FirstArrival(), outputStructType=DECISIONS, outputMode="Update", timeMode="None", initialState=keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(decisions_path))

    w = made.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint_path)
    wanted = dict([PROVIDER] + ([("spark.sql.shuffle.partitions", str(partitions))] if partitions else []))
    old = {k: spark.conf.get(k) for k in wanted}
    try:  # the stream takes the settings when it starts
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return w.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def settled(spark: SparkSession, decisions_path: str) -> DataFrame:
    """(text_hash, id, at, copies, kept): arrivals by their last decision. ``copies`` counts equal arrivals (a redelivered request)."""
    d = spark.read.parquet(decisions_path)
    # a holder and its copies may share id and time: kept once, unless it was replaced later
    per = d.groupBy("text_hash", "id", "at").agg(
        F.count_if(F.col("decision") != "replaced").alias("copies"),
        F.max_by("decision", F.struct("batch_id", F.col("decision") == "replaced")).alias("last"),
        F.max(F.struct(F.when(F.col("decision") != "duplicate", F.col("batch_id")).alias("b"), F.col("decision").alias("x"))).alias("held"))
    kept = F.coalesce(F.col("held.x") == "kept", F.lit(False)) & F.col("held.b").isNotNull()
    return per.select("text_hash", "id", "at", "copies", kept.alias("kept"))


def unique_batch(requests: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The same table from all rows at once: the earliest arrival of every key that is not stored is kept."""
    a = arrivals(requests)
    first = a.groupBy("text_hash").agg(F.min(F.struct("at", "id")).alias("first"))
    rows = a.groupBy("text_hash", "id", "at").agg(F.count("*").alias("copies")).join(first, "text_hash")
    if stored is not None:
        taken = stored.select("text_hash").filter("text_hash is not null").distinct().withColumn("taken", F.lit(True))
        rows = rows.join(taken, "text_hash", "left")
    else:
        rows = rows.withColumn("taken", F.lit(False))
    kept = (F.struct("at", "id") == F.col("first")) & ~F.coalesce("taken", F.lit(False))
    return rows.select("text_hash", "id", "at", "copies", kept.alias("kept"))
