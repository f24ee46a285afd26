"""An index of the stored keys beside the feedback store.

The index holds (text_hash, batch_id) in folders by the first hex digits of the hash, sorted by the hash
inside a file, so a lookup lists only the folders of its own prefixes and the reader skips row groups
outside its keys' range. It is derived from the store: it remembers which files of the store it has
read, and ``catch_up`` reads only the others. A crash between an append to the store and the index therefore loses nothing:
the next lookup finds the new file uncovered. ``compact`` writes one sorted file per prefix as a new generation and
only then drops the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.operators.sizing import bounded_lookup
from scoreloop.sources.files import read_parquet_or_none

DIGITS = 2
KEYS = "text_hash string, batch_id long, prefix string"
FILES = "file string, generation int"


def prefix(key, digits: int = DIGITS) -> F.Column:
    """Folder of a key: its first hex digits (``_`` if it has none)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.when(c.rlike(f"^[0-9a-f]{{{digits}}}"), F.substring(c, 1, digits)).otherwise("_")


class KeyIndex:
    """The keys of the feedback store at ``store_path``."""

    def __init__(self, spark: SparkSession, store_path: str, key: str = "text_hash", digits: int = DIGITS, skip_batch: int | None = None):
        self.spark, self.store, self.key, self.digits, self.skip_batch = spark, store_path.rstrip("/"), key, digits, skip_batch
        self.path = f"{self.store}_keys"

    def _files(self) -> DataFrame | None:
        return read_parquet_or_none(self.spark, f"{self.path}/files", FILES)

    def generation(self) -> int:
        files = self._files()
        return 0 if files is None else files.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]

    def _write(self, keys: DataFrame, generation: int) -> None:
        out = keys.withColumn("prefix", prefix("text_hash", self.digits))
        (out.repartition("prefix").sortWithinPartitions("prefix", "text_hash")
         .write.mode("append").partitionBy("prefix").parquet(f"{self.path}/keys-{generation}"))

    def _cover(self, files: list[str], generation: int) -> None:
        self.spark.createDataFrame([(f, generation) for f in files], FILES).coalesce(1).write.mode("append").parquet(f"{self.path}/files")

    def catch_up(self) -> int:
        """Read the store's files that the index has not read; their number."""
        store = read_parquet_or_none(self.spark, self.store)
        if store is None:
            return 0
        generation, files = self.generation(), self._files()
        known = set() if files is None else {r["file"] for r in files.filter(F.col("generation") == generation).select("file").collect()}
        new = sorted(set(store.inputFiles()) - known)  # one name per stored file
        if new:
            part = self.spark.read.option("basePath", self.store).schema(store.schema).parquet(*new)
            batch = F.col("batch_id").cast("long") if "batch_id" in store.columns else F.lit(None).cast("long")
            self._write(part.select(F.col(self.key).alias("text_hash"), batch.alias("batch_id")).filter("text_hash is not null"), generation)
            self._cover(new, generation)  # after its keys: a crash here reads the files again, and keys may repeat
        return len(new)

    def compact(self) -> None:
        """One sorted file per prefix, each key and batch once."""
        old = self.generation()
        covered = [] if self._files() is None else [r["file"] for r in self._files().filter(F.col("generation") == old).select("file").distinct().collect()]
        if not covered:
            return
        self._write(self._keys(old).select("text_hash", "batch_id").distinct(), old + 1)
        self._cover(covered, old + 1)  # from here on readers take the new generation
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/keys-{old}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _keys(self, generation: int) -> DataFrame:
        return self.spark.read.schema(KEYS).parquet(f"{self.path}/keys-{generation}")

    def seen(self, keys: DataFrame, own_batch: int | None = None) -> DataFrame:
        """The distinct ``key`` values of ``keys`` that are stored.

        ``skip_batch`` of the index leaves a batch's own rows out; ``own_batch`` looks only at that batch's rows. Small key sets
        (checked) are broadcast, so the index is read where it lies; beyond the bound both sides meet by a shuffle."""
        self.catch_up()
        wanted = bounded_lookup(keys.select(F.col(self.key).alias("text_hash")).filter("text_hash is not null").distinct())
        if read_parquet_or_none(self.spark, f"{self.path}/files", FILES) is None:
            return wanted.limit(0).withColumnRenamed("text_hash", self.key)
        prefixes = [r[0] for r in wanted.select(prefix("text_hash", self.digits)).distinct().collect()]  # at most 16 ** digits + 1
        found = self._keys(self.generation()).filter(F.col("prefix").isin(prefixes))
        if own_batch is not None:
            found = found.filter(F.col("batch_id") == own_batch)
        elif self.skip_batch is not None:
            found = found.filter(F.col("batch_id").isNull() | (F.col("batch_id") != self.skip_batch))
        return found.join(wanted, "text_hash", "left_semi").select(F.col("text_hash").alias(self.key)).distinct()
