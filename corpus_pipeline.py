"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``scoreloop.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. Each is written as Parquet and reread as the next
one's docs. Whole rows travel as one struct, so further columns of any name pass
through. Empty tables give empty results; repeated rows are documents of their own.

1. language_id: learns languages from two thirds of the labelled rows; rejects
   documents whose language is undetermined (null text, or no letter) or scored below
   ``MIN_SCORE`` (letters that look like no language learned; chance is 1/4 with several
   families of several languages, and never below 1/2 with two languages in all).
2. simhash_near_dedup: of each near-duplicate group the document with the smallest
   doc_id stays (null ids last, of equal ids one row).
3. suffix_dedup: removes repeated ``REPEAT``-byte strings from the texts; n_chars follows.
   A character cut in half becomes U+FFFD. Texts without repeats stay as they are (null too).
4. mix_sources: one row per copy that the mix takes; a document taken in part
   keeps its taken words; n_chars follows.
5. bpe_encode: token ids of every text, and whether they decode to its bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.llm import bpe, langid, mixing, simhash, suffix
from scoreloop.llm.common import drop_scratch, read, rest, scratch_of_call, write_scratch
from scoreloop.llm.queries import public_vocabulary

#: No SQL form: trained models, hashes and tokenizers; tests hold the stages against brute force.
ORACLE_SQL = None


#: Least score of a document's language. Chosen on the held-out third of the labelled rows of
#: sf0.01 and sf0.1: README, section llm.
MIN_SCORE = 0.4

#: Bytes of a repeated string that is removed. Passages of over 50 words that documents share have about 250 to
#: 400 bytes, so op4's 400 leaves them; README, section llm, has what other lengths catch and touch.
REPEAT = 200

#: Scratch folders of stages whose results are stored by now.
_LEFT: list[str] = []


def _drop_left(spark: SparkSession) -> None:
    """A stage's docs are stored, so what the stage before it read is spent."""
    while _LEFT:
        drop_scratch(spark, _LEFT.pop())


def _whole(docs: DataFrame):
    """All columns as one struct (without its text, which then travels once, beside it)."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def _unpacked(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` from ``_row``, some of them replaced."""
    return rows.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.filter(rest("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    found = langid.predict(docs.select(_whole(docs.drop("text")), "text"), model, ["_row", "text"])
    return _unpacked(found.filter((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_SCORE)), docs, text=F.col("text"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _drop_left(spark)
    rows, folder = write_scratch(simhash.fingerprints(docs.select(_whole(docs.drop("text")), "text"), ["_row", "text"], size=3)
                            .withColumn("_id", F.monotonically_increasing_id()), "pipeline-fingerprints")
    _LEFT.append(folder)
    narrow = rows.select("_id", "fp", F.col("_row").getField("doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_id")
    low = narrow.groupBy("fp").agg(F.min(order).alias("low"))
    stay = (low.join(simhash.groups(narrow, max_bits=3), "fp").groupBy("group").agg(F.min("low").alias("low"))
            .select(F.col("low._id").alias("_id")))
    return _unpacked(rows.join(stay, "_id", "left_semi"), docs, text=F.col("text"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _drop_left(spark)
    others = docs.drop("text")
    cleaned = suffix.remove_repeats(docs.select(_whole(others), "text"), ["_row"], length=REPEAT)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    chars = F.when(F.col("n_removed") == 0, F.col("_row").getField("n_chars")).otherwise(F.char_length(text).cast("long"))
    return _unpacked(cleaned, docs, text=text, n_chars=chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _drop_left(spark)
    rows, folder = write_scratch(docs.select(_whole(docs), "doc_id", "source", mixing.n_words().alias("size"),
                                        F.monotonically_increasing_id().alias("_id")), "pipeline-sizes")
    _LEFT.append(folder)
    plan = mixing.plan(rows.select("_id", "doc_id", "source", "size")).filter("taken > 0").drop("doc_id", "source", "size")
    taken = mixing.taken_texts(rows.withColumn("text", F.col("_row").getField("text")).join(plan, "_id"))
    return _unpacked(taken, docs, text=F.col("text"), n_chars=F.char_length("text").cast("long"))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _drop_left(spark)
    vocabulary, pattern = public_vocabulary()
    named = {c: f"_c{k}" for k, c in enumerate(docs.columns)}  # no clash with the operator's columns
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    coded = bpe.encode(rows, vocabulary, pattern, rows.columns, text=named["text"], decoded=True,
                       remember=200_000, rows=1_000_000, step=1_000_000)  # beside executors that earlier stages have filled
    keep = [F.col(n).alias(c) for c, n in named.items() if c not in ("n_tokens", "ids", "round_trip")]
    same = F.col("decoded") == F.coalesce(F.col(named["text"]), F.lit("")).cast("binary")
    return coded.select(*keep, "n_tokens", "ids", same.alias("round_trip"))


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup), ("suffix_dedup", suffix_dedup),
          ("mix_sources", mix_sources), ("bpe_encode", bpe_encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; the last one's rows."""
    docs, folders = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch_of_call(spark, keep=folders):
            docs, folder = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
            folders.append(folder)
        drop_scratch(spark, *folders[:-1])
    return STAGES[-1][1](spark, docs, sf_dir)
