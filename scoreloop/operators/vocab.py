"""Vocabulary, fixed-length encoding and a relational linear scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.config import TOKEN_BOS, TOKEN_EOS, TOKEN_PAD, TOKEN_UNK, TRAINING
from scoreloop.functions.tokens import tokens
from scoreloop.operators.sizing import bounded_lookup, global_rank, tiered_lookup

FIRST_ID = TOKEN_UNK + 1


def vocab_build(texts: DataFrame, text: str = "text", size: int | None = None) -> DataFrame:
    """(token, n, token_id) of every token, ids by count desc then token asc,
    starting after the special ids. A caller may keep only the ``size`` most
    frequent. Numbered by the distributed rank, not in one task."""
    counts = (texts.select(F.explode(tokens(text)).alias("token"))
              .groupBy("token").agg(F.count("*").cast("long").alias("n")))
    ranked = global_rank(counts, [F.col("n").desc(), F.col("token").asc()])
    if size is not None:
        ranked = ranked.filter(F.col("rank") <= size)
    return ranked.select("token", "n", (F.col("rank") + FIRST_ID - 1).cast("int").alias("token_id"))


def encode_fixed(df: DataFrame, vocab: DataFrame, key: str = "id", text: str = "text",
                 max_tokens: int = TRAINING.max_tokens) -> DataFrame:
    """Ids with start/end marks, truncated and padded to ``max_tokens``,
    plus the attention mask. Only the first max_tokens-2 tokens can survive
    truncation, so only those are exploded and looked up. The vocabulary
    goes through the size check."""
    keep = max_tokens - 2
    toks = df.select(key, F.posexplode_outer(F.slice(tokens(text), 1, keep)).alias("pos", "token"))
    v = bounded_lookup(vocab.select("token", "token_id")) 
    looked = toks.join(v, "token", "left").select(
        key, "pos", F.coalesce("token_id", F.lit(TOKEN_UNK)).alias("tid"))
    per_doc = looked.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "tid")))).alias("p"))
    ids = F.concat(F.array(F.lit(TOKEN_BOS)), F.transform("p", lambda s: s["tid"]), F.array(F.lit(TOKEN_EOS)))
    n_real = F.size(ids)
    padded = F.concat(ids, F.array_repeat(F.lit(TOKEN_PAD), F.lit(max_tokens) - n_real))
    mask = F.concat(F.array_repeat(F.lit(1), n_real), F.array_repeat(F.lit(0), F.lit(max_tokens) - n_real))
    return per_doc.select(key, padded.alias("input_ids"), mask.alias("attention_mask"))


def token_weights(labelled: DataFrame, text: str = "text", label: str = "quality") -> DataFrame:
    """B15a weights: per token ln((n_pos + 1) / (n_neg + 1)) over labelled texts, and ``n``, how often it was met there."""
    t = labelled.select(F.col(label).alias("y"), F.explode(tokens(text)).alias("token"))
    return t.groupBy("token").agg(
        F.log((F.count_if(F.col("y") == 1) + 1).cast("double") /
              (F.count_if(F.col("y") == 0) + 1).cast("double")).alias("w"), F.count("*").alias("n"))


def prepare_weights(weights: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(weights to broadcast, the others): written once; beyond the broadcast bound the tokens met least often are the others."""
    return tiered_lookup(weights, "n" if "n" in weights.columns else None)


def score_linear(df: DataFrame, weights, key: str = "id", text: str = "text",
                 prepared: bool = False) -> DataFrame:
    """score = sigmoid(mean token weight), unknown tokens weigh 0, a
    text without tokens scores 0.5. The weight table is size-checked before
    it is broadcast (``prepared``: by ``prepare_weights``): a text's tokens are weighed where it is
    read and collapse map-side to one row. Beyond the bound only tokens that are not among the
    broadcast ones travel to the others."""
    often, seldom = weights if prepared else prepare_weights(weights)
    t = df.select(key, F.explode_outer(tokens(text)).alias("token"))
    j = t.join(often.select("token", "w", F.lit(True).alias("found")), "token", "left")
    s = j.groupBy(key).agg(F.sum(F.coalesce("w", F.lit(0.0))).alias("sw"), F.count("token").alias("nt"))
    if seldom is not None:
        rest = j.filter(F.col("found").isNull() & F.col("token").isNotNull()).select(key, "token")
        own = rest.join(seldom.select("token", "w"), "token").groupBy(key).agg(F.sum("w").alias("sw"), F.lit(0).cast("long").alias("nt"))
        s = s.unionByName(own).groupBy(key).agg(F.sum(F.coalesce("sw", F.lit(0.0))).alias("sw"), F.sum("nt").alias("nt"))
    mean = F.when(F.col("nt") > 0, F.col("sw") / F.col("nt")).otherwise(F.lit(0.0))
    return s.select(key, (F.lit(1.0) / (F.lit(1.0) + F.exp(-mean))).alias("score"))
