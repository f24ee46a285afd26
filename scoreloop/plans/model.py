"""Score models on Spark ML (K4, B15b), the user-scorer hook (J4) and the
retrain chain (K5).

The reference fine-tunes a transformer on one GPU; here the regressor is
re-aimed as a distributed Spark ML pipeline over the same word tokens:
tokens -> hashed term counts -> IDF -> a linear head (unbounded) or a
weighted logistic regression (sigmoid head, keeps scores in [0, 1]).
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.config import TOKEN_PATTERN


# the runner and the example scorer travel by value: Python workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NUM_FEATURES = 1 << 18


def _stages(head: str, num_features: int, text: str, label: str, max_iter: int, reg: float):
    """Both heads are fitted by distributed gradients (L-BFGS), so the hashed space
    may be large. The sigmoid head takes soft labels as weights: a row counts as
    class 1 with weight label and as class 0 with weight 1 - label."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    if head == "linear":
        reg_ = LinearRegression(featuresCol="_features", labelCol=label, predictionCol="score",
                                maxIter=max_iter, regParam=reg, solver="l-bfgs")
    elif head == "sigmoid":
        reg_ = LogisticRegression(featuresCol="_features", labelCol="_class", weightCol="_weight", predictionCol="_predicted",
                                  rawPredictionCol="_raw", probabilityCol="_probability", maxIter=max_iter, regParam=reg)
    else:
        raise ValueError(head)
    return tok, tf, idf, reg_


def _as_classes(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label)
    both = F.array(F.struct(F.lit(1.0).alias("c"), y.alias("w")), F.struct(F.lit(0.0).alias("c"), (1.0 - y).alias("w")))
    return (df.withColumn("_x", F.explode(both)).filter("_x.w > 0")
            .withColumns({"_class": F.col("_x.c"), "_weight": F.col("_x.w")}).drop("_x"))


def score_pipeline(head: str = "sigmoid", num_features: int = NUM_FEATURES, text: str = "text",
                   label: str = "label", max_iter: int = 10, reg: float = 0.01) -> Pipeline:
    """The unfitted pipeline: tokens -> hashed counts -> IDF -> head."""
    return Pipeline(stages=list(_stages(head, num_features, text, label, max_iter, reg)))


def train_score_model(train: DataFrame, head: str = "sigmoid", text: str = "text", label: str = "label",
                      num_features: int = NUM_FEATURES, max_iter: int = 10, reg: float = 0.01) -> PipelineModel:
    """K4: fit on (text, label in [0, 1]).

    Texts are tokenized and hashed once; the sparse term counts are
    persisted (memory, spilling to disk; recomputed from lineage if an
    executor is lost) for the IDF pass and the iterative solver, instead
    of re-tokenizing every text on every iteration."""
    data = train.select(F.col(text).alias("text"), F.col(label).cast("double").alias("label")).filter(
        F.col("text").isNotNull() & F.col("label").isNotNull() & ~F.isnan("label"))
    tok, tf, idf, reg_ = _stages(head, num_features, "text", "label", max_iter, reg)
    counts = tf.transform(tok.transform(data)).select("_tf", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf_model = idf.fit(counts)
        fitted = idf_model.transform(counts)
        reg_model = reg_.fit(_as_classes(fitted, "label") if head == "sigmoid" else fitted)
    finally:
        counts.unpersist()
    return PipelineModel(stages=[tok, tf, idf_model, reg_model])


def score_ml(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """One score per row from a fitted pipeline (distributed transform)."""
    out = model.transform(df.withColumn("text", F.coalesce(F.col(text), F.lit(""))))
    if "_probability" in out.columns:
        out = out.withColumn("score", vector_to_array("_probability")[1])
    return out.drop("_tokens", "_tf", "_features", "_raw", "_probability", "_predicted")


def score_udf(df: DataFrame, score_fn: Callable[[pd.Series], pd.Series], key: str = "id",
              text: str = "text") -> DataFrame:
    """A user's own scorer as an Arrow-batched ``mapInPandas`` -- the
    one Python hook. ``score_fn`` maps a Series of texts to a Series of
    floats and should load its model once (e.g. a module-level cache)."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "score": score_fn(pdf[text].fillna("")).astype("float64")})

    in_schema = df.select(key, text)
    key_type = in_schema.schema[key].dataType.simpleString()
    return in_schema.mapInPandas(run, schema=f"{key} {key_type}, score double")


def length_prior_scorer(texts: pd.Series) -> pd.Series:
    """A tiny example scorer for the hook: share of letters among the
    characters, squashed to (0, 1); vectorised over the Arrow batch.
    Stands in for a user's model."""
    letters = texts.str.count(r"[A-Za-z]").to_numpy(dtype="float64")
    total = np.maximum(texts.str.len().to_numpy(dtype="float64"), 1.0)
    return pd.Series(1.0 / (1.0 + np.exp(-(letters / total - 0.5) * 4.0)), index=texts.index)
