"""Text operators (N-1..N-4): cleaning, keyword tagging, sentiment scoring.

Cleaning and tagging are single Column expressions (JVM, codegen). Sentiment
is an MLlib pipeline (tokenise -> hashed term frequencies -> IDF -> naive
Bayes): fitting is one distributed pass per stage, and the fitted model's size
is fixed by ``num_features`` and the number of classes, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import KEYWORD_GROUPS, clean_text_col, keyword_group_col
from ..schemas import SILVER_COMMENTS_COLUMNS, SILVER_POSTS_COLUMNS

TEXT_CLEAN = "text_clean"
PREDICTION = "prediction_nb"
NUM_FEATURES = 1 << 18
_MODEL_COLUMNS = ("__words", "__tf", "__features")


def clean_text(df: DataFrame, text_col: str, new_col: str = TEXT_CLEAN) -> DataFrame:
    """N-1: add the normalised text column (see :func:`clean_text_col`)."""
    return df.withColumn(new_col, clean_text_col(text_col))


def tag_keywords(df: DataFrame, key_col: str,
                 groups: Sequence[Sequence[str]] = KEYWORD_GROUPS) -> DataFrame:
    """N-2: add ``keywords``, one of ``groups`` chosen by a hash of the key.

    The reference draws the group at random in a Python UDF; here the choice
    is a deterministic JVM expression, so retries and re-runs agree.
    """
    return df.withColumn("keywords", keyword_group_col(key_col, groups))


def keyword_job(posts: DataFrame, comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyword step of the pipeline: tags and cleaned text on both tables."""
    p = clean_text(tag_keywords(posts, "post_id"), "content")
    c = clean_text(tag_keywords(comments, "comment_id"), "content")
    return p, c


def sentiment_pipeline(num_features: int = NUM_FEATURES, smoothing: float = 1.0) -> Pipeline:
    """Unfitted pipeline: ``text_clean`` -> ``prediction_nb``."""
    return Pipeline(stages=[
        Tokenizer(inputCol=TEXT_CLEAN, outputCol="__words"),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="__features"),
        NaiveBayes(featuresCol="__features", labelCol="label", predictionCol=PREDICTION,
                   rawPredictionCol="", probabilityCol="",  # the class alone is used
                   smoothing=smoothing, modelType="multinomial"),
    ])


def training_set(documents: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """``text_clean, label`` from labelled documents (inner join on doc_id)."""
    labelled = labels.where(F.col(label_col).isNotNull()).select(
        "doc_id", F.col(label_col).cast("double").alias("label"))
    return (documents.select("doc_id", "text").join(labelled, "doc_id")
            .select(clean_text_col("text").alias(TEXT_CLEAN), "label"))


def train_sentiment(documents: DataFrame, labels: DataFrame, label_col: str = "quality",
                    num_features: int = NUM_FEATURES) -> PipelineModel:
    """Fit the sentiment pipeline on labelled documents (an action).

    The labelled documents are read, joined, cleaned, tokenised and hashed
    once: the term-frequency vectors are persisted (memory, spilling to
    disk) for the two fitting passes (IDF, then naive Bayes) and released
    afterwards. ``Pipeline.fit`` would recompute the whole chain for each
    pass. A lost executor's blocks are recomputed from the lineage.
    """
    tokenizer, hashing, idf, bayes = sentiment_pipeline(num_features).getStages()
    tf = (hashing.transform(tokenizer.transform(training_set(documents, labels, label_col)))
          .select(hashing.getOutputCol(), "label")
          .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        idf_model = idf.fit(tf)
        bayes_model = bayes.fit(idf_model.transform(tf))
    finally:
        tf.unpersist()
    return PipelineModel(stages=[tokenizer, hashing, idf_model, bayes_model])


def load_sentiment_model(path: str) -> PipelineModel:
    """A saved sentiment pipeline (any Hadoop URI)."""
    return PipelineModel.load(path)


def score_sentiment(df: DataFrame, model: PipelineModel | DataFrame) -> DataFrame:
    """N-3: add ``sentiment`` (DOUBLE class) predicted from ``text_clean``.

    ``model`` is a fitted pipeline, a table of weights or its tiers (see
    :mod:`strata.operators.sentiment`). A missing ``text_clean`` is computed from
    ``content`` first; the model's working columns are dropped again.
    """
    if not isinstance(model, PipelineModel):
        from .sentiment import score_by_weights
        return score_by_weights(df, model)
    if TEXT_CLEAN not in df.columns:
        df = clean_text(df, "content")
    df = df.withColumn(TEXT_CLEAN, F.coalesce(F.col(TEXT_CLEAN), F.lit("")))
    if "sentiment" in df.columns:
        df = df.drop("sentiment")
    scored = model.transform(df)
    if PREDICTION in scored.columns:
        scored = scored.withColumnRenamed(PREDICTION, "sentiment")
    return scored.drop(*[c for c in _MODEL_COLUMNS if c in scored.columns])


def sentiment_job(posts_kw: DataFrame, comments_kw: DataFrame, model: PipelineModel | DataFrame
                  ) -> tuple[DataFrame, DataFrame]:
    """N-4: score both tables and project to the silver columns. A table of weights is
    made ready once for both (an action)."""
    if isinstance(model, DataFrame):
        from .sentiment import tiers
        model = tiers(model)
    posts = score_sentiment(posts_kw, model).select(*SILVER_POSTS_COLUMNS)
    comments = score_sentiment(comments_kw, model).select(*SILVER_COMMENTS_COLUMNS)
    return posts, comments
