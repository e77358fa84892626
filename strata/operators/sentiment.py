"""Sentiment model as a table, scored by joins, and its evaluation (N-3).

The model is multinomial naive Bayes over TF-IDF weighted words, kept as rows of
``(feature, class, weight)``: a word's weight is its IDF times the logarithm of
its smoothed share of the class, and the empty feature holds the logarithms of
the classes' priors. Fitting is one aggregate over the labelled words; scoring
explodes a text into its words, joins the weights and sums them per class. So
model and vocabulary may grow with the data: a bounded number of frequent words
is looked up in place or broadcast, the others are shuffled, nothing is hashed
into a fixed number of slots, and every step can be said in SQL.

Texts are scored by the digest of their cleaned text: copies share one score, and
rows need no key. Words that no labelled document holds say nothing; an empty
text takes the class with the larger prior; equal scores take the smaller class.
The MLlib pipeline in :mod:`strata.operators.nlp` remains for scoring without a
shuffle where a model of fixed size will do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, write_freed
from .nlp import TEXT_CLEAN, clean_text, training_set

SMOOTHING = 1.0
#: The feature that holds the priors; no word is empty.
PRIOR = ""
#: Frequent words whose weights are broadcast for scoring (about 10 MB).
HEAD_WORDS = 1 << 17
#: The most frequent of them, which every Python worker holds where there are rare words (some MB).
HOT_WORDS = 1 << 16
#: Bytes of texts whose words are told at a time.
TOLD_AT_ONCE = 1 << 22


def words(text: Column | str) -> Column:
    """The words of a cleaned text, in order."""
    c = F.col(text) if isinstance(text, str) else text
    # no lambda: one would keep the words of each text out of the generated code
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), " "), "")


def fit_weights(train: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``feature, class, weight`` of the labelled texts ``train`` (``text_clean``,
    ``label``). Store the result: it is read once per scoring.

    The texts are read once: their words are counted per feature, and the counts (as
    large as the vocabulary) are written to the shared folder (an action). Totals and
    weights come from the counts. The classes, a handful, come to the driver."""
    spark = train.sparkSession
    docs = train.select(words(TEXT_CLEAN).alias("words"), F.col("label").cast("double").alias("class"))
    classes = sorted((r["class"], r["n"]) for r in docs.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect())
    if not classes:
        return spark.createDataFrame([], "feature string, class double, weight double")
    n_docs = sum(n for _, n in classes)

    # every word for the frequency in its class, every different word of a text for the texts that hold it
    listed = docs.select("class", F.explode(F.array(
        F.struct(F.lit(1).alias("tf"), F.lit(0).alias("df"), F.col("words")),
        F.struct(F.lit(0).alias("tf"), F.lit(1).alias("df"), F.array_distinct("words").alias("words")))).alias("l"))
    each = listed.select("class", "l.*").select("class", "tf", "df", F.explode("words").alias("feature"))
    counted = each.groupBy("feature").agg(F.sum("df").alias("df"), *[
        F.sum(F.when(F.col("class") == c, F.col("tf")).otherwise(0)).alias(f"tf{i}") for i, (c, _) in enumerate(classes)])
    path = scratch_path(spark, "sentiment_counts")
    write_freed(counted, path)
    counts = spark.read.schema(counted.schema).parquet(path).withColumn(
        "idf", F.log(F.lit(n_docs + 1) / (F.col("df") + 1)))

    mass = [F.col(f"tf{i}") * F.col("idf") for i in range(len(classes))]
    whole = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(m), F.lit(0.0)) for m in mass]).first()
    vocabulary, totals = whole[0], whole[1:]
    weights = counts.select("feature", F.inline(F.array(*[F.struct(F.lit(c).alias("class"), (F.col("idf") * (
        F.log(mass[i] + smoothing) - F.log(F.lit(totals[i] + smoothing * vocabulary)))).alias("weight"))
        for i, (c, _) in enumerate(classes)])))
    priors = spark.range(1).select(F.lit(PRIOR).alias("feature"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), (F.log(F.lit(n + smoothing)) - F.log(
            F.lit(n_docs + smoothing * len(classes)))).alias("weight")) for c, n in classes])))
    return weights.unionByName(priors)


def _step(columns: list[str]) -> Column:
    """The size of a feature's largest weight, in some hundred steps whatever the weights."""
    size = F.greatest(*[F.abs(F.coalesce(F.col(w), F.lit(0.0))) for w in columns], F.lit(0.0))
    return F.floor(F.log2(1 + size) * 64)


def _steps(wide: DataFrame, columns: list[str]) -> list[tuple[int, int]]:
    """The steps and how many words are on each. Weights grow with a word's rarity, so
    the frequent words come first."""
    return sorted((r["step"], r["n"]) for r in wide.where(F.col("feature") != PRIOR).groupBy(
        _step(columns).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect())


def _first_rare_step(steps: list[tuple[int, int]], most: int) -> int | None:
    """The step below which lie at most ``most`` words; None if all the words are no more."""
    held = 0
    for step, n in steps:
        held += n
        if held > most:
            return step
    return None


@dataclass(frozen=True)
class Tiers:
    """A table of weights made ready for scoring: a row per feature with a weight for
    each of ``classes``, the first steps of the rare words and of those that are not
    the most frequent (None: all the words are frequent), and the most frequent."""
    classes: list[float]
    wide: DataFrame | None = None
    rare: int | None = None
    warm: int | None = None
    hot: pa.Table | None = None

    @property
    def columns(self) -> list[str]:
        return [f"w{i}" for i in range(len(self.classes))]


def tiers(weights: DataFrame, head_words: int = HEAD_WORDS, hot_words: int = HOT_WORDS) -> Tiers:
    """Prepare ``weights`` once for all the tables that are scored under them (an
    action). The rows per feature, as many as the vocabulary, are written to the shared
    folder; at most ``hot_words`` of them and the steps come to the driver."""
    # a handful of classes, so a word meets one row with a weight for each
    classes = sorted(r[0] for r in weights.where(F.col("feature") == PRIOR).select("class").collect())
    if not classes:
        return Tiers([])
    columns = Tiers(classes).columns
    wide = weights.groupBy("feature").agg(*[
        F.sum(F.when(F.col("class") == c, F.col("weight"))).alias(w) for w, c in zip(columns, classes)])
    spark, path = weights.sparkSession, scratch_path(weights.sparkSession, "sentiment_wide")
    write_freed(wide, path)
    wide = spark.read.schema(wide.schema).parquet(path)
    steps = _steps(wide, columns)
    rare = _first_rare_step(steps, head_words)
    if rare is None:
        return Tiers(classes, wide)
    warm = _first_rare_step(steps, min(hot_words, head_words))
    hot = wide.where((F.col("feature") != PRIOR) & (_step(columns) < warm)).select(
        F.col("feature").cast("binary").alias("feature"), *[F.coalesce(F.col(w), F.lit(0.0)).alias(w) for w in columns])
    return Tiers(classes, wide, rare, warm, hot.toArrow())


def _tell_hot(hot: pa.Table) -> Callable:
    """Texts ``key, text`` (binary) to one row of the empty word with the sums of the
    words in ``hot``, and one row ``key, feature, n`` for each other word of the text."""
    columns = hot.column_names[1:]

    def run(batches):
        # the row after the hot words is that of gaps between spaces, the last that of all other words
        known = pa.array([*hot.column(0).to_pylist(), b""], pa.binary())
        weights = np.vstack([np.stack([hot.column(w).to_numpy() for w in columns], axis=1), np.zeros((2, len(columns)))])

        def told(key, text):
            listed = pc.split_pattern(text, " ")  # one word at least, of an empty text a gap
            words, starts = listed.flatten(), listed.offsets.to_numpy()[:-1] - listed.offsets[0].as_py()
            place = pc.index_in(words, value_set=known).fill_null(len(known)).to_numpy()
            sums = np.add.reduceat(weights[place], starts, axis=0)
            other = np.flatnonzero(place == len(known))
            texts = np.searchsorted(starts, other, "right") - 1
            features = pa.concat_arrays([pa.array([b""] * len(key), pa.binary()), words.take(pa.array(other))])
            zeros = np.zeros(len(other))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([key, key.take(pa.array(texts))]), features,
                 pa.array(np.ones(len(features), dtype=np.int64)),
                 *[pa.array(np.concatenate([sums[:, k], zeros])) for k in range(len(columns))]],
                names=["key", "feature", "n", *[f"h{k}" for k in range(len(columns))]])

        for batch in batches:
            key, text = batch.column(0), batch.column(1)
            part = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64)) // TOLD_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for start, end in zip(cuts, cuts[1:]):
                if start < end:
                    yield told(key.slice(start, end - start), text.slice(start, end - start))

    return run


def score_by_weights(df: DataFrame, weights: DataFrame | Tiers, head_words: int = HEAD_WORDS) -> DataFrame:
    """Add ``sentiment`` (DOUBLE class), the class of the largest score of
    ``text_clean`` under ``weights`` (a table, or its :func:`tiers`); a missing
    ``text_clean`` is computed from ``content`` first.

    Where all the words are at most ``head_words``, they are broadcast, met and summed
    per text where the text is read. Else the most frequent are looked up and summed with
    Arrow there, so that only the others become rows; of these, the rest of the
    ``head_words`` frequent ones are broadcast, and the rare ones, as many as the
    vocabulary has, are shuffled to their weights. All the sums together are the score.
    """
    if TEXT_CLEAN not in df.columns:
        df = clean_text(df, "content")
    df = df.withColumn(TEXT_CLEAN, F.coalesce(F.col(TEXT_CLEAN), F.lit(""))).drop("sentiment")
    model = weights if isinstance(weights, Tiers) else tiers(weights, head_words)
    if not model.classes:
        return df.withColumn("sentiment", F.lit(None).cast("double"))
    wide, columns = model.wide, model.columns
    # the digest stands before the explode: beside it, every word would take the digest of its whole text
    digest = F.unhex(F.md5(TEXT_CLEAN))
    # a text that stands k times has every score k times: the largest is the same
    if model.rare is None:
        parts = df.select(digest.alias("key"), F.concat(words(TEXT_CLEAN), F.array(F.lit(PRIOR))).alias(
            "words")).select("key", F.explode("words").alias("feature"))
        summed = parts.join(F.broadcast(wide), "feature")
    else:
        told = [f"h{i}" for i in range(len(columns))]
        parts = df.select(digest.alias("key"), F.col(TEXT_CLEAN).cast("binary").alias("text")).mapInArrow(
            _tell_hot(model.hot), "key binary, feature binary, n long, " + ", ".join(f"{h} double" for h in told)
        ).withColumn("feature", F.col("feature").cast("string"))
        step = _step(columns)
        head = wide.where((F.col("feature") == PRIOR) | ((step >= model.warm) & (step < model.rare))).withColumn(
            "known", F.lit(True))
        tail = wide.where((F.col("feature") != PRIOR) & (step >= model.rare)).select(
            F.col("feature").alias("rest"), *[F.col(w).alias(f"t{w}") for w in columns])
        # what is told so far is one row per text, without a word ...
        unknown = F.when(F.col("known").isNull(), F.col("feature"))
        met = parts.join(F.broadcast(head), "feature", "left").groupBy("key", unknown.alias("rest")).agg(
            F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(w) + F.col(h)).alias(w) for w, h in zip(columns, told)])
        # ... till its own one, which no tail word equals, spreads such rows
        met = met.withColumn("rest", F.coalesce("rest", F.concat(F.lit(" "), F.hex("key"))))
        # merged, for a plan that goes by the files' size expects fewer words than they hold: none is broadcast
        summed = met.join(tail.hint("merge"), "rest", "left").select("key", *[
            F.coalesce(F.col(w), F.col("n") * F.col(f"t{w}")).alias(w) for w in columns])
    scores = summed.groupBy("key").agg(*[F.sum(w).alias(w) for w in columns])
    best = F.array_max(F.array(*[F.struct(F.col(w).alias("score"), F.lit(-c).alias("c"))
                                 for w, c in zip(columns, model.classes)]))["c"]
    told = scores.select(F.col("key").alias("__told"), (-best).alias("sentiment"))
    # the digest is a column of the rows, so that a text that is not asked for is not shuffled for it
    rows = df.withColumn("__key", digest)
    return told.join(rows, F.col("__told") == F.col("__key"), "right").select(*df.columns, "sentiment")


def held_out(key: Column | str, per_mille: int) -> Column:
    """Whether a row is held out: by the digest of its key, the same in any run."""
    c = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.coalesce(F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % 1000 < per_mille, F.lit(False))


def evaluate(documents: DataFrame, labels: DataFrame, label_col: str = "quality", per_mille: int = 250
             ) -> DataFrame:
    """``label, predicted, n``: the confusion matrix of the held-out labels under a
    model fitted on the others (an action)."""
    out = held_out("doc_id", per_mille)
    weights = fit_weights(training_set(documents, labels.where(~out), label_col)).persist()
    try:
        judged = score_by_weights(training_set(documents, labels.where(out), label_col), weights)
        counts = judged.groupBy("label", F.col("sentiment").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
        rows = counts.collect()  # classes times classes
    finally:
        weights.unpersist()
    return documents.sparkSession.createDataFrame(rows, "label double, predicted double, n long")


def class_report(confusion: DataFrame) -> DataFrame:
    """``class, support, predicted, hits, precision, recall, f1, accuracy`` from a
    confusion matrix; a ratio over nothing is 0."""
    pairs = confusion.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")))).alias("x")).select("x.*")
    per = pairs.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    precision, recall = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("support"))
    whole = confusion.agg(ratio(F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)),
                                F.sum("n"))).scalar()
    return per.select("class", "support", "predicted", "hits", precision.alias("precision"), recall.alias("recall"),
                      ratio(2 * precision * recall, precision + recall).alias("f1"), whole.alias("accuracy"))
