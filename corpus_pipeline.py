"""From raw documents to packed training sequences.

Five stages, each on all that the one before it kept: documents whose
perplexity under a model of trusted text is too high go; lines of repeated runs
go from all places but the first; of each group of near copies one document
stays; the sources are interleaved at their target weights, small ones more
than once; the result is packed into sequences. A stage's result is written to
the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm.lines import dedup_lines
from strata.llm.mixing import mix
from strata.llm.neardup import near_duplicates
from strata.llm.packing import pack_documents, tokenizer_path
from strata.llm.quality import classify, trusted_ids

# Columns the stages add to rows while they work on them.
TOLD = C.OWN + "told"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's perplexity threshold; those without
    text have no perplexity and stay."""
    judged = classify(docs, trusted_ids(C.table(spark, sf_dir, "labels")), out_col=TOLD)
    return judged.where(F.col(TOLD)["kept"]).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; one that lost
    all its lines goes, one that had none stays. ``n_chars`` follows the text."""
    left = dedup_lines(docs, out_col=TOLD)
    left = left.where((F.col(TOLD)["lost"] == 0) | (F.col(TOLD)["lost"] < F.col(TOLD)["lines"]))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(TOLD)["lost"] == 0, F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return left.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, in one row; rows without an id stay."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select(
        F.col("doc_id").alias(C.OWN + "id")).distinct()
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    some = (docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col(C.OWN + "id")).drop(C.OWN + "id")
            .withColumn(TOLD, F.row_number().over(one)).where(F.col(TOLD) == 1))
    return some.select(*docs.columns).unionAll(docs.where("doc_id is null"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, those of sources that end early
    once more for each epoch."""
    mixed = mix(docs, out_col=TOLD)
    order = [F.col(TOLD)["slot"], F.col(TOLD)["place"]]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: SQL has no suffix sorting, MinHash forest or branch and bound; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with C.temporary(spark):  # what a stage wrote on its way
            docs = C.cut(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"), keep=True)
    return docs
