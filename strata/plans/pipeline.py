"""R-2: the medallion run for one window, as step jobs and as a whole.

bronze -> silver (+ quality reports) -> keywords -> sentiment -> gold -> verify

Each step job takes the window ``(start, end)`` over one dataset layout
(``{base}/{layer}/{start}_{end}/{table}``), reads its inputs from the layout
and writes new datasets to it, like the reference's jobs; they can run as
separate scheduler tasks or one after the other in :func:`run_pipeline`.
Every step writes a new dataset name (``posts`` -> ``posts_keywords`` ->
``posts_scored``) and never overwrites what it reads. The written tables cut
the lineage: a lost executor costs the recomputation of its step only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import DateLike
from ..operators import gold, nlp, quality, sentiment
from ..schemas import BRONZE
from ..sources import jdbc
from ..sources.parquet import layer_path, read_parquet
from ..sources.sinks import write_sized
from . import entities as E

ENTITY_NAMES = ("users", "posts", "comments", "likes")
GOLD_TABLES = {
    "gold_daily_platform_summary": ("report_date",),
    "gold_post_performance": ("post_id",),
    "gold_user_snapshot": ("user_id",),
    "gold_daily_content_trends": ("report_date", "topic_or_keyword"),
}
# Every layer holds the texts again, some twice: two thirds of what Snappy makes of them.
COMPRESSION = "zstd"
# The columns each gold preview shows, its order and row count.
GOLD_PREVIEWS = {
    "gold_daily_platform_summary": (None, ("report_date",), 5),
    "gold_user_snapshot": (("user_id", "username", "total_posts_per_user", "account_age_days",
                            "user_segment"), ("user_id",), 5),
    "gold_post_performance": (("post_id", "user_id", "post_sentiment", "total_likes",
                               "total_comments"), ("post_id",), 5),
    "gold_daily_content_trends": (("report_date", "topic_or_keyword", "total_mentions",
                                   "trending_rank"), ("report_date", "trending_rank"), 10),
}


@dataclass(frozen=True)
class Layout:
    """Where one run window's datasets live."""
    spark: SparkSession
    base: str
    start: str
    end: str

    def path(self, layer: str, table: str) -> str:
        return layer_path(self.base, layer, self.start, self.end, table)

    def read(self, layer: str, table: str, schema=None) -> DataFrame:
        return read_parquet(self.spark, self.path(layer, table), schema)

    def write(self, df: DataFrame, layer: str, table: str) -> None:
        # Only bronze rows arrive in the source's arbitrary partitioning (JDBC
        # range queries, source files). Silver rows come out of the
        # de-duplication shuffle, the NLP steps map silver files one to one,
        # and gold rows come out of aggregates and joins, all sized by AQE: a
        # rebalance there would shuffle every post and comment text again.
        write_sized(df, self.path(layer, table), rebalance=(layer == "bronze"), compression=COMPRESSION)


# -- bronze ------------------------------------------------------------------

def bronze_job(lay: Layout, table: str, source: DataFrame, entity: E.Entity | None = None,
               end_mode: str = "instant") -> None:
    """B-n: write the run window of a source table to ``bronze/<table>``."""
    entity = entity or E.ENTITIES[table]
    lay.write(E.bronze(source, entity, lay.start, lay.end, end_mode), "bronze", table)


def bronze_from_jdbc(lay: Layout, table: str, url: str, properties: dict[str, str],
                     num_partitions: int = jdbc.DEFAULT_PARTITIONS, split: str = "range",
                     end_mode: str = "instant") -> None:
    """B-n over JDBC: partitioned scan on the table's id (``split`` as in
    :func:`strata.sources.jdbc.read_table`), window pushed down."""
    entity = E.ENTITIES[table]
    src = jdbc.read_table(lay.spark, url, table, entity.id_col, properties,
                          num_partitions=num_partitions, split=split,
                          start=lay.start if entity.time_col else None,
                          end=lay.end if entity.time_col else None, end_mode=end_mode)
    bronze_job(lay, table, src, entity, end_mode)


# -- silver ------------------------------------------------------------------

def silver_job(lay: Layout, table: str, entity: E.Entity | None = None) -> None:
    """T-n: reports to ``reports/<table>_<report>``, cleaned rows to ``silver/<table>``."""
    entity = entity or E.ENTITIES[table]
    src = lay.read("bronze", table, BRONZE[table])
    for report, rdf in E.silver_reports(src, entity).items():
        write_sized(rdf, lay.path("reports", f"{table}_{report}"), rebalance=False)
    lay.write(E.silver(src, entity), "silver", table)


def keyword_step(lay: Layout) -> None:
    """Keywords and cleaned text: ``silver/{posts,comments}_keywords``."""
    posts, comments = nlp.keyword_job(lay.read("silver", "posts"), lay.read("silver", "comments"))
    lay.write(posts, "silver", "posts_keywords")
    lay.write(comments, "silver", "comments_keywords")


def sentiment_step(lay: Layout, model: PipelineModel | DataFrame | str) -> None:
    """Scores from a table of weights, a fitted pipeline or a saved pipeline's path:
    ``silver/*_scored``."""
    if isinstance(model, str):
        model = nlp.load_sentiment_model(model)
    posts, comments = nlp.sentiment_job(lay.read("silver", "posts_keywords"),
                                        lay.read("silver", "comments_keywords"), model)
    lay.write(posts, "silver", "posts_scored")
    lay.write(comments, "silver", "comments_scored")


# -- gold ----------------------------------------------------------------------

def _silver(lay: Layout) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (lay.read("silver", "users"), lay.read("silver", "posts_scored"),
            lay.read("silver", "comments_scored"), lay.read("silver", "likes"))


def daily_summary_job(lay: Layout) -> None:
    _, posts, comments, likes = _silver(lay)
    lay.write(gold.daily_summary(posts, comments, likes), "gold", "gold_daily_platform_summary")


def post_performance_job(lay: Layout) -> None:
    users, posts, comments, likes = _silver(lay)
    lay.write(gold.post_performance(posts, users, likes, comments), "gold",
              "gold_post_performance")


def user_snapshot_job(lay: Layout, as_of: DateLike = None) -> None:
    users, posts, comments, likes = _silver(lay)
    lay.write(gold.user_snapshot(users, posts, comments, likes, as_of=as_of), "gold",
              "gold_user_snapshot")


def content_trends_job(lay: Layout) -> None:
    _, posts, comments, _ = _silver(lay)
    lay.write(gold.content_trends(posts, comments), "gold", "gold_daily_content_trends")


# -- verify --------------------------------------------------------------------

def verify_layer(lay: Layout, layer: str, tables: dict[str, tuple[str, ...]]) -> DataFrame:
    """Row count and NULL-key rows of each table of a layer."""
    return quality.table_checks({t: (lay.read(layer, t), keys) for t, keys in tables.items()})


def verify_gold(lay: Layout) -> DataFrame:
    """V-1: row count and NULL-key rows per gold table."""
    return verify_layer(lay, "gold", GOLD_TABLES)


def verify_bronze(lay: Layout) -> DataFrame:
    """Row count and NULL ids of the bronze entity tables."""
    return verify_layer(lay, "bronze", {t: (E.ENTITIES[t].id_col,) for t in ENTITY_NAMES})


def verify_silver(lay: Layout) -> DataFrame:
    """Row count and NULL ids of the silver entity tables."""
    return verify_layer(lay, "silver", {t: (E.ENTITIES[t].id_col,) for t in ENTITY_NAMES})


def gold_previews(lay: Layout) -> dict[str, DataFrame]:
    """V-1 previews: chosen columns, first rows by key (a deterministic ``show``)."""
    out = {}
    for table, (cols, order, n) in GOLD_PREVIEWS.items():
        df = lay.read("gold", table)
        out[table] = quality.preview(df, list(cols or df.columns), list(order), n)
    return out


# -- whole run -------------------------------------------------------------------

def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame], base: str, start: str,
                 end: str, as_of: DateLike = None, model: PipelineModel | DataFrame | str | None = None,
                 training: tuple[DataFrame, DataFrame] | None = None,
                 likes: E.Entity = E.LIKES_BY_ID, end_mode: str = "instant") -> DataFrame:
    """Run every step; return the gold checks table (rows and NULL keys per table).

    ``sources`` maps ``users / posts / comments / likes`` to source frames
    (JDBC scans from :mod:`strata.sources.jdbc`, or Parquet). Sentiment uses
    ``model`` (a table of weights, a fitted pipeline or a saved one's path) if given,
    else fits a table on ``training = (documents, labels)`` and keeps it under
    ``models/``.
    """
    lay = Layout(spark, base, start, end)
    entity_of = dict(E.ENTITIES, likes=likes)
    for name in ENTITY_NAMES:
        bronze_job(lay, name, sources[name], entity_of[name], end_mode)
    for name in ENTITY_NAMES:
        silver_job(lay, name, entity_of[name])
    keyword_step(lay)
    if model is None:
        if training is None:
            raise ValueError("need a fitted model or (documents, labels) to fit one")
        lay.write(sentiment.fit_weights(nlp.training_set(*training)), "models", "sentiment_weights")
        model = lay.read("models", "sentiment_weights")
    sentiment_step(lay, model)
    daily_summary_job(lay)
    post_performance_job(lay)
    user_snapshot_job(lay, as_of)
    content_trends_job(lay)
    return verify_gold(lay)
