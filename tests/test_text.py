"""Text cleaning, keyword tagging and sentiment scoring."""

from pyspark.sql import functions as F

from strata.functions.text import KEYWORD_GROUPS, clean_text_col, keyword_bucket
from strata.operators import nlp

from conftest import SF_SMALL


def _clean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(clean_text_col("t")).collect()]


def test_clean_text_examples(spark):
    assert _clean(spark, ["Đây LÀ  Test!! https://a.b/c?x=1 #tag_1 nan"]) == ["đây là test tag 1 nan"]
    assert _clean(spark, [None, "nan", "NaN", "  ", "http://x.y/z"]) == ["", "", "", "", ""]
    assert _clean(spark, ["a\t\nb---c", "Ünïcödé 123_456"]) == ["a b c", "ünïcödé 123 456"]
    # only the whole value "nan" (any case) is missing; padded or longer text is kept
    assert _clean(spark, ["NAN", " nan", "nan.", "nana", "na"]) == ["", "nan", "nan", "nana", "na"]


def test_clean_text_non_string_input(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(clean_text_col("x")).collect()] == ["1 5", ""]


def test_keywords_deterministic_and_from_groups(spark):
    df = spark.range(200).select(F.col("id").cast("int").alias("post_id"))
    a = nlp.tag_keywords(df, "post_id").collect()
    b = nlp.tag_keywords(df.repartition(7), "post_id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    groups = {tuple(g) for g in KEYWORD_GROUPS}
    assert {tuple(r.keywords) for r in a} == groups
    buckets = df.select(keyword_bucket("post_id", 4).alias("b")).distinct().collect()
    assert {r.b for r in buckets} == {0, 1, 2, 3}


def test_null_key_gets_null_keywords(spark):
    df = spark.createDataFrame([(None,)], "post_id int")
    assert nlp.tag_keywords(df, "post_id").first().keywords is None


def test_sentiment_train_save_load_score(spark, tmp_path):
    from pyspark.ml import PipelineModel
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = nlp.train_sentiment(docs, labels)
    path = str(tmp_path / "model")
    model.save(path)
    loaded = PipelineModel.load(path)
    posts = docs.select(F.col("doc_id").cast("int").alias("post_id"),
                        F.col("text").alias("content"))
    a = nlp.score_sentiment(posts, model)
    b = nlp.score_sentiment(posts, loaded)
    assert set(a.columns) == {"post_id", "content", "text_clean", "sentiment"}
    ra = {r.post_id: r.sentiment for r in a.collect()}
    rb = {r.post_id: r.sentiment for r in b.collect()}
    assert ra == rb and set(ra.values()) <= {0.0, 1.0} and len(ra) == docs.count()


def test_sentiment_handles_null_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = nlp.train_sentiment(docs, labels)
    df = spark.createDataFrame([(1, None), (2, "hello world")], "post_id int, content string")
    out = nlp.score_sentiment(df, model).collect()
    assert len(out) == 2 and all(r.sentiment in (0.0, 1.0) for r in out)
