"""Quality rules: robust multivariate outliers (operator 6).

Each document becomes a vector of transformed statistics. For every language
and source the minimum-covariance-determinant estimate finds the half-sample
with the tightest scatter: from two robust starts, concentration steps keep the
share H of the documents nearest to the current centre and re-estimate centre
and scatter from them; the start that ends with the smaller determinant wins. A
document is rejected when its squared Mahalanobis distance, scaled so that the
median is that of a chi-squared variable, passes a high quantile.

Sums are over integers (statistics in steps of 1/1024) and quantiles over
histograms of such steps, so they do not depend on the order of rows, and a
group that holds most of the corpus is reduced in part on every task. A group
with few documents is judged with its language's other small groups, and if
these are few too, with those of all languages; fewer than that are not judged.

Null texts have no words and fail the base rules; null languages and sources
form groups of their own; repeated rows each count; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,")

#: Steps per unit of a statistic.
STEP = 1024
#: Statistics and the least standard deviation each is taken to have.
FLOORS = {"word_length": 0.06, "symbols": 0.06, "dup_lines": 0.15, "repeats": 0.15, "upper": 0.05, "marks": 0.06}
DIMS = tuple(FLOORS)
#: Share of a group that the scatter is estimated from.
H = 0.75
#: Concentration steps.
STEPS = 3
#: Fewest documents of a group of its own.
MIN_ROWS = 100
#: Chi-squared with six degrees of freedom: its median, and the value that one
#: vector in a million of normal ones passes.
CHI2_MEDIAN = 5.348
CUTOFF = 38.26

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes]) -> int:
    """Words in five-word windows that the text holds twice or more."""
    n = len(words)
    if n < 6:
        return 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered, upto = 0, 0
    for at, w in enumerate(windows):
        if w in twice:
            covered += at + 5 - max(at, upto)
            upto = at + 5
    return covered


def dup_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def without(raw: bytes, chars: bytes) -> int:
    """How many of the bytes ``chars`` a text holds."""
    return len(raw) - len(raw.translate(None, chars))


def vector(n_words, word_chars, n_symbols, n_dup, n_lines, n_repeat, n_upper, n_marks) -> tuple[int, ...]:
    """The transformed statistics, in steps. Added constants keep the shares of
    short texts near the middle."""
    return tuple(round(STEP * x) for x in (
        math.log((word_chars + 300) / (n_words + 50)),
        math.sqrt(n_symbols / (n_words + 20)),
        math.sqrt(n_dup / (n_lines + 5)),
        math.sqrt(n_repeat / (n_words + 50)),
        math.sqrt(n_upper / (word_chars + 200)),
        math.sqrt(n_marks / (word_chars + 200))))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """Base statistics and the vector of every document."""
    def measure(batch):
        out = {name: [] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        vectors = []
        for raw in C.raw_texts(batch):
            words = raw.split()
            chars = len(raw.decode()) - without(raw, SPACES)
            row = (len(words), chars, without(raw, SYMBOLS), dup_lines(raw), repeat_words(words))
            for column, value in zip(out.values(), row):
                column.append(value)
            vectors.append(vector(*row[:4], raw.count(b"\n") + 1, row[4], without(raw, UPPER), without(raw, MARKS)))
        return out | {"doc_id": batch.column("id"), "lang": batch.column("lang"), "source": batch.column("source"),
                      **dict(zip(DIMS, map(list, zip(*vectors))))}

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    id_type = docs.schema["id"].dataType.simpleString()
    return C.map_batches(docs, measure, f"doc_id {id_type}, lang string, source string, {BASE}, "
                         + ", ".join(f"{d} long" for d in DIMS)).withColumnRenamed("doc_id", id_col)


def with_groups(stats: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Adds ``grp``: the language and source, or where these have few documents
    a wider pool; null where even that is small."""
    n = stats.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = n.where(F.col("n") < min_rows).groupBy("lang").agg(F.sum("n").alias("n_lang"))
    rest = small.where(F.col("n_lang") < min_rows).select(F.coalesce(F.sum("n_lang"), F.lit(0))).scalar()
    lang, source = F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00"))
    level = (F.when(F.col("n") >= min_rows, F.concat_ws("\x01", F.lit("s"), lang, source))
             .when(F.col("n_lang") >= min_rows, F.concat_ws("\x01", F.lit("l"), lang))
             .when(rest >= min_rows, F.lit("rest")))
    small = small.withColumnRenamed("lang", "small_lang")
    groups = C.cut(n.join(small, F.col("lang").eqNullSafe(F.col("small_lang")), "left")
                   .select(lang.alias("g_lang"), source.alias("g_source"), level.alias("grp")), "rule_groups")
    return (stats.join(C.measured(groups), (lang == F.col("g_lang")) & (source == F.col("g_source")), "left")
            .drop("g_lang", "g_source"))


def by_dim(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row per statistic: (grp, dim, v)."""
    return df.select("grp", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), c.alias("v"))
                                                for d, c in columns.items()])).alias("x")).select("grp", "x.*")


def pivoted(df: DataFrame, prefix: str) -> DataFrame:
    return df.groupBy("grp").agg(*[F.max(F.when(F.col("dim") == d, F.col("v"))).alias(prefix + d) for d in DIMS])


def moments(columns: list[Column]) -> list[Column]:
    p = len(columns)
    return [F.count("*").alias("n"), *[F.sum(columns[i]).alias(f"s{i}") for i in range(p)],
            *[F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]]


def _scatter(row, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance, in units, of integer moments."""
    n = row["n"]
    mean = np.array([row[f"s{i}"] for i in range(p)], dtype=float) / n
    cov = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            cov[i, j] = cov[j, i] = float(row[f"s{i}_{j}"]) / n - mean[i] * mean[j]
    return mean / STEP, cov / STEP ** 2


FIT = "grp string, start string, mean array<double>, inv array<double>, log_det double"


def _fit(grp: str, start: str, mean: np.ndarray, cov: np.ndarray) -> dict:
    cov = cov + np.diag(np.square(list(FLOORS.values())))
    return dict(grp=grp, start=start, mean=list(mean), inv=list(np.linalg.inv(cov).ravel()),
                log_det=float(np.linalg.slogdet(cov)[1]))


def fits(sums: DataFrame, start: str | None = None) -> DataFrame:
    """Estimates from a table of moments, a row per group (and start)."""
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                mean, cov = _scatter(row, len(DIMS))
                if start == "tanh":  # correlation of the squashed statistics, scaled back by the MADs
                    sd = np.sqrt(np.diag(cov))
                    corr = np.divide(cov, np.outer(sd, sd), out=np.zeros_like(cov), where=np.outer(sd, sd) > 0)
                    np.fill_diagonal(corr, 1)
                    mad = np.array([row["mad_" + d] for d in DIMS], dtype=float) * 1.4826 / STEP
                    med = np.array([row["med_" + d] for d in DIMS], dtype=float) / STEP
                    rows += [_fit(row["grp"], "tanh", med, corr * np.outer(mad, mad)),
                             _fit(row["grp"], "mad", med, np.diag(np.square(mad)))]
                else:
                    rows.append(_fit(row["grp"], row["start"], mean, cov))
            if rows:
                yield pd.DataFrame(rows)

    return sums.mapInPandas(run, FIT)


def distance() -> Column:
    """Squared Mahalanobis distance from the joined estimate."""
    p = len(DIMS)
    x = [F.col(d) / F.lit(float(STEP)) - F.col("mean")[i] for i, d in enumerate(DIMS)]
    return sum((x[i] * x[j] * (F.col("inv")[i * p + j] * (1 if i == j else 2)) for i in range(p) for j in range(i, p)),
               F.lit(0.0))


def mcd(vectors: DataFrame, share: float = H, steps: int = STEPS) -> DataFrame:
    """Estimates (grp, mean, inv, scale) of the groups of ``vectors``, whose
    rows are stored. ``scale`` takes the median distance to chi-squared's."""
    med = C.cut(pivoted(C.step_quantile(by_dim(vectors, {d: F.col(d) for d in DIMS}), ["grp", "dim"], "v", 0.5), "med_"),
                "rule_medians")
    centred = vectors.join(C.measured(med), "grp")
    mad = pivoted(C.step_quantile(by_dim(centred, {d: F.abs(F.col(d) - F.col("med_" + d)) for d in DIMS}),
                                ["grp", "dim"], "v", 0.5), "mad_")
    middle = C.measured(C.cut(med.join(mad, "grp"), "rule_middles"))
    squashed = [F.round(STEP * F.tanh((F.col(d) - F.col("med_" + d)) / (1.4826 * F.greatest(
        F.col("mad_" + d), F.lit(FLOORS[d] * STEP))))).cast("long") for d in DIMS]
    sums = vectors.join(middle, "grp").groupBy("grp").agg(*moments(squashed)).join(middle, "grp")
    fit = C.cut(fits(sums, "tanh"), "rule_fit")
    fine = F.floor(256 * F.log2(1 + F.greatest(distance(), F.lit(0.0)))).alias("d")
    for _ in range(steps):
        near = vectors.join(C.measured(fit), "grp").select("grp", "start", *DIMS, fine)
        limit = C.measured(C.cut(C.step_quantile(near.select("grp", "start", "d"), ["grp", "start"], "d", share)
                                 .withColumnRenamed("d", "limit"), "rule_limit"))
        kept = near.join(limit, ["grp", "start"]).where(F.col("d") <= F.col("limit"))
        fit = C.cut(fits(kept.groupBy("grp", "start").agg(*moments([F.col(d) for d in DIMS]))), "rule_fit")
    best = fit.groupBy("grp").agg(F.min_by(F.struct("mean", "inv"), F.struct("log_det", "start")).alias("b"))
    best = C.cut(best.select("grp", "b.*"), "rule_best")
    half = C.step_quantile(vectors.join(C.measured(best), "grp").select("grp", fine), ["grp"], "d", 0.5)
    scale = F.greatest((F.pow(F.lit(2.0), (F.col("d") + 1) / 256) - 1) / CHI2_MEDIAN, F.lit(1.0))
    return C.cut(best.join(half, "grp").select("grp", "mean", "inv", scale.alias("scale")), "rule_estimates")


def judge(docs: DataFrame, cutoff: float = CUTOFF, **columns: str) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` and ``kept`` of every document."""
    stats = with_groups(C.cut(statistics(docs, **columns), "rule_statistics"))
    stats = C.cut(stats, "rule_vectors")
    # a document without words has no vector
    estimates = mcd(stats.where("grp is not null and n_words > 0").select("grp", *DIMS))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (stats.join(C.measured(estimates), "grp", "left")
            .withColumn("base_failed", failed)
            .withColumn("distance", distance() / F.col("scale"))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))
            .drop("mean", "inv", "scale"))


def op6_covariance_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance")
