"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each document becomes eight transformed statistics, computed by built-in functions. Per class,
mean and covariance come from sums that Spark adds up over all training rows; a covariance is
shrunk towards the pooled one and a scaled identity. The score is the logistic of the
difference of the classes' log densities (Mahalanobis distances through Cholesky factors that
are computed once and travel to the tasks) and prior odds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import SYMBOLS, WORD, once, ship_package, squeezed, text_of, written

#: Weight of the target (half pooled covariance, half scaled identity) in each covariance.
SHRINKAGE = 0.2
#: Statistics are rounded to this step, so that sums are exact and do not depend on the order
#: in which Spark adds them: reruns agree to the last bit.
STEP = 1.0 / 1024
N_FEATURES = 8


def with_statistics(docs: DataFrame, keep: list) -> DataFrame:
    """The columns ``keep`` of ``docs`` and stats, array<double> of the text's statistics, defined
    for the empty text too. What several of them need is computed once per text."""
    text = F.col("stats_text")
    count = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    parts = docs.select(*keep, text_of().alias("stats_text")).select("*", once(
        words=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        chars=F.greatest(F.length(squeezed(text)), F.lit(1)),
        lines=F.greatest(F.regexp_count(text, F.lit(r"(?m)^.*[^\x20\x09-\x0D]")), F.lit(1)),
        capitals=F.regexp_count(text, F.lit(r"\p{Lu}")), symbols=count(SYMBOLS), shouts=count("!"), stops=count(".,")))
    kept = [c for c in parts.columns if c not in ("stats_text", "words", "chars", "lines", "capitals", "symbols", "shouts", "stops")]
    n_words = F.size("words")
    per_mille = lambda c: F.log1p(F.col(c) * 1000.0 / F.col("chars"))
    stats = [F.log1p(n_words), F.col("chars") / F.greatest(n_words, F.lit(1)), per_mille("symbols"), per_mille("capitals"),
             per_mille("shouts"), per_mille("stops"), F.size(F.array_distinct("words")) / F.greatest(n_words, F.lit(1)),
             F.log1p(n_words / F.col("lines"))]
    return parts.select(*kept, once(stats=F.array(*[F.rint(c.cast("double") / STEP) * STEP for c in stats])))


@dataclass
class Model:
    """Means and Cholesky factors by class, over standardised statistics."""
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]  # log prior minus half the log determinant

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        side = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            u = np.linalg.solve(factor, (z - mean).T)
            side.append(offset - 0.5 * (u * u).sum(axis=0))
        return side[1] - side[0]


def class_sums(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per label the sum of [1, x] [1, x]^T over rows (label, stats). Spark adds the products
    up by label and matrix cell, so what reaches the driver is two small matrices."""
    d = N_FEATURES + 1
    ext = F.concat(F.array(F.lit(1.0)), F.col("stats"))
    products = rows.select("label", ext.alias("x")).select(
        "label", *[(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)])
    sums = products.groupBy("label").agg(*[F.sum(c).alias(c) for c in products.columns[1:]])
    out = {}
    for row in sums.collect():  # a row per class
        m = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                m[i, j] = m[j, i] = row[f"p{i}_{j}"]
        out[row["label"]] = m
    return out


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Model | None:
    """The model from rows (label 0 or 1, stats); None if a class has no rows."""
    sums = class_sums(rows)
    if set(sums) != {0, 1}:
        return None
    total = sums[0] + sums[1]
    n = total[0, 0]
    centre = total[0, 1:] / n
    scale = np.sqrt(np.maximum(np.diag(total)[1:] / n - centre ** 2, 0.0)) + 1e-6
    means, covs, priors = [], [], []
    for k in (0, 1):
        m, count = sums[k], sums[k][0, 0]
        mean = m[0, 1:] / count
        cov = m[1:, 1:] / count - np.outer(mean, mean)
        means.append((mean - centre) / scale)
        covs.append(cov / np.outer(scale, scale))
        priors.append(count / n)
    pooled = priors[0] * covs[0] + priors[1] * covs[1]
    target = 0.5 * pooled + 0.5 * np.eye(N_FEATURES) * max(np.trace(pooled) / N_FEATURES, 1e-6)
    factors = [np.linalg.cholesky((1 - shrinkage) * c + shrinkage * target) for c in covs]
    offsets = [float(np.log(p) - np.log(np.diag(f)).sum()) for p, f in zip(priors, factors, strict=True)]
    return Model(centre, scale, means, factors, offsets)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, stats) of labelled rows that are not held out. A doc_id with different labels, or
    a null one, teaches nothing."""
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("label"), F.max("quality").alias("most")).filter("label = most")
             .filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("label_id"), "label"))
    return stats.join(known, stats["doc_id"] == known["label_id"]).select("label", "stats")


def score_of(model: Model | None, stats: Column) -> Column:
    """Score column in [0, 1]; 0.5 everywhere without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        odds = model.log_odds(np.stack(x.to_numpy())) if len(x) else np.array([])
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(odds, -700.0, 700.0))))

    return score(stats)


def classify(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is an input. Null text counts as empty; a null doc_id is not held out;
    repeated rows get equal scores; without rows of both classes every score is 0.5; an empty
    table gives none; other columns are not read.
    """
    ship_package(docs.sparkSession)
    stats = written(with_statistics(docs, ["doc_id"]), "qda-statistics")
    model = fit(training_rows(stats, labels), shrinkage)
    return (stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_of(model, F.col("stats")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    ship_package(docs.sparkSession)
    held = with_statistics(docs, [F.struct("*").alias("row"), "doc_id"])
    model = fit(training_rows(held.select("doc_id", "stats"), labels), shrinkage)
    return held.filter(score_of(model, F.col("stats")) >= 0.5).select("row.*")
