"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import text_of, written
from deskmart.llm.textstats import text_stats

THRESHOLD = 0.3
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "bangs",
            "next_equal", "distinct", "line_words")
_SOFT = 0.01  # share below which the logarithm of a share flattens out


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text: logarithms of lengths and softened logarithms of shares."""
    n = {name: counts.astype(float) for name, counts in text_stats(texts).items()}
    words, chars = np.maximum(n["n_words"], 1), np.maximum(n["word_chars"], 1)
    share = lambda part, whole: np.log(_SOFT + part / whole)
    return np.column_stack([
        np.log1p(n["n_words"]), np.log1p(n["word_chars"] / words), share(n["n_symbols"], chars),
        share(n["n_dup_lines"], np.maximum(n["n_lines"], 1)), share(n["n_repeat_words"], words),
        share(n["n_upper"], chars), share(n["n_digits"], chars), share(n["n_bangs"], chars),
        share(n["n_next_equal"], words), share(n["n_later_words"], words),
        np.log1p(n["n_words"] / np.maximum(n["n_lines"], 1)),
    ])


@dataclass(frozen=True)
class Model:
    """Centres, inverse Cholesky factors and constants of both classes, in scaled features."""

    shift: np.ndarray
    scale: np.ndarray
    centres: np.ndarray
    whiteners: np.ndarray
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1: logistic of the difference of the Mahalanobis log densities."""
        z = (x - self.shift) / self.scale
        logs = [c - 0.5 * (((z - m) @ w.T) ** 2).sum(axis=1)
                for m, w, c in zip(self.centres, self.whiteners, self.constants)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def document_features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the feature vector of every row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1))
            values = pa.array(x.ravel())
            starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(starts, values)], names=["doc_id", "x"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .mapInArrow(run, "doc_id long, x array<double>"))


def learnable() -> F.Column:
    """Rows whose labels may be learned: the CRC-32 of the id as text is not divisible by five."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 != 0


def fit(vectors: DataFrame, labels: DataFrame, shrink: float = 0.1) -> Model:
    """Learn from all learnable labelled rows of ``vectors`` (doc_id, x) and ``labels`` (doc_id, quality).

    Tasks add up counts, sums and products per class, Spark adds these up by key, and the driver
    gets two classes times (1 + d + d*d) numbers. Each class covariance is pulled by ``shrink``
    towards a multiple of the identity, in features scaled by their overall deviation, so it is
    positive definite even for few rows. A class without rows gets the overall moments and the prior of
    half a row. Labels other than 0 and 1 or null are left out; a row with two different labels counts for both.
    """
    d = len(FEATURES)
    known = (labels.where(F.col("quality").isin(0, 1)).where(learnable())
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .distinct())

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if len(batch):
                x, y = np.stack(batch["x"].to_numpy()), batch["quality"].to_numpy()
                for c in (0, 1):
                    own = x[y == c]
                    total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pd.DataFrame({"class": np.repeat([0, 1], total.shape[1]),
                            "k": np.tile(np.arange(total.shape[1]), 2), "v": total.ravel()})

    sums = np.zeros((2, 1 + d + d * d))
    for c, k, v in (vectors.join(known, "doc_id").select("quality", "x")
                    .mapInPandas(partial, "class int, k int, v double")
                    .groupBy("class", "k").agg(F.sum("v").alias("v")).collect()):
        sums[c, k] = v
    return _model(sums, d, shrink)


def _model(sums: np.ndarray, d: int, shrink: float) -> Model:
    whole = sums.sum(axis=0)
    n = max(whole[0], 1)
    shift = whole[1:1 + d] / n
    scale = np.sqrt(np.maximum(np.diag(whole[1 + d:].reshape(d, d)) / n - shift ** 2, 1e-6))
    centres, whiteners, constants = [], [], []
    for own in sums:
        weight = own[0] or 0.5
        own = own if own[0] else (whole if whole[0] else np.r_[1.0, np.zeros(d), np.eye(d).ravel()])
        mean = own[1:1 + d] / own[0]
        spread = (own[1 + d:].reshape(d, d) / own[0] - np.outer(mean, mean)) / np.outer(scale, scale)
        spread = (1 - shrink) * spread + shrink * max(np.trace(spread) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(spread)
        centres.append((mean - shift) / scale)
        whiteners.append(np.linalg.inv(factor))
        constants.append(np.log(weight) - np.log(np.diag(factor)).sum())
    return Model(shift, scale, np.array(centres), np.array(whiteners), np.array(constants))


def score_documents(docs: DataFrame, labels: DataFrame, shrink: float = 0.1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Scores come from the whole text alone. Null and empty texts are scored as texts without words;
    null ids are held out; repeated rows are scored alike; further columns are ignored. Without
    labels all scores are equal; an empty table gives no rows.
    """
    vectors = written(document_features(docs), "features")
    model = fit(vectors, labels, shrink)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    return (vectors.withColumn("score", score("x"))
            .select("doc_id", (~learnable()).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_quality(docs: DataFrame, labels: DataFrame, shrink: float = 0.1) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores THRESHOLD or more.

    A score of just THRESHOLD stays. Null and empty texts are scored as texts without words, repeated rows alike, whole
    texts however long; an empty table stays empty; without labels every row stays.
    """
    model = fit(written(document_features(docs), "features"), labels, shrink)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(features(texts)))

    return docs.where(score(text_of()) >= THRESHOLD)
