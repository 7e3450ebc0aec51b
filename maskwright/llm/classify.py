"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance that is shrunk towards the pooled one and then towards its own diagonal. A
document's score follows the difference of the classes' log densities, that is of Mahalanobis distances; each
class's Cholesky factor is inverted once on the driver and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounds, cut_lineage, slices
from .quality import CLASSES, _base_counts, _class_counts

FEATURES = ("words", "chars", "word_length", *(f"share_{c}" for c in CLASSES), "repeat_words", "dup_lines", "distinct_words", "line_words", "bars", "bangs", "caps_words", "longest_word")


@dataclass(frozen=True)
class Discriminant:
    """Shrinkage towards the pooled covariance and towards the diagonal, and the least variance of a feature."""

    pooled: float = 0.3
    diagonal: float = 0.1
    floor: float = 1e-4
    #: The difference of log densities at which the score is 3/4.
    scale: float = 5.0


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES, each transformed so that its distribution is not too far from normal."""
    n = len(offsets) - 1
    base, (start, end, row, h) = _base_counts(data, offsets)
    classes = _class_counts(data, offsets).astype(float)
    chars, n_words = classes.sum(axis=1), base["n_words"].astype(float)
    share = lambda x, of: np.log((x + 0.5) / (of + 1.0))
    per = lambda what: np.bincount(np.searchsorted(offsets, np.flatnonzero(what), "right") - 1, minlength=n).astype(float)
    order = np.lexsort((h, row))
    new = np.r_[True, (row[order][1:] != row[order][:-1]) | (h[order][1:] != h[order][:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(row[order][new], minlength=n).astype(float)
    lines = per(data == 10) + 1
    upper = (data >= 65) & (data <= 90)
    up = np.r_[0, np.cumsum(upper)]
    caps = np.bincount(row[(up[end] - up[start]) * 2 > end - start], minlength=n).astype(float)
    longest = np.zeros(n)
    begin = bounds(row, n)
    has = np.flatnonzero(np.diff(begin) > 0)
    if len(has):
        longest[has] = np.maximum.reduceat(end - start, begin[has])
    columns = [
        np.log1p(n_words),
        np.log1p(chars),
        np.log1p(base["word_chars"] / np.maximum(n_words, 1)),
        *(share(classes[:, i], chars) for i in range(len(CLASSES))),
        share(base["n_repeat_words"], n_words),
        share(base["n_dup_lines"], lines),
        share(distinct, n_words),
        np.log1p(n_words / lines),
        share(per(data == ord("|")), n_words),
        share(per(data == ord("!")), n_words),
        share(caps, n_words),
        np.log1p(longest),
    ]
    return np.stack(columns, axis=1) if n else np.zeros((0, len(FEATURES)))


def document_statistics(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, text):
                x = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([part[doc_id], pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64()))], names=[doc_id, "x"])

    return df.select(doc_id, text).mapInArrow(run, T.StructType([df.schema[doc_id], T.StructField("x", T.ArrayType(T.DoubleType()))]))


@dataclass
class Model:
    mean: np.ndarray  # 2 x d
    whiten: np.ndarray  # 2 x d x d: inverse Cholesky factors
    constant: np.ndarray  # 2: log prior less half the log determinant
    scale: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with priors."""
        log = [self.constant[k] - 0.5 * (((x - self.mean[k]) @ self.whiten[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return log[1] - log[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Strictly increasing in the margin, 0.5 at 0; unlike a logistic curve it keeps far margins apart."""
        m = self.margin(x)
        return 0.5 + 0.5 * m / (self.scale + np.abs(m))


def moments(labelled: DataFrame) -> np.ndarray:
    """Sums of (1, x) (1, x)' by class over all rows of label, x: 2 x (d + 1) x (d + 1). Every task sends one row for each entry."""
    d = len(FEATURES) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d, d))
        for batch in batches:
            label = batch["label"].to_numpy()
            x = batch["x"].flatten().to_numpy().reshape(-1, d - 1)
            x = np.c_[np.ones(len(x)), x]
            for k in (0, 1):
                own = x[label == k]
                total[k] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], names=["at", "v"])

    out = np.zeros(2 * d * d)
    for r in labelled.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():  # 2 d d rows
        out[r["at"]] = r.v
    return out.reshape(2, d, d)


def fit(sums: np.ndarray, rule: Discriminant) -> Model | float:
    """The model, or the share of label 1 where a class has no rows."""
    n = sums[:, 0, 0]
    if not n.all():
        return float(n[1] / n.sum()) if n.sum() else 0.5
    mean = sums[:, 0, 1:] / n[:, None]
    cov = sums[:, 1:, 1:] / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    whiten, constant = [], []
    for k in (0, 1):
        c = (1 - rule.pooled) * cov[k] + rule.pooled * pooled
        c = (1 - rule.diagonal) * c + rule.diagonal * np.diag(np.diag(c)) + rule.floor * np.eye(len(c))
        chol = np.linalg.cholesky(c)
        whiten.append(np.linalg.inv(chol))
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(chol)).sum())
    return Model(mean, np.array(whiten), np.array(constant), rule.scale)


def held_out(doc_id: str):
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rule: Discriminant = Discriminant()) -> DataFrame:
    """Score of every document, learnt from all labelled rows that are not held out.

    Returns doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted. Scores depend on the text alone; a null text is empty and is scored like an
    empty one, repeated rows get equal scores, a null id is never labelled and never held out, labels other than 0 and 1 are not learnt
    from, and several labels of a document count each. Without rows of one class the score is the other's share, without labels 0.5. An
    empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    known = cut_lineage(document_statistics(df, doc_id, text))
    told = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")).filter(~held_out("_id"))
    model = fit(moments(known.join(told, F.col(doc_id) == F.col("_id")).select("label", "x")), rule)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, len(FEATURES))
            score = model.score(x) if isinstance(model, Model) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([batch[doc_id], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[doc_id, "held_out", "score", "predicted"])

    schema = T.StructType([df.schema[doc_id], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return known.select(doc_id, held_out(doc_id).alias("held_out"), "x").mapInArrow(run, schema)
