"""Quality as a regularised quadratic discriminant of transformed text statistics."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from matchlytics.llm.common import list_array, map_blocks, stored, utf8
from matchlytics.llm.sums import matrix, vector_sum

FEATURES = ["bytes", "words", "word_size", "upper", "digits", "symbols", "exclaims", "stops", "beyond_ascii", "lines", "distinct", "repeats", "most_frequent", "dup_lines"]
WIDTH = len(FEATURES)


def statistics(text: bytes) -> np.ndarray:
    """Transformed statistics of a text: logarithms of sizes, square roots of shares. All finite, also of an empty text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(text))
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    shares = [
        counts[65:91].sum() / letters,
        counts[48:58].sum() / size,
        sum(counts[b] for b in b"#*$%&|<>") / size,
        counts[33] / size,
        (counts[44] + counts[46]) / size,
        counts[128:].sum() / size,
        len(lines) / n,
        len(seen) / n,
        sum(map(eq, words, words[1:])) / n,
        max(seen.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    return np.concatenate([[np.log1p(len(text)), np.log1p(len(words)), np.log1p((size - counts[32]) / n)], np.sqrt(shares)])


def with_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features) of every whole text; null: of an empty one."""
    schema = T.StructType([docs.schema[doc_id], T.StructField("features", T.ArrayType(T.DoubleType()))])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            rows = [statistics(t) for t in utf8(batch.column(batch.schema.get_field_index(text)))]
            return {doc_id: batch.column(batch.schema.get_field_index(doc_id)), "features": list_array(np.concatenate(rows), np.full(len(rows), WIDTH), pa.float64())}

        return step

    return map_blocks(docs.select(doc_id, text), make, schema, text)


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors of their shrunk covariances, and log densities' constants."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, from the difference of the log densities by Mahalanobis distances."""
        if not self.means:
            return np.full(len(x), self.prior)
        logs = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def fit(labelled: DataFrame, shrinkage: float = 0.02, floor: float = 1e-4) -> Discriminant:
    """From all rows of (features, label): counts, sums and products for each class are summed over the cluster.

    A class covariance is shrunk towards the pooled one and then towards a multiple of identity by ``shrinkage``. With
    rows of one class only, or none, the score is constant: that class's share of the rows, or a half.
    """
    block = 1 + WIDTH + WIDTH * WIDTH

    def part(batch: pa.RecordBatch) -> np.ndarray:
        x, y = matrix(batch.column(0), WIDTH), batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate([np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()]) for z in (x[y == 0], x[y == 1])])

    sums = vector_sum(labelled.select("features", "label"), 2 * block, part).reshape(2, block)
    n = sums[:, 0]
    if n.min() == 0:
        return Discriminant([], [], [], n[1] / n.sum() if n.sum() else 0.5)
    means = [s[1 : 1 + WIDTH] / s[0] for s in sums]
    covariances = [s[1 + WIDTH :].reshape(WIDTH, WIDTH) / s[0] - np.outer(m, m) for s, m in zip(sums, means)]
    pooled = sum(c * k for c, k in zip(covariances, n)) / n.sum()
    factors, constants = [], []
    for c, k in zip(covariances, n):
        alpha = max(shrinkage, WIDTH / (k + WIDTH))
        c = (1 - alpha) * c + alpha * pooled
        c = (1 - shrinkage) * c + (shrinkage * np.trace(c) / WIDTH + floor) * np.eye(WIDTH) * 0.1
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        constants.append(float(np.log(k / n.sum()) - np.log(np.diag(low)).sum()))
    return Discriminant(means, factors, constants, float(n[1] / n.sum()))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, score) for every row of ``docs``; score is the probability of label 1, from 0 to 1.

    ``labels`` (doc_id, label of 0 or 1) are the rows to learn from; null labels and ids without a document count for
    nothing. Texts are read once: their statistics are kept in a table of some hundred bytes a row, and only that is
    joined with the labels. Null and empty texts are scored too; repeated rows are scored each.
    """
    features = stored(with_features(docs, doc_id, text))
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).alias("label"))
    model = fit(features.join(known, features[doc_id] == known["_id"]))
    schema = T.StructType([docs.schema[doc_id], T.StructField("score", T.DoubleType())])

    def make():
        return lambda batch: {doc_id: batch.column(0), "score": pa.array(model.scores(matrix(batch.column(1), WIDTH)))}

    return map_blocks(features, make, schema, "features")
