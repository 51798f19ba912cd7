"""Quality classification by a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import held_out
from .shared import bounded_batches, give_back, table
from .textkernel import WordHasher, runs, slices, texts

#: Kinds of bytes whose shares are statistics, with the shares that a text of no length is taken to have.
_KINDS = {
    "upper": (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.02),
    "digit": (b"0123456789", 0.001),
    "stop": (b".,;:?'\"()-", 0.03),
    "mark": (b"!#$%&*+/<=>@[\\]^_`{|}~", 0.001),
    "newline": (b"\n", 0.005),
    "space": (b" \t\r", 0.15),
    "high": (bytes(range(128, 256)), 0.02),
}
#: Bytes and words of usual prose that each text is mixed with, so that short texts are unremarkable.
_BYTES, _WORDS = 60, 12
N_STATISTICS = len(_KINDS) + 6


@dataclass(frozen=True)
class QualityParams:
    """Shrinkage of a class covariance towards the pooled one and towards a multiple of the identity; the threshold; the
    labelled rows that teach, all of them up to this bound (in expectation: rows are drawn by a hash of doc_id)."""

    pooled: float = 0.1
    identity: float = 0.02
    threshold: float = 0.3
    sample_rows: int = 200_000


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse of the Cholesky factor of the covariance, and log prior minus half the log determinant."""

    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: the logistic function of the difference of the log densities."""
        logs = [c - 0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1) for m, inv, c in zip(self.means, self.inverses, self.offsets, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def _statistics(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """Texts by statistics, each on a scale on which it is roughly symmetric."""
    n, size = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, N_STATISTICS))
    logit = lambda x, f: np.log(x + f) - np.log(1 - x + f)
    for k, (kind, usual) in enumerate(_KINDS.values()):
        member = np.zeros(256, bool)
        member[list(kind)] = True
        count = np.concatenate([[0], np.cumsum(member[data])])
        out[:, k] = logit((count[offsets[1:]] - count[offsets[:-1]] + _BYTES * usual) / (size + _BYTES), 1e-3)
    words, begin, end, at = hasher.words(data, offsets)
    many = np.diff(at)
    total = np.concatenate([[0], np.cumsum(end - begin)])
    k = len(_KINDS)
    out[:, k] = np.log(many + _WORDS)
    out[:, k + 1] = np.log((total[at[1:]] - total[at[:-1]] + 6 * _WORDS) / (many + _WORDS))
    out[:, k + 2] = 0.3 * np.log(_WORDS)
    out[:, k + 3], out[:, k + 4], out[:, k + 5] = logit(0.08, 0.01), logit(1.0, 0.01), logit(0.7, 0.01)
    for i in range(n):
        w = words[at[i] : at[i + 1]]
        m = len(w)
        if m:
            _, count = np.unique(w, return_counts=True)
            out[i, k + 2] = np.log(len(count) + _WORDS) - 0.7 * np.log(m + _WORDS)
            out[i, k + 3] = logit((count.max() + 0.08 * _WORDS) / (m + _WORDS), 0.01)
            grams = runs(w, 3)
            out[i, k + 4] = logit((len(np.unique(grams)) + _WORDS) / (len(grams) + _WORDS), 0.01)
            out[i, k + 5] = logit((np.count_nonzero(count == 1) + 0.7 * _WORDS) / (m + _WORDS), 0.01)
    return out


def _measured(column: pa.Array, hasher: WordHasher) -> np.ndarray:
    """The statistics of a column's texts."""
    data, offsets = texts(column)
    x = [_statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher) for a, b in slices(offsets)]
    return np.concatenate(x) if x else np.empty((0, N_STATISTICS))


def _measurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        x = _measured(batch.column("text"), hasher)
        ends = np.arange(0, x.size + 1, N_STATISTICS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names=["doc_id", "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (array of double) for every row of ``docs(doc_id, text, ...)``; only the text counts, null as empty."""
    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(_measurer, "doc_id long, x array<double>")


_MOMENTS = "label int, place int, value double"


def _sums(measured: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Count, sums and sums of products by class, of a whole partition's statistics and labels."""
    size = 1 + N_STATISTICS + N_STATISTICS**2
    sums = np.zeros((2, size))
    for x, y in measured:
        for c in (0, 1):
            z = x[y == c]
            sums[c] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([0, 1], size).astype(np.int32)), pa.array(np.tile(np.arange(size), 2).astype(np.int32)), pa.array(sums.ravel())],
        names=["label", "place", "value"],
    )


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _sums((np.asarray(b.column("x").flatten()).reshape(-1, N_STATISTICS), np.asarray(b.column("label"))) for b in batches)


def _text_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    yield from _sums((_measured(b.column("text"), hasher), np.asarray(b.column("label"))) for b in batches)
    give_back()


def teachers(labels: DataFrame, p: QualityParams) -> DataFrame:
    """``doc_id, label`` of the labelled rows that teach: those that aren't held out, about ``sample_rows`` at most."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).filter("label in (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    rate = min(1.0, p.sample_rows / max(1, known.count()))
    return known if rate == 1 else known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(rate * (1 << 30)))


def fit(measured: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> Discriminant:
    """Learn from the ``teachers`` among ``labels(doc_id, quality, ...)`` and their documents in ``measured``.

    Their ids are sent to every task, as their number is bounded; tasks return moments, a few hundred numbers by class.
    Labels other than 0 and 1 are ignored, a repeated label of a document counts once, rows that share a doc_id all teach. A
    class without rows gets the other's moments, and the score is then its prior.
    """
    p = params or QualityParams()
    rows = measured.join(F.broadcast(teachers(labels, p)), "doc_id")
    return _discriminant(rows.select("label", "x").mapInArrow(_moments, _MOMENTS), p)


def fit_texts(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> Discriminant:
    """Like ``fit``, from the texts of ``docs(doc_id, text, ...)``.

    A task measures the texts and adds the moments up in one Python worker. Two in a row would hold two workers a core, and
    Spark keeps those for all later tasks.
    """
    p = params or QualityParams()
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").join(F.broadcast(teachers(labels, p)), "doc_id")
    return _discriminant(rows.select("label", "text").mapInArrow(_text_moments, _MOMENTS), p)


def _discriminant(moments: DataFrame, p: QualityParams) -> Discriminant:
    """The model of the tasks' moments together."""
    sums = np.zeros((2, 1 + N_STATISTICS + N_STATISTICS**2))
    for r in moments.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        sums[r["label"], r["place"]] = r["value"]
    n = sums[:, 0]
    means, covariances = np.zeros((2, N_STATISTICS)), np.zeros((2, N_STATISTICS, N_STATISTICS))
    for c in (0, 1):
        own = sums[c if n[c] else 1 - c]
        means[c] = own[1 : 1 + N_STATISTICS] / max(own[0], 1)
        covariances[c] = own[1 + N_STATISTICS :].reshape(N_STATISTICS, -1) / max(own[0], 1) - np.outer(means[c], means[c])
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / max(n.sum(), 1)
    inverses, offsets = [], []
    for c in (0, 1):
        s = (1 - p.pooled) * covariances[c] + p.pooled * pooled
        s = (1 - p.identity) * s + p.identity * (np.trace(s) / N_STATISTICS + 1e-6) * np.eye(N_STATISTICS)
        factor = np.linalg.cholesky(s)
        inverses.append(np.linalg.inv(factor))
        offsets.append(np.log((n[c] + 1) / (n.sum() + 2)) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(inverses), np.array(offsets))


def _scorer(model: Discriminant):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, N_STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return score


def classify(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id long, text string, ...)``.

    score is the probability of label 1, from 0 to 1, of null and empty texts too; predicted is 1 from ``threshold`` on.
    Only the text is used. Repeated rows are scored alike; an empty table gives no rows.
    """
    p = params or QualityParams()
    measured = table(statistics(docs), "statistics")
    model = fit(measured, labels, p)
    return measured.mapInArrow(_scorer(model), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted")
    )


def _text_score(model: Discriminant):
    """The score as a function of a text column; the row's other columns stay in the JVM."""

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = WordHasher()
        for column in columns:
            yield pa.array(model.score(_measured(column, hasher)))
        give_back()

    return F.arrow_udf(score, "double", F.ArrowUDFType.SCALAR_ITER)


def good(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts 1 for, with all their columns.

    Every row is judged by its own text, in the task that reads it, so rows without a doc_id or with a repeated one are
    judged like others, and what is kept is neither shuffled nor stored. The rows that teach are measured first.
    """
    p = params or QualityParams()
    model = fit_texts(docs, labels, p)
    return docs.filter(_text_score(model)("text") >= p.threshold)
