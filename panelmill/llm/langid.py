"""Language identification with string kernels.

The kernel compares which n-grams of bytes two texts have (blended spectrum, presence only, cosine for each n). Landmarks
from the training rows give the Nystroem approximation of the kernel; one-versus-rest kernel ridge regression on it gives
each language a coefficient per landmark. Scoring a batch is a matrix product of its n-gram presence with the landmarks'
presence weighted by those coefficients, which is folded once, as the kernel is linear in a text's normalised presence.
N-grams of two and three bytes are numbered by a hash of 12 and 13 bits, so some share a number: the kernel then takes one
for the other, in every text alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_sample, held_out
from .shared import bounded_batches
from .textkernel import LOWER, PIECE, slices, texts

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageParams:
    """Bounds of the training sample and of the landmarks; bits of the n-gram tables for n = 1, 2, 3; the ridge."""

    sample_rows: int = 1600
    landmarks: int = 320
    bits: tuple[int, ...] = (8, 12, 13)
    ridge: float = 1e-3


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # n-grams by labels
    params: LanguageParams


#: Bytes as the kernel sees them: letters lowered, all that isn't ASCII as it is, the rest a gap.
_SEEN = LOWER.copy()
_SEEN[:128][~np.array([chr(b).isalpha() for b in range(128)])] = 32


def _held(data: np.ndarray, offsets: np.ndarray, p: LanguageParams) -> np.ndarray:
    """Texts by n-grams: 1 where the text has the n-gram."""
    n, first = len(offsets) - 1, _first(p)
    out = np.zeros((n, first[-1]), np.float32)
    for begin in range(0, max(1, len(data)), PIECE):  # a long text in pieces that overlap
        part = _SEEN[data[begin : begin + PIECE + len(p.bits) - 1]].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for k, bits in enumerate(p.bits):
            if len(part) <= k:
                break
            code = code[: len(part) - k] | (part[k:] << np.uint32(8 * k))
            gram = first[k] + ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)
            for i in range(n):
                a, b = max(offsets[i] - begin, 0), min(offsets[i + 1] - begin - k, len(gram))
                if b > a:
                    out[i, gram[a:b]] = 1
    return out


def _first(p: LanguageParams) -> np.ndarray:
    """Where the n-grams of each n begin, and the end."""
    return np.concatenate([[0], np.cumsum([1 << b for b in p.bits])])


def _scaled(held: np.ndarray, p: LanguageParams) -> np.ndarray:
    """For each n the row is scaled to length 1, then all to length 1."""
    first = _first(p)
    for k in range(len(p.bits)):
        block = held[:, first[k] : first[k + 1]]
        block /= np.maximum(np.sqrt(block.sum(axis=1, keepdims=True)), 1)
    return held / np.float32(np.sqrt(len(p.bits)))


def _presence(data: np.ndarray, offsets: np.ndarray, p: LanguageParams) -> np.ndarray:
    return _scaled(_held(data, offsets, p), p)


def _packer(p: LanguageParams):
    """Chosen rows with a bit per n-gram in the place of their text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            rows = [np.packbits(_held(data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i], p) > 0).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary()), batch.column("_number")], names=["lang", "text", "_number"])

    return pack


def fit(docs: DataFrame, params: LanguageParams | None = None) -> LanguageModel:
    """Learn from a bounded sample of the rows of ``docs(doc_id, text, lang, ...)`` that aren't held out and have a lang.

    Tasks send a bit per n-gram of each sampled row, 1.6 KB however long its text.
    """
    p = params or LanguageParams()
    rows = bounded_batches(docs).filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    packed = lambda x: x.mapInArrow(_packer(p), "lang string, text binary, _number long")
    sample = bounded_sample(rows, "lang", ["text"], p.sample_rows, measure=packed)
    labels = sorted({r["lang"] for r in sample})
    if not labels:
        return LanguageModel([], np.zeros((0, 0), np.float32), p)
    bits = np.frombuffer(b"".join(r["text"] for r in sample), np.uint8).reshape(len(sample), -1)
    x = _scaled(np.unpackbits(bits, axis=1)[:, : _first(p)[-1]].astype(np.float32), p)
    y = np.array([[float(r["lang"] == label) for label in labels] for r in sample])
    z = x[:: max(1, -(-len(x) // p.landmarks))]  # the sample is in the order of a hash
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-8 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])  # K_zz ** -1/2
    mapped = (x @ z.T) @ root
    mean = y.mean(axis=0)
    solved = np.linalg.solve(mapped.T @ mapped + p.ridge * len(x) * np.eye(mapped.shape[1]), mapped.T @ (y - mean))
    return LanguageModel(labels, np.vstack([z.T @ (root @ solved), mean]).astype(np.float32), p)


def _scorer(model: LanguageModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ascii_letters = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            found, best = [], []
            for a, b in slices(offsets, PIECE // 4):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                letters = np.concatenate([[0], np.cumsum(ascii_letters[part])])
                has = letters[at[1:]] > letters[at[:-1]]
                for i in np.flatnonzero(~has & (np.diff(at) > 0)):
                    has[i] = any(c.isalpha() for c in part[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace"))
                if model.labels:
                    values = _rows(part, at, model)
                    which = values.argmax(axis=1)
                    found += [model.labels[w] if h else UNKNOWN for w, h in zip(which, has, strict=True)]
                    best.append(np.where(has, np.clip(values.max(axis=1), 0, 1), 0.0))
                else:
                    found += [UNKNOWN] * (b - a)
                    best.append(np.zeros(b - a))
            scores = np.concatenate(best) if best else np.empty(0)
            rest = [batch.column("doc_id"), batch.column("held_out")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return score


def _rows(data: np.ndarray, offsets: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Scores of the texts, 64 at a time."""
    out = []
    for i in range(0, len(offsets) - 1, 64):
        at = offsets[i : i + 65]
        out.append(_presence(data[at[0] : at[-1]], at - at[0], model.params) @ model.weights[:-1] + model.weights[-1])
    return np.concatenate(out)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id long, text string, ...)``.

    lang_pred is a learned language, or ``und`` with score 0 for a null text, one without a letter, and if nothing was
    learned. score is the winning regression value, from 0 to 1. Only the text is used. Ties go to the first language by
    code point; repeated rows get the same result; an empty table gives no rows.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, lang_pred string, score double")
