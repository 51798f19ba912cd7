"""Vector compression by product codebooks of integers, with equal-average nearest-neighbour search.

A vector's components become integers, floor(scale * x), and are cut into equal consecutive parts. Every part position has
a codebook; a vector is stored as the number of the nearest entry in each. Codebooks start as the parts of the vectors of
smallest id and go through rounds of assignment and means. A round is one scan: tasks add up the parts of each entry, the
sums are added by Spark, and only finished codebooks (parts x entries x components) are on the driver.

The search sorts a codebook by component sum. From where a part's own sum falls it goes outward on both sides, and a side
ends where the squared gap of the sums over the dimension strictly exceeds the best distance so far: that bounds the
distance of all entries beyond (Cauchy-Schwarz), and entries at equal distance are still seen, so ties go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, join_groups, table


@dataclass(frozen=True)
class CodeParams:
    """Parts of a vector, entries of a codebook (256 at most), rounds of assignment and means, and the integers' scale."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass
class Codebooks:
    """``entries[part, entry, component]``, 64-bit integers; without any kept vector there are no entries."""

    entries: np.ndarray
    scale: int
    sorted: list[tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self) -> None:
        self.sorted = []
        for book in self.entries:
            sums = book.sum(axis=1)
            order = np.argsort(sums, kind="stable")
            self.sorted.append((order, sums[order]))

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Digest of all components as decimal integers, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of components of the part position: the nearest entry's index and its squared distance."""
        book, (order, sums) = self.entries[part], self.sorted[part]
        k, d = book.shape
        own = x.sum(axis=1)
        right = np.minimum(np.searchsorted(sums, own), k - 1)
        which = order[right]
        best = _distances(x, book[which])
        for step, at in ((1, right + 1), (-1, right - 1)):
            rows = np.arange(len(x))
            while len(rows):
                rows = rows[(at[rows] >= 0) & (at[rows] < k)]
                gap = own[rows] - sums[at[rows]]
                rows = rows[gap * gap <= best[rows] * d]
                candidate = order[at[rows]]
                distance = _distances(x[rows], book[candidate])
                better = (distance < best[rows]) | ((distance == best[rows]) & (candidate < which[rows]))
                best[rows[better]], which[rows[better]] = distance[better], candidate[better]
                at[rows] += step
        return which, best


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def _integers(column: pa.Array, dims: int | None, scale: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are kept (not null, every component finite), which of them have ``dims`` components, and those rows' integers.

    Integers are held within 2^28 over a part's dimension, so that squares and their sums stay within 64 bits.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pa.types.is_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    offsets = column.offsets.to_numpy().astype(np.int64)
    lo, hi = int(offsets[0]) if len(offsets) else 0, int(offsets[-1]) if len(offsets) else 0
    flat = column.values.slice(lo, hi - lo).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    offsets = offsets - lo
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    length = np.diff(offsets)
    kept = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    if dims is None:
        return kept, length, np.empty((0, 0), np.int64)
    fits = kept & (length == dims)
    rows = np.flatnonzero(fits)
    values = flat[(offsets[rows][:, None] + np.arange(dims)).ravel()].reshape(len(rows), dims)
    most = float((1 << 28) // max(1, dims // parts))
    with np.errstate(over="ignore"):
        return kept, fits, np.clip(np.floor(values * scale), -most, most).astype(np.int64)


def _parts(x: np.ndarray, books: Codebooks) -> Iterator[tuple[int, np.ndarray]]:
    d = books.entries.shape[2]
    for part in range(books.entries.shape[0]):
        yield part, np.ascontiguousarray(x[:, part * d : (part + 1) * d])


def _sums(books: Codebooks):
    """Per task, the sum of every component and the number (component -1) of the parts nearest to each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, k, d = books.entries.shape
        total, count = np.zeros((p, k, d), np.int64), np.zeros((p, k), np.int64)
        for batch in batches:
            _, _, x = _integers(batch.column(0), books.dims, books.scale, p)
            for part, own in _parts(x, books):
                which, _ = books.nearest(part, own)
                np.add.at(total[part], which, own)
                count[part] += np.bincount(which, minlength=k)
        part, entry = np.nonzero(count)
        values = np.column_stack([count[part, entry], total[part, entry]])
        n = values.shape[1]
        columns = [np.repeat(part, n), np.repeat(entry, n), np.tile(np.arange(n) - 1, len(part)), values.ravel()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.int64())], names=["part", "entry", "component", "value"]
        )

    return run


def _start(vectors: DataFrame, column: str, id_column: str, p: CodeParams) -> Codebooks:
    """Codebooks of the kept vectors with the smallest ids (null ids last, equal ids by their vectors)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, length, _ = _integers(batch.column(1), None, p.scale, p.parts)
            yield batch.filter(pa.array(ok & (length > 0)))

    rows = vectors.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("v"))
    first = rows.mapInArrow(kept, rows.schema).orderBy(F.asc_nulls_last("id"), "v").limit(p.entries).collect()
    if not first:
        return Codebooks(np.zeros((p.parts, 0, 0), np.int64), p.scale)
    dims = len(first[0]["v"])
    if dims % p.parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {p.parts} equal parts")
    column_ = pa.array([r["v"] for r in first], pa.list_(pa.float64()))
    x = _integers(column_, dims, p.scale, p.parts)[2]
    return Codebooks(np.ascontiguousarray(x.reshape(len(x), p.parts, dims // p.parts).transpose(1, 0, 2)), p.scale)


def fit(vectors: DataFrame, params: CodeParams | None = None, column: str = "embedding", id_column: str = "vec_id") -> Codebooks:
    """Codebooks of ``vectors``: rounds of nearest entries and componentwise floor(sum / count); entries without parts stay.

    All rows count whose vector is whole: not null, every component finite, as long as that of the smallest id. With fewer
    such rows than entries, codebooks are that small.
    """
    p = params or CodeParams()
    rows = bounded_batches(vectors).select(column)
    books = _start(vectors, column, id_column, p)
    for _ in range(p.rounds if books.entries.size else 0):
        sums = rows.mapInArrow(_sums(books), "part int, entry int, component int, value long")
        found = sums.groupBy("part", "entry", "component").agg(F.sum("value").alias("value")).collect()
        entries = books.entries.copy()
        counts = {(r["part"], r["entry"]): r["value"] for r in found if r["component"] < 0}
        for r in found:
            if r["component"] >= 0:
                entries[r["part"], r["entry"], r["component"]] = r["value"] // counts[r["part"], r["entry"]]
        books = Codebooks(entries, p.scale)
    return books


_HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint8).reshape(256, 2)


def encode(vectors: DataFrame, books: Codebooks, column: str = "embedding") -> DataFrame:
    """Rows of ``vectors`` whose vector is whole, without it, with ``code`` (an entry's index per part, two hex digits each) and
    ``error`` (squared distances, summed). A whole vector of another length than the codebooks' has no code: both are null."""
    others = [c for c in vectors.columns if c not in (column, "code", "error")]
    rows = bounded_batches(vectors).select(*others, column)
    schema = rows.drop(column).withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = books.entries.shape[0]
        for batch in batches:
            kept, fits, x = _integers(batch.column(len(others)), books.dims, books.scale, parts)
            if not books.entries.size:
                fits = np.zeros(len(kept), bool)
            codes, error = np.zeros((len(kept), parts), np.intp), np.zeros(len(kept), np.int64)
            rows = np.flatnonzero(fits)
            for part, own in _parts(x, books) if len(rows) else ():
                codes[rows, part], distance = books.nearest(part, own)
                error[rows] += distance
            text = _HEX[codes].reshape(len(kept), 2 * parts)
            ends = pa.py_buffer(np.arange(len(kept) + 1, dtype=np.int32) * (2 * parts))
            code = pa.StringArray.from_buffers(len(kept), ends, pa.py_buffer(np.ascontiguousarray(text)))
            missing = pa.array(~fits)
            code = pa.compute.if_else(missing, pa.scalar(None, pa.string()), code)
            out = [*batch.columns[: len(others)], code, pa.array(error, mask=~fits)]
            yield pa.RecordBatch.from_arrays(out, names=[*others, "code", "error"]).filter(pa.array(kept))

    return rows.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, column: str = "code") -> DataFrame:
    """``codes`` with ``vector``, the entries that the code names, divided by the scale; null where the code is."""
    schema = codes.withColumn("vector", F.lit(None).cast("array<double>")).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, d = books.entries.shape
        for batch in batches:
            texts = batch.column(names.index(column) if column in names else 0).to_pylist()
            vectors = []
            for text in texts:
                numbers = np.frombuffer(bytes.fromhex(text), np.uint8) if text is not None else None
                vectors.append(None if numbers is None else (books.entries[np.arange(parts), numbers].reshape(parts * d) / books.scale).tolist())
            held = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {"vector": pa.array(vectors, pa.list_(pa.float64()))}
            yield pa.RecordBatch.from_arrays([held[n] for n in names], names=names)

    return codes.mapInArrow(run, schema)


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the error summed over rows of equal label, nulls together (null beyond 64 bits).

    Labels with many rows go to every task as one row each, the others are shuffled (``join_groups``).
    """
    keys = {"_none": F.col(label).isNull(), "_label": F.coalesce(F.col(label), F.lit(0).cast(coded.schema[label].dataType))}
    rows = coded.withColumns(keys)
    groups = rows.groupBy(*keys).agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return join_groups(rows, groups, list(keys), coded.count()).drop("n", *keys)


def compress(vectors: DataFrame, params: CodeParams | None = None) -> DataFrame:
    """``vectors(vec_id, embedding, label, ...)``: ``vec_id, code, error, label_error, codebooks_sha256`` of every whole vector.

    Rows whose vector is null or has null or non-finite components are dropped; repeated rows and ids count as often as
    they occur; an empty table gives an empty result. Other columns are ignored. The codes are written to the shared folder, as both the labels' sums and
    the result read them.
    """
    books = fit(vectors, params)
    coded = table(encode(vectors.select("vec_id", "embedding", "label"), books), "codes")
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
