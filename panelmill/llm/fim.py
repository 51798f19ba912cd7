"""Fill-in-middle: documents cut into prefix, middle and suffix and written in another order, by a secondary sort.

Tasks cut texts into units and emit chunks of units, keyed by document and position in the output. One
``repartitionAndSortWithinPartitions`` brings a document's pieces together in the order of its output, which streams into a
digest; the same stream, cut again at its sentinels, is sorted anew by position in the text and streams into the digest of the
restored text. The second sort has the first one's partitioner, so nothing is shuffled twice, and no task joins a
document's pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import partitions


@dataclass(frozen=True)
class FimParams:
    """Rows per hundred that are transformed at most, of these the share with the suffix first, the salt of the draws, units of a
    piece, and bytes of text that a sorting task should get."""

    rate: int = 90
    spm_rate: int = 20
    salt: str = "1:"
    chunk_units: int = 1 << 16
    partition_bytes: int = 32 << 20


#: Sentinels that begin the prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Sections of the output by form, in order.
ORDER = {"plain": (b"",), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Where a section stands in the text.
_RANK = {b"": 0, PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Where units begin in UTF-8 bytes: runs of A-Z and a-z, and every other code point."""
    letter = _LETTER[data]
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def draws(doc_id: int | None, salt: str) -> tuple[int, ...]:
    """Four unsigned 32-bit integers that depend on the document's id alone (a null id draws like an empty one)."""
    raw = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(raw[i : i + 4], "big") for i in (0, 4, 8, 12))


def plan(text: bytes, doc_id: int | None, p: FimParams) -> tuple[str, np.ndarray, int, int]:
    """Form, the units' beginnings, and the units that prefix and middle end after."""
    starts = unit_starts(np.frombuffer(text, np.uint8))
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id, p.salt)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= p.rate:
        return "plain", starts, a, b
    return ("spm" if h4 % 100 < p.spm_rate else "psm"), starts, a, b


def pieces(text: bytes, form: str, starts: np.ndarray, a: int, b: int, units: int) -> Iterator[bytes]:
    """The output of the form, a sentinel or at most ``units`` units of a section at a time."""
    n = len(starts)
    ends = np.append(starts, len(text))
    for mark in ORDER[form]:
        lo, hi = {b"": (0, n), PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}[mark]
        if mark:
            yield mark
        for at in range(lo, hi, units):
            yield text[ends[at] : ends[min(hi, at + units)]]


def sections(form: str, output: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """Cut an output, read in order, at the form's sentinels: what is between, with where its section stands in the text.

    Texts with sentinels stay plain, and one can't begin in a text and end in another sentinel, so the form's sentinels are
    the first ones found. The last bytes of a piece are held back, as a sentinel may go over its end.
    """
    marks = list(ORDER[form])
    if marks == [b""]:
        yield from ((0, x) for x in output)
        return
    rank, held = None, b""
    for piece in output:
        held += piece
        while marks and (at := held.find(marks[0])) >= 0:
            if rank is not None and at:
                yield rank, held[:at]
            rank, held = _RANK[marks[0]], held[at + len(marks[0]) :]
            marks.pop(0)
        keep = len(PREFIX) - 1 if marks else 0
        if rank is not None and len(held) > keep:
            yield rank, held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield rank, held


_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType()),
    ]
)


def _points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _cut(p: FimParams):
    """Rows to ``((document, position in the output), piece)``; position -1 has what is known of the document.

    A document is named by what it holds (id and digest of the text), then by its row. So which partition it goes to depends
    on nothing else, and rows that are repeated whole stay apart.
    """

    def run(split: int, rows: Iterable) -> Iterator[tuple]:
        for number, (doc_id, text) in enumerate(rows):
            raw = (text or "").encode()
            form, starts, a, b = plan(raw, doc_id, p)
            key = (hashlib.sha256(repr(doc_id).encode() + b" " + raw).digest()[:16], split, number)
            ends = np.append(starts, len(raw))
            chars = (None, None) if form == "plain" else (_points(raw[: ends[a]]), _points(raw[ends[a] : ends[b]]))
            yield (key, -1), (doc_id, len(starts), form, *chars)
            for at, piece in enumerate(pieces(raw, form, starts, a, b, p.chunk_units)):
                yield (key, at), piece

    return run


def _place(key: tuple) -> int:
    return int.from_bytes(key[0][0][:8], "big")


def _outputs(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Pieces in the order of the outputs, to ``((document, section, number), piece)``, with the output's digest before them."""
    for key, found in groupby(rows, key=lambda row: row[0][0]):
        head = next(found)[1]
        digest = hashlib.sha256()

        def output(found=found, digest=digest) -> Iterator[bytes]:
            for _, piece in found:
                digest.update(piece)
                yield piece

        for number, (rank, piece) in enumerate(sections(head[2], output())):
            yield (key, rank, number), piece
        yield (key, -1, 0), (*head, digest.hexdigest())


def _restored(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Pieces in the order of the texts, to a row per document."""
    for _, found in groupby(rows, key=lambda row: row[0][0]):
        head = next(found)[1]
        digest = hashlib.sha256()
        for _, piece in found:
            digest.update(piece)
        yield (*head, digest.hexdigest())


def transform(docs: DataFrame, params: FimParams | None = None) -> DataFrame:
    """``docs(doc_id long, text string, ...)`` to ``doc_id, text``: the text in its form, for training.

    Rows are handled where they are read. A null text is empty; other columns are ignored.
    """
    p = params or FimParams()

    def run(rows: Iterable) -> Iterator[tuple]:
        for doc_id, text in rows:
            raw = (text or "").encode()
            form, starts, a, b = plan(raw, doc_id, p)
            yield doc_id, form, b"".join(pieces(raw, form, starts, a, b, p.chunk_units)).decode()

    rows = docs.select(F.col("doc_id").cast("long"), "text").rdd.mapPartitions(run)
    return docs.sparkSession.createDataFrame(rows, "doc_id long, form string, text string")


def restore(form: str, output: str) -> str:
    """The text that an output of the form was made of."""
    found = sorted(enumerate(sections(form, [output.encode()])), key=lambda x: (x[1][0], x[0]))
    return b"".join(piece for _, (_, piece) in found).decode()


def round_trip(docs: DataFrame, params: FimParams | None = None) -> DataFrame:
    """``docs(doc_id long, text string, ...)``: each document's units, form, lengths and the digests of its output and of the text restored from it.

    Null texts are empty and, like all empty texts, plain; rows are not merged, whether ids or whole rows repeat; a null id draws
    like an empty one. A very long text is many pieces; a sorting task holds its partition's pieces or spills them. All
    lengths are added up first, so that there are enough partitions, at least ``spark.sql.shuffle.partitions``.
    """
    p = params or FimParams()
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-total // p.partition_bytes))
    cut = docs.select(F.col("doc_id").cast("long"), "text").rdd.mapPartitionsWithIndex(_cut(p))
    outputs = cut.repartitionAndSortWithinPartitions(n, _place).mapPartitions(_outputs, preservesPartitioning=True)
    restored = outputs.repartitionAndSortWithinPartitions(n, _place).mapPartitions(_restored)
    return spark.createDataFrame(restored, _SCHEMA)
