"""Benchmark decontamination: Wu-Manber search over words for windows of benchmark items.

Texts and windows are sequences of words. For each length of window a table gives, for every block of two words, how far
the search may move on: blocks that no window has skip almost a whole window. Where the shift is zero, the block is the
suffix of some window; a hash bucket of suffix and prefix selects those windows, and their words are compared directly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, discard, give_back, table
from .textkernel import LOWER, WordHasher, mix, slices, texts

_BLOCK = 2
#: Positions of one lane of the search; lanes advance together.
_LANE = 512


@dataclass(frozen=True)
class DecontaminationParams:
    """Words of a window; bytes of windows and their tables that a task gets at once (more is searched in several passes)."""

    words: int = 10
    window_bytes: int = 32 << 20


#: What a word of an item takes in the tables, beside its own bytes.
_WORD_BYTES = 72


def _bucket(hashes: np.ndarray, suffix: np.ndarray, first: np.ndarray, block: int) -> np.ndarray:
    """Hashes of the windows' suffixes and of the blocks that they begin with."""
    with np.errstate(over="ignore"):
        return mix(suffix * np.uint64(5) + _block_hash(hashes, first + block - 1, block))


def _block_hash(hashes: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = hashes[end]
        for i in range(1, size):
            out = mix(out * np.uint64(3) + hashes[end - i])
    return out


@dataclass(frozen=True)
class _Items:
    """The words of all items of a pass, one after the other: their hashes, and their bytes with a space after each."""

    hashes: np.ndarray
    text: bytes
    at: np.ndarray
    ids: np.ndarray  # item of each word

    @staticmethod
    def of(items: list[tuple[int, str]]) -> tuple[_Items, np.ndarray]:
        """The words, and each item's first word and the end of its last."""
        hasher, hashes, words, ids, ends = WordHasher(), [np.empty(0, np.uint64)], [], [], [0]
        for item, text in items:
            data, offsets = texts(pa.array([text], pa.large_string()))
            h, begin, end, _ = hasher.words(data, offsets)
            low = LOWER[data].tobytes()
            hashes.append(h)
            words += [low[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
            ids += [item] * len(h)
            ends.append(ends[-1] + len(h))
        at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
        return _Items(np.concatenate(hashes), b"".join(w + b" " for w in words), at, np.array(ids, np.int64)), np.array(ends)

    def window(self, start: int, length: int) -> bytes:
        return self.text[self.at[start] : self.at[start + length] - 1]


@dataclass
class _Windows:
    """The different windows of one length in order of their bucket, with their shift table."""

    items: _Items
    length: int
    starts: np.ndarray
    bucket: np.ndarray
    owners: np.ndarray  # items of the windows, one window after the other
    owned: np.ndarray  # where each window's items begin
    shift: np.ndarray

    @staticmethod
    def of(items: _Items, m: int, starts: np.ndarray) -> _Windows:
        block = min(_BLOCK, m)
        key = np.full(len(starts), m, np.uint64)
        with np.errstate(over="ignore"):
            for q in range(m):
                key = mix(key * np.uint64(3) + items.hashes[starts + q])
        bucket = _bucket(items.hashes, _block_hash(items.hashes, starts + m - 1, block), starts, block)
        order = np.lexsort((starts, key, bucket))
        starts, key, bucket = starts[order], key[order], bucket[order]
        new = np.ones(len(starts), bool)
        new[1:] = key[1:] != key[:-1]
        leader = 0
        for i in np.flatnonzero(~new):  # equal hashes: the same window if its words are
            leader = i - 1 if new[i - 1] else leader
            new[i] = items.window(starts[i], m) != items.window(starts[leader], m)
        first = np.flatnonzero(new)
        width = min(m - block + 1, 255)
        size = 1 << max(12, int(np.ceil(np.log2(8 * (len(first) + m)))))
        shift = np.full(size, width, np.uint8)
        for q in range(block - 1, m):
            np.minimum.at(shift, _block_hash(items.hashes, starts[first] + q, block) & np.uint64(size - 1), np.uint8(min(m - 1 - q, 255)))
        return _Windows(items, m, starts[first], bucket[first], items.ids[starts], np.append(first, len(starts)), shift)

    def search(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, window) of every occurrence in texts whose words are at offsets ``at``; hashes equal, bytes unseen."""
        m, block, mask = self.length, min(_BLOCK, self.length), np.uint64(len(self.shift) - 1)
        first, last = at[:-1] + m - 1, at[1:] - 1
        lanes = np.maximum(0, -(-(last - first + 1) // _LANE))
        which = np.repeat(np.arange(len(lanes)), lanes)
        pos = first[which] + (np.arange(len(which)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * _LANE
        stop = np.minimum(pos + _LANE - 1, last[which])
        found = []
        while len(pos):
            hashed = _block_hash(hashes, pos, block)
            shift = self.shift[hashed & mask]
            zero = shift == 0
            if zero.any():
                found.append((pos[zero], hashed[zero]))
            pos = pos + np.maximum(shift, 1)
            alive = pos <= stop
            pos, stop = pos[alive], stop[alive]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        end, hashed = (np.concatenate(x) for x in zip(*found, strict=True))
        hashed = _bucket(hashes, hashed, end - m + 1, block)
        lo, hi = np.searchsorted(self.bucket, hashed, "left"), np.searchsorted(self.bucket, hashed, "right")
        many = hi - lo
        end = np.repeat(end, many)
        window = np.repeat(lo, many) + np.arange(len(end)) - np.repeat(np.cumsum(many) - many, many)
        same = np.ones(len(end), bool)
        for q in range(m):
            same &= hashes[end - q] == self.items.hashes[self.starts[window] + m - 1 - q]
        return end[same], window[same]

    def occurrences(self, part: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first word, items) of every occurrence, its words compared."""
        for e, w in zip(*self.search(hashes, at), strict=True):
            s = e - self.length + 1
            if b" ".join(LOWER[part[begin[i] : end[i]]].tobytes() for i in range(s, e + 1)) == self.items.window(self.starts[w], self.length):
                yield s, self.owners[self.owned[w] : self.owned[w + 1]]


def _windows(items: list[tuple[int, str]], n: int) -> list[_Windows]:
    words, ends = _Items.of(items)
    starts: dict[int, list[np.ndarray]] = {}
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        m = min(n, int(b - a))
        if m:
            starts.setdefault(m, []).append(np.arange(a, b - m + 1))
    return [_Windows.of(words, m, np.concatenate(x)) for m, x in sorted(starts.items())]


def _searcher(groups: list[_Windows]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            n_words, begins, ends, items = [], [], [], []
            for a, b in slices(offsets):
                part = data[offsets[a] : offsets[b]]
                hashes, begin, end, at = hasher.words(part, offsets[a : b + 1] - offsets[a])
                edge, seen = np.zeros(len(hashes) + 1, np.int32), [set() for _ in range(b - a)]
                for g in groups:
                    for s, owners in g.occurrences(part, hashes, begin, end, at):
                        edge[s] += 1
                        edge[s + g.length] -= 1
                        seen[int(np.searchsorted(at, s, "right")) - 1].update(owners.tolist())
                hit = np.cumsum(edge[:-1]) > 0
                for i in range(b - a):
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit[at[i] : at[i + 1]].view(np.int8), [0]])))
                    begins.append(turn[::2])
                    ends.append(turn[1::2])
                    items.append(sorted(seen[i]))
                n_words += np.diff(at).tolist()
            rest = [pa.array(n_words, pa.int64())] + [pa.array(x, pa.list_(pa.int64())) for x in (begins, ends, items)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *rest], names=["row", "doc_id", "n_words", "begins", "ends", "items"])

    return search


def _leaks(groups: list[_Windows]):
    """Whether a text has a window, as a function of a text column; the row's other columns stay in the JVM."""

    def leaks(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = WordHasher()
        for column in columns:
            data, offsets = texts(column)
            found = np.zeros(len(column), bool)
            for a, b in slices(offsets):
                part = data[offsets[a] : offsets[b]]
                hashes, begin, end, at = hasher.words(part, offsets[a : b + 1] - offsets[a])
                for g in groups:
                    for s, _ in g.occurrences(part, hashes, begin, end, at):
                        found[a + int(np.searchsorted(at, s, "right")) - 1] = True
            yield pa.array(found)
        give_back()

    return F.arrow_udf(leaks, "boolean", F.ArrowUDFType.SCALAR_ITER)


_FOUND = "row long, doc_id long, n_words long, begins array<long>, ends array<long>, items array<long>"


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of several passes over a text as one set of spans."""
    for batch in batches:
        begins, ends = [], []
        for b, e in zip(batch.column("begins").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            spans: list[list[int]] = []
            for s, t in sorted(zip(b, e, strict=True)):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], t)
                else:
                    spans.append([s, t])
            begins.append([x[0] for x in spans])
            ends.append([x[1] for x in spans])
        kept = [batch.column(x) for x in ("row", "doc_id", "n_words")]
        both = [pa.array(x, pa.list_(pa.int64())) for x in (begins, ends)]
        yield pa.RecordBatch.from_arrays([*kept, *both, batch.column("items")], names=[x.split()[0] for x in _FOUND.split(", ")])


def _parts(benchmark: DataFrame, p: DecontaminationParams) -> list[DataFrame]:
    """The items in parts whose windows take ``window_bytes`` each, by an estimate from all their words."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null")
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = items.agg(F.sum(F.octet_length("text") + _WORD_BYTES * words)).first()[0] or 0
    n = -(-total // p.window_bytes) or 1
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]


def _collected(part: DataFrame) -> list[tuple[int, str]]:
    return [tuple(x) for x in part.orderBy("item_id", "text").collect()]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams | None = None) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans, contaminated`` for every row of ``docs(doc_id long, text string, ...)``.

    Words are runs of digits, letters and all that isn't ASCII, A-Z lowered. A window is ``words`` consecutive words of an
    item of ``benchmark(item_id long, text string, ...)``; an item of fewer words, but some, is one window. A word inside
    any occurrence of a window is hit. ``items`` has the sorted ids of items with an occurring window, ``spans`` the
    hit stretches as (begin, end) of words. Null, empty and wordless texts have no words; such items no windows. Rows with
    one item_id are one item; rows without item_id are left out. Repeated documents are repeated in the result.

    The size of the windows is measured. Up to ``window_bytes`` they go to every task; beyond, the items are split into parts
    of about that size (an item isn't cut) and searched in passes: a pass's windows are gone before the next one's are made,
    its hits are stored, and the hits are united per document.
    """
    p = params or DecontaminationParams()
    parts = _parts(benchmark, p)
    rows = bounded_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    search = lambda part, of: of.mapInArrow(_searcher(_windows(_collected(part), p.words)), _FOUND)
    if len(parts) == 1:
        out = search(parts[0], rows)
    else:
        rows = table(rows, "documents")
        out = _union([table(search(part, rows), "hits") for part in parts])
        discard(rows)
        out = out.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(x)).alias(x) for x in ("begins", "ends", "items")),
        ).mapInArrow(_united, _FOUND)
    spans = F.zip_with("begins", "ends", lambda b, e: F.struct(b.alias("begin"), e.alias("end")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.select("doc_id", "n_words", F.array_sort(F.array_distinct("items")).alias("items"), spans.alias("spans")).select(
        "doc_id", "n_words", hit.alias("n_hit"), "items", "spans", (F.size("spans") > 0).alias("contaminated")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams | None = None) -> DataFrame:
    """The rows of ``docs`` whose texts have no window of the benchmark, with all their columns.

    Every row is judged by its own text, in the task that reads it, so rows without a doc_id or with a repeated one are
    judged like others and nothing is shuffled. Where the windows need several passes, rows are numbered and stored, each
    pass stores the numbers of the rows that it finds, and those rows go in one join.
    """
    p = params or DecontaminationParams()
    docs = bounded_batches(docs)
    parts = _parts(benchmark, p)
    leaking = lambda part: _leaks(_windows(_collected(part), p.words))("text")
    if len(parts) == 1:
        return docs.filter(~leaking(parts[0]))
    row = _free("_row", docs.columns)
    rows = table(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = _union([table(rows.filter(leaking(part)).select(row), "hits") for part in parts])
    return rows.join(found.distinct(), row, "left_anti").select(docs.columns)


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _free(name: str, taken: list[str]) -> str:
    """The name, or a longer one that no column has."""
    while name in taken:
        name += "_"
    return name
