"""Token ids in files: frequency-ranked ids, byte-aligned variable-length coding with separate control bytes.

A file is a sequence of blocks, each readable alone. A block holds whole documents: their ids and lengths, the block's
distinct token ids from most to least frequent, and every token's rank in one to four bytes. The number of bytes of four
ranks stands in one control byte, apart from the data, so that a table of 256 rows decodes a block with numpy.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, filesystem, give_back, place, table
from .textkernel import PIECE, _inverse, _powers, mix, slices, texts

_HEAD = "<8sIQIQ"
_MARK = b"PMTOKEN1"


@dataclass(frozen=True)
class TokenFileParams:
    """The id that ends a document, ids of a block, and distinct pieces of text whose ids a task remembers."""

    end_id: int = 2
    block_ids: int = 1 << 20
    remembered: int = 1 << 18


# --- coding ---------------------------------------------------------------------------------------------------------

_SHIFT = np.arange(0, 8, 2)
#: Byte lengths of the four values of each control byte.
_LENGTHS = (((np.arange(256)[:, None] >> _SHIFT) & 3) + 1).astype(np.uint8)
#: Values that are coded at once, a multiple of four.
_STRETCH = 1 << 17


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    parts = [_packed(values[i : i + _STRETCH]) for i in range(0, len(values), _STRETCH)]
    return b"".join(c for c, _ in parts), b"".join(d for _, d in parts)


def _packed(values: np.ndarray) -> tuple[bytes, bytes]:
    n = len(values)
    v = values.astype(np.uint32, copy=False)
    size = np.ones(-(-n // 4) * 4, np.uint8)
    for least in (0x100, 0x10000, 0x1000000):
        if v.max() < least:
            break
        size[:n] += v >= np.uint32(least)
    four = size.reshape(-1, 4) - np.uint8(1)
    control = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    ends = np.cumsum(size[:n], dtype=np.int64)
    at = ends - size[:n]
    data = np.empty(int(ends[-1]), np.uint8)
    data[at] = v & np.uint32(255)
    for k in range(1, 4):
        has = np.flatnonzero(size[:n] > k)
        if not len(has):
            break
        data[at[has] + k] = (v[has] >> np.uint32(8 * k)) & np.uint32(255)
    return control.tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values, a stretch at a time: their lengths are looked up, the rest is gathering."""
    out, begin = np.empty(n, np.uint32), 0
    for i in range(0, n, _STRETCH):
        size = _LENGTHS[control[i // 4 : (i + _STRETCH) // 4]].ravel()[: n - i]
        ends = np.cumsum(size, dtype=np.int64) + begin
        at, begin = ends - size, int(ends[-1])
        part = data[at].astype(np.uint32)
        for k in range(1, 4):
            has = np.flatnonzero(size > k)
            if not len(has):
                break
            part[has] |= data[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
        out[i : i + len(part)] = part
    return out


def block_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    count = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    order = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    rank = np.zeros(len(count), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    control, data = pack(rank[ids])
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    head = struct.pack(_HEAD, _MARK, len(doc_ids), len(ids), len(order), len(data))
    return b"".join([head, known.tobytes(), numbers.tobytes(), lengths.astype("<u8").tobytes(), order.astype("<u4").tobytes(), control, data])


def block_content(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a block."""
    mark, docs, n, used, size = struct.unpack_from(_HEAD, raw)
    if mark != _MARK:
        raise ValueError("not a block of token ids")
    at, parts = struct.calcsize(_HEAD), []
    for kind, count in (("u1", docs), ("<i8", docs), ("<u8", docs), ("<u4", used), ("u1", -(-n // 4)), ("u1", size)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += parts[-1].nbytes
    known, numbers, lengths, table_, control, data = parts
    ranks = unpack(control, data, n)
    ids = table_[ranks] if n else ranks
    return [int(x) if k else None for x, k in zip(numbers, known, strict=True)], lengths.astype(np.int64), ids


# --- tokenizing -----------------------------------------------------------------------------------------------------

_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
#: ASCII punctuation but for the apostrophe, which may begin a contraction.
_MARKS = _PLAIN & ~_ALPHA
_MARKS[48:58] = _MARKS[0x27] = False
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15


def _letter_ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters that end before the positions are letters of ASCII or from U+00C0 to U+00FF."""
    last = data[at - 1]
    latin = (last >= 0x80) & (last < 0xC0) & (last != 0x97) & (last != 0xB7) & (at >= 2) & (data[np.maximum(at - 2, 0)] == 0xC3)
    return _ALPHA[last] | latin


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where a byte-level tokenizer always starts a new piece.

    Its pattern gives a lone space to what follows it, a lone newline to nothing, and ends a run of letters at a mark. So
    cuts are before a space or newline whose neighbours are no white space, after that newline, and between a letter and
    a mark that is no apostrophe. Only what surely is so counts: printable ASCII and two-byte characters from U+00C0.
    """
    n = len(data)
    if n < 2:
        return np.empty(0, np.int64)
    marks = np.flatnonzero(_MARKS[data])
    marks = marks[marks > 0]
    marks = marks[_letter_ends(data, marks)]
    at = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
    before = data[at - 1]
    ok = _PLAIN[before] | ((before >= 0x80) & (before < 0xC0) & (at >= 2) & _LEAD[data[np.maximum(at - 2, 0)]])
    after = data[at + 1]
    at = at[ok & (_PLAIN[after] | _LEAD[after])]
    cut = np.zeros(n + 1, bool)
    cut[marks] = cut[at] = cut[at[data[at] == 0x0A] + 1] = True
    return np.flatnonzero(cut)


class _Places:
    """A hash table from 64-bit keys to 0, 1, 2 ... in order of insertion, used a batch at a time."""

    def __init__(self, most: int) -> None:
        size = 1 << int(np.ceil(np.log2(1.5 * most)))
        self.keys, self.values, self.mask, self.n = np.zeros(size, np.uint64), np.full(size, -1, np.int32), np.uint64(size - 1), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for unknown ones."""
        slot = (keys & self.mask).astype(np.int64)
        out = self.values[slot]
        left = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & int(self.mask)
            out[left] = self.values[slot[left]]
            left = left[(out[left] >= 0) & (self.keys[slot[left]] != keys[left])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Distinct new keys."""
        slot, left = (keys & self.mask).astype(np.int64), np.arange(len(keys))
        while len(left):
            free = left[self.values[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], self.n + put
            left = left[self.values[slot[left]] != self.n + left]
            slot[left] = (slot[left] + 1) & int(self.mask)
        self.n += len(keys)


class PieceEncoder:
    """Encodes texts piece by piece, each distinct piece between safe cuts only once.

    At most about ``remembered`` pieces are kept, by a 64-bit hash; then it starts anew, which changes no result. The
    strings of special tokens in a text are those tokens, as the ``tokenizers`` library has it; it must not strip or normalise
    around them. What is a safe cut and how pieces become ids is up to subclasses.
    """

    def __init__(self, path: str, remembered: int) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word or x.normalized for x in added.values()):
            raise ValueError(f"{path} has added tokens that take in what is around them")
        self.added = {x.content.encode(): i for i, x in added.items()}
        strings = sorted(self.added, key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        self.remembered = remembered
        self.up, self.down = _powers(_BASE, PIECE + 1), _powers(_inverse(_BASE), PIECE + 1)
        self.forget()

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        """Where the tokenizer always starts a new piece, whatever is around."""
        raise NotImplementedError

    def encoded(self, raw: bytes, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the distinct pieces, their ids in that order, and each one's number of ids."""
        raise NotImplementedError

    def whole(self, part: bytes) -> np.ndarray:
        """Ids of a long part of a text without a cut."""
        raise NotImplementedError

    def forget(self) -> None:
        self.places = _Places(self.remembered + PIECE)
        self.begin, self.size, self.flat, self.used = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(4096, np.int32), 0

    def _learn(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = self.places.n
        while first + len(keys) > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.begin[first : first + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + len(keys)] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.places.add(keys)

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin or end, as a mask of n + 1 places: at boundaries and offsets, and around special tokens, never in them."""
        cut = np.zeros(len(data) + 1, bool)
        cut[self.boundaries(data)] = cut[offsets] = True
        raw = data.tobytes() if self.special else b""
        if self.special and self.special.search(raw):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for begin, end in (m.span() for m in self.special.finditer(raw[a:b])):
                    cut[a + begin + 1 : a + end] = False
                    cut[a + begin] = cut[a + end] = True
        return cut

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts, one after the other, and the number of each text's ids."""
        if self.places.n > self.remembered:
            self.forget()
        n = len(data)
        if not n:
            return np.empty(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        if n > PIECE:
            return self._long(data)
        begin = np.flatnonzero(self._cut(data, offsets)[:-1])
        end = np.append(begin[1:], n)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUE[data] * self.up[:n], out=sums[1:])
            key = mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))
        number = self.places.find(key)
        new = np.flatnonzero(number < 0)
        if len(new):
            keys, first = np.unique(key[new], return_index=True)
            which = new[first]
            order, found, sizes = self.encoded(data.tobytes(), data, begin[which], end[which])
            self._learn(keys[order], found, sizes)
            number[new] = self.places.find(key[new])
        size = self.size[number].astype(np.int64)
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.begin[number] - (ends - size), size) + np.arange(int(ends[-1]))]
        total = np.concatenate([[0], ends])
        return ids, np.diff(total[np.searchsorted(begin, offsets, "left")])

    def _long(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A text of more than PIECE bytes, in parts that end at cuts; a part without a cut goes to the tokenizer whole."""
        parts, at, n = [], 0, len(data)
        cuts = np.flatnonzero(self._cut(data, np.array([0, n])))
        while at < n:
            k = int(np.searchsorted(cuts, at + PIECE, "right")) - 1
            to = int(cuts[k]) if k >= 0 and cuts[k] > at else int(cuts[k + 1])
            part = data[at:to]
            if len(part) > PIECE:
                parts.append(self.whole(part.tobytes()))
            else:
                parts.append(self.encode(part, np.array([0, len(part)]))[0])
            at = to
        ids = np.concatenate(parts)
        return ids, np.array([len(ids)])


class Encoder(PieceEncoder):
    """Ids of a byte-level tokenizer of the ``tokenizers`` library, without added prefix space."""

    def __init__(self, path: str, remembered: int) -> None:
        super().__init__(path, remembered)
        vocab = self.tokenizer.get_vocab()
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        self.length[list(vocab.values())] = [len(x) for x in vocab]

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        return _cuts(data)

    def whole(self, part: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids, np.int32)

    def encoded(self, raw: bytes, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words with a space before them are encoded many at a time: joined they are cut where they were, and the bytes of
        the ids tell which ids are whose."""
        inner = np.zeros(len(data) + 1, np.int64)
        alpha = _ALPHA[data]
        alpha[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        alpha[:-1] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        np.cumsum(alpha, out=inner[1:])
        word = (data[begin] == 0x20) & (end - begin > 1) & (inner[end] - inner[begin] == end - begin - 1)
        joined, single = np.flatnonzero(word), np.flatnonzero(~word)
        groups = [joined[i : i + 128] for i in range(0, len(joined), 128)]
        order = np.concatenate([joined, single])
        pieces = [raw[b:e] for b, e in zip(begin[order].tolist(), end[order].tolist(), strict=True)]
        strings = [b"".join(pieces[i : min(i + 128, len(joined))]).decode() for i in range(0, len(joined), 128)]
        strings += [x.decode() for x in pieces[len(joined) :]]
        found = [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        sizes = [np.diff(np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(end[g] - begin[g]), "left") + 1, prepend=0) for g, ids in zip(groups, found, strict=False)]
        sizes.append(np.array([len(x) for x in found[len(groups) :]], np.int64))
        return order, np.concatenate(found), np.concatenate(sizes)


# --- files ----------------------------------------------------------------------------------------------------------


def _writer(folder: str, tokenizer: str, p: TokenFileParams):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, p.remembered)  # goes with the task
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        shard = TaskContext.get().partitionId()
        # a name of this attempt's own: only the blocks of attempts that came through are listed, and nothing is renamed
        name = f"part-{shard:05d}-{uuid.uuid4().hex}.tokens"
        made, at = [], 0
        doc_ids: list = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:

            def flush() -> None:
                nonlocal at, held
                raw = block_bytes(doc_ids, np.concatenate(lengths), np.concatenate(parts))
                out.write(raw)
                made.append((at, len(raw), len(doc_ids), held))
                at += len(raw)
                held = 0
                for x in (doc_ids, lengths, parts):
                    x.clear()

            for batch in batches:
                data, offsets = texts(batch.column("text"))
                numbers = batch.column("doc_id").to_pylist()
                for a, b in slices(offsets):
                    ids, n = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    ended = np.full(len(ids) + len(n), p.end_id, np.uint32)
                    own = np.ones(len(ended), bool)
                    own[np.cumsum(n + 1) - 1] = False
                    ended[own] = ids
                    doc_ids += numbers[a:b]
                    lengths.append(n + 1)
                    parts.append(ended)
                    held += len(ended)
                    if held >= p.block_ids:
                        flush()
            if doc_ids:
                flush()
        del encoder
        give_back()
        columns = list(zip(*made, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"] * len(made)), pa.array([shard] * len(made), pa.int32()), *(pa.array(x, pa.int64()) for x in columns)],
            names=["path", "shard", "offset", "bytes", "docs", "ids"],
        )

    return write


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, params: TokenFileParams | None = None) -> DataFrame:
    """Encode ``docs(doc_id long, text string, ...)`` to files in ``folder``; a row per block of ``path, shard, offset, bytes, docs, ids``.

    Documents are range-partitioned and sorted by doc_id (null first, then text), so shards in order hold them in order. A
    null text is empty; each document ends with ``end_id``. Repeated rows are written as often as they occur. ``tokenizer``
    is the path of a file of the ``tokenizers`` library, byte-level, without added prefix space. Only the blocks that are
    returned count: a task that failed or ran twice may leave other files in the folder.
    """
    p = params or TokenFileParams()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return table(rows.mapInArrow(_writer(folder, tokenizer, p), "path string, shard int, offset long, bytes long, docs long, ids long"), "blocks")


def _reader(with_ids: bool):
    """The documents of every block: where each begins, its length and checksum and, if asked for, its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                fs, path = filesystem(block["path"])
                with fs.open_input_file(path) as file:
                    file.seek(block["offset"])
                    doc_ids, lengths, ids = block_content(file.read(block["bytes"]))
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths, strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(block["start"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    at = np.concatenate([[0], 4 * ends]).astype(np.int64)
                    columns.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(raw)]).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
        give_back()

    return read


def read_tokens(blocks: DataFrame, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` (little-endian 32-bit) of the documents in ``blocks``.

    start counts the ids of all documents before. Blocks are read in parallel; their starts are prefix sums over shards,
    then over the blocks of a shard.
    """
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard")) - F.col("total")
    shards = shards.select("shard", before.alias("before"))
    within = F.sum("ids").over(Window.partitionBy("shard").orderBy("offset")) - F.col("ids")
    placed = blocks.withColumn("within", within).join(shards, "shard").withColumn("start", F.col("before") + F.col("within"))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.select("path", "offset", "bytes", "start").repartition(n, "path", "offset")
    if ids:
        return placed.mapInArrow(_reader(True), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return placed.mapInArrow(_reader(False), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, params: TokenFileParams | None = None, ids: bool = False) -> DataFrame:
    """Write ``docs`` to fresh files in the shared folder and read them back."""
    return read_tokens(write_tokens(docs, tokenizer, place(docs.sparkSession, "tokens"), params), ids)
