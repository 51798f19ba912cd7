"""Byte-pair encoding by speculation: propose tokens by greedy longest match, verify every adjacent pair, merge only what fails.

A sequence of tokens is what merging in order of rank gives if and only if this holds for each two neighbours alone. So a
word's greedy proposal is checked pair by pair, all words' pairs at once, by undoing the latest merge on either side of the
border and asking whether an earlier merge across it would have come first. Only words with a pair that fails are merged
symbol by symbol. The vocabulary's own normalisation and splitting into words are the ``tokenizers`` library's.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, give_back
from .textkernel import _inverse, _powers, mix, slices, texts
from .token_files import PieceEncoder

_BASE = 0x9E3779B97F4A7C15
#: A byte that ends a word is a symbol of its own.
END = 256
_VALUE = mix(np.arange(1, 2 * END + 1, dtype=np.uint64))
_NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class BpeParams:
    """Distinct pieces of text whose ids a task remembers, and symbols that are handled at once."""

    remembered: int = 1 << 18
    symbols: int = 1 << 16


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable Latin-1 as itself, the others in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """The vocabulary as merges: a token is a symbol (a byte, or a byte that ends a word) or two tokens, and has the merge's rank."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        letters = byte_letters()
        size = max(vocab.values()) + 1
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.symbol = np.full(2 * END, -1, np.int64)
        content: list[bytes | None] = [None] * size  # symbols as pairs of bytes
        for letter, byte in letters.items():
            for text, symbol in ((letter, byte), (letter + suffix, byte + END)):
                if text in vocab:
                    self.symbol[symbol] = vocab[text]
                    content[vocab[text]] = symbol.to_bytes(2, "little")
        if (self.symbol < 0).any():
            raise ValueError("the vocabulary lacks bytes")
        pairs = {}
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if content[z] is not None or max(self.rank[x], self.rank[y]) >= rank:
                raise ValueError(f"merge {rank} makes a token that has a merge, or comes before its parts")
            pairs[x * size + y] = rank
            self.rank[z], self.left[z], self.right[z], content[z] = rank, x, y, content[x] + content[y]
        self.pairs = pairs
        self.size = size
        keys = np.array(list(pairs), np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(pairs.values()), np.int64)[order]
        self.made = np.zeros(len(merges), np.int64)
        made = np.flatnonzero(self.rank >= 0)
        self.made[self.rank[made]] = made
        self._index(content)

    def _index(self, content: list[bytes | None]) -> None:
        """Hashes of tokens and of what begins tokens. Tokens that merging their own symbols doesn't give are never proposed."""
        tokens = [t for t, c in enumerate(content) if c is not None and self._is_own(t)]
        flat = np.frombuffer(b"".join(content[t] for t in tokens), "<u2").astype(np.int64)
        lengths = np.array([len(content[t]) // 2 for t in tokens])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.longest = int(lengths.max())
        self.up, self.down = _powers(_BASE, len(flat) + 1), _powers(_inverse(_BASE), len(flat) + 1)
        sums = self._sums(flat)
        key = [self._keys(sums, offsets[:-1], lengths)]
        number = [np.array(tokens)]
        for length in range(1, self.longest):
            longer = offsets[:-1][lengths > length]
            key.append(self._keys(sums, longer, np.full(len(longer), length)))
            number.append(np.full(len(longer), -1))
        keys, numbers = np.concatenate(key), np.concatenate(number)
        order = np.lexsort((-numbers, keys))
        keys, numbers = keys[order], numbers[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.keys, self.numbers = keys[first], numbers[first]
        known = np.array([len(c) // 2 if c is not None else 0 for c in content])
        self.lengths, self.begins = known, np.concatenate([[0], np.cumsum(known)])[:-1]
        self.flat = np.frombuffer(b"".join(c for c in content if c is not None), "<u2").astype(np.int64)

    def _is_own(self, token: int) -> bool:
        """Whether the token's halves, each its own encoding, stay apart from an earlier merge, so that they meet in this token."""
        if self.rank[token] < 0:
            return True
        return self._joins(int(self.left[token]), int(self.right[token]), int(self.rank[token]))

    def _joins(self, a: int, b: int, rank: int) -> bool:
        """Whether no merge across the border comes before the tokens' own merge."""
        limit = _NEVER
        while True:
            found = self.pairs.get(a * self.size + b)
            if found is not None and found < limit and found != rank:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], int(self.right[a])
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, int(self.left[b])
            else:
                return True

    def _sums(self, flat: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = np.zeros(len(flat) + 1, np.uint64)
            np.cumsum(_VALUE[flat] * self.up[: len(flat)], out=out[1:])
        return out

    def _keys(self, sums: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((sums[begin + length] - sums[begin]) * self.down[begin] + length.astype(np.uint64))

    def longest_match(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that begins at each symbol and ends by ``ends``, and its length. One symbol always is a token."""
        if len(flat) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(flat)), _powers(_inverse(_BASE), 2 * len(flat))
        sums = self._sums(flat)
        token, length = self.symbol[flat], np.ones(len(flat), np.int64)
        at = np.arange(len(flat))
        for n in range(2, self.longest + 1):
            at = at[ends[at] - at >= n]
            if not len(at):
                break
            key = self._keys(sums, at, np.full(len(at), n))
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[slot] == key
            at, number = at[found], self.numbers[slot[found]]
            whole = number >= 0
            token[at[whole]], length[at[whole]] = number[whole], n
        return token, length

    def stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens: whether merging the symbols of both together leaves them as they are.

        Merges are undone from the latest back, on the right first where both sides have the same one, as the left one is
        made first. A pair that meets at the border and would have merged earlier than the last merge undone breaks it.
        """
        a, b = a.copy(), b.copy()
        out = np.ones(len(a), bool)
        limit = np.full(len(a), _NEVER)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            slot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            broken = (self.pair_keys[slot] == key) & (self.pair_ranks[slot] < limit[live])
            out[live[broken]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_left, undo_right = rx > ry, (ry >= rx) & (ry >= 0)
            limit[live] = np.where(undo_left, rx, ry + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_right, self.left[y], y)
            live = live[~broken & (undo_left | undo_right)]
        return out

    def merged(self, symbols: list[int]) -> list[int]:
        """Tokens of one word by merging, the pair of lowest rank first, the leftmost of equal ones."""
        token = [int(self.symbol[s]) for s in symbols]
        n = len(token)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := self.pairs.get(token[i] * self.size + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if token[i] != x or j < 0 or token[j] != y:
                continue
            token[i], token[j] = int(self.made[rank]), -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := self.pairs.get(token[i] * self.size + token[k])) is not None:
                    heapq.heappush(heap, (r, i, token[i], token[k]))
            h = before[i]
            if h >= 0 and (r := self.pairs.get(token[h] * self.size + token[i])) is not None:
                heapq.heappush(heap, (r, h, token[h], token[i]))
        return [t for t in token if t >= 0]

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of words, given as symbols one after the other, each word's number of tokens, and how many words were merged."""
        n = np.diff(offsets)
        ends = np.repeat(offsets[1:], n)
        token, length = self.longest_match(flat, ends)
        chosen = np.zeros(len(flat), bool)
        front, stop = offsets[:-1][n > 0], offsets[1:][n > 0]
        while len(front) > 32:
            chosen[front] = True
            front = front + length[front]
            front, stop = front[front < stop], stop[front < stop]
        for at, end in zip(front.tolist(), stop.tolist(), strict=True):
            while at < end:
                chosen[at] = True
                at += int(length[at])
        at = np.flatnonzero(chosen)
        word = np.searchsorted(offsets, at, "right") - 1
        ids = token[at]
        # what a hash found must be there
        where = np.repeat(self.begins[ids] - at, self.lengths[ids]) + np.arange(len(flat))
        failed = np.zeros(len(n), bool)
        failed[word[np.searchsorted(at, np.flatnonzero(self.flat[where] != flat), "right") - 1]] = True
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        failed[word[inner[~self.stays(pairs // self.size, pairs % self.size)[back]]]] = True
        sizes = np.bincount(word, minlength=len(n))
        redo = np.flatnonzero(failed)
        if not len(redo):
            return ids, sizes, 0
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for w in redo.tolist():
            parts[w] = np.array(self.merged(flat[offsets[w] : offsets[w + 1]].tolist()), np.int64)
            sizes[w] = len(parts[w])
        return np.concatenate(parts), sizes, len(redo)


_CLASS = np.full(256, 4, np.uint8)  # part of a character that isn't ASCII
_CLASS[:0x80] = 3  # marks and controls
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 1
_CLASS[65:91] = _CLASS[97:123] = 2
_CLASS[0x27] = 5
#: Borders that are always one: around white space, around digits, between letters and marks but for what follows an apostrophe.
_BORDER = np.zeros((6, 6), bool)
_BORDER[0, 1:] = _BORDER[1:, 0] = True
_BORDER[1, [1, 2, 3, 5]] = _BORDER[[1, 2, 3, 5], 1] = True
_BORDER[2, [3, 5]] = _BORDER[3, 2] = True


class WordEncoder(PieceEncoder):
    """Ids of a byte-level vocabulary with word ends, as the ``tokenizers`` library gives them.

    Normalisation must work on words alone (composition, white space, lower case) and words be runs of letters, single
    digits, contractions or runs of marks, as in the vocabularies of this kind.
    """

    def __init__(self, path: str, p: BpeParams) -> None:
        super().__init__(path, p.remembered)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError(f"{path} isn't a plain byte-pair encoding")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(model["vocab"], merges, self.suffix)
        self.bytes_of = str.maketrans({c: chr(b) for c, b in byte_letters().items()})
        self.symbols = p.symbols
        self.failed = self.words = 0

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        kind = _CLASS[data]
        return np.flatnonzero(_BORDER[kind[:-1], kind[1:]]) + 1

    def _words(self, piece: bytes) -> list[bytes]:
        if piece.isspace():
            return []
        if piece.isalpha():  # ASCII letters alone
            return [piece.lower()]
        text = self.tokenizer.normalizer.normalize_str(piece.decode())
        return [w.translate(self.bytes_of).encode("latin-1") for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encoded(self, raw: bytes, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
        special = [self.added.get(x) for x in pieces]
        words = [self._words(x) if s is None else [] for x, s in zip(pieces, special, strict=True)]
        ids, sizes = self._merged([w for own in words for w in own])
        count = np.array([len(own) for own in words])
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(count)
        sizes = total[ends] - total[ends - count]
        known = np.array([-1 if s is None else s for s in special])
        if (known >= 0).any():
            at = np.flatnonzero(known >= 0)
            ids = np.insert(ids, (np.cumsum(sizes) - sizes)[at], known[at])
            sizes[at] = 1
        return np.arange(len(pieces)), ids, sizes

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        flat[offsets[1:] - 1] += END
        ids, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in slices(offsets, self.symbols):
            found, size, failed = self.merges.encode(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ids.append(found)
            sizes.append(size)
            self.words += b - a
            self.failed += failed
        return np.concatenate(ids), np.concatenate(sizes)

    def whole(self, part: bytes) -> np.ndarray:
        if part in self.added:
            return np.array([self.added[part]])
        return self._merged(self._words(part))[0]


def encode(docs: DataFrame, tokenizer: str, params: BpeParams | None = None) -> DataFrame:
    """``docs(doc_id, text, ...)`` to ``doc_id, n_tokens, ids``: ids as little-endian unsigned 32-bit integers, no special tokens added.

    Texts are encoded where they are read, whole, a slice at a time. Null counts as empty; repeated rows and ids stay
    apart; other columns are ignored. A stretch of more than 256 KB without white space, digit or mark is one piece.
    """
    p = params or BpeParams()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer, p)
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for a, b in slices(offsets):
                ids, n = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = 4 * np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), raw.cast(pa.binary())], names=["doc_id", "n_tokens", "ids"])
        del encoder
        give_back()

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (with ``ids`` as from ``encode``) with ``decoded``: the tokens' strings joined by spaces, as the library
    joins them where a vocabulary names no decoder. Null ids give null. Ids beyond the vocabulary have no string and are left out."""
    schema = encoded.withColumn("decoded", F.lit(None).cast("string")).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer)
        if library.decoder is not None:
            raise ValueError(f"{tokenizer} has a decoder of its own")
        vocab = library.get_vocab(with_added_tokens=True)
        strings: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            strings[i] = text.encode() + b" "
        size = np.array([len(s) for s in strings], np.int64)
        begin, flat = np.cumsum(size) - size, np.frombuffer(b"".join(strings), np.uint8)
        for batch in batches:
            held = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            data, offsets = texts(held["ids"])
            for a, b in slices(offsets):
                ids = data[offsets[a] : offsets[b]].view("<u4").astype(np.int64)
                cuts = (offsets[a : b + 1] - offsets[a]) // 4
                known = ids < len(size)
                cuts, ids = np.concatenate([[0], np.cumsum(known)])[cuts], ids[known]
                ends = np.cumsum(size[ids])
                out = flat[np.repeat(begin[ids] - (ends - size[ids]), size[ids]) + np.arange(int(ends[-1]) if len(ends) else 0)]
                stops = np.concatenate([[0], ends])[cuts]
                last = stops[1:][stops[1:] > stops[:-1]] - 1  # the space after a document's last token
                stops = np.concatenate([[0], np.cumsum(np.diff(stops) - (np.diff(stops) > 0))])
                buffers = [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(np.delete(out, last))]
                decoded = pa.LargeStringArray.from_buffers(b - a, buffers[1], buffers[2]).cast(pa.string())
                null = pa.compute.is_null(held["ids"].slice(a, b - a))
                own = {n: c.slice(a, b - a) for n, c in held.items()} | {"decoded": pa.compute.if_else(null, pa.scalar(None, pa.string()), decoded)}
                yield pa.RecordBatch.from_arrays([own[n] for n in names], names=names)

    return encoded.mapInArrow(run, schema)
