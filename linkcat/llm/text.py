"""Whole texts as numpy arrays: words, their hashes, and the map over rows that the operators share.

A batch of texts is one byte array with offsets. Words are maximal runs of word bytes inside a text; both
word rules of the operators treat every byte of a non-ASCII character as a word byte, so UTF-8 need not be decoded.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_ASCII = np.arange(256)
#: Digits, letters a-z (after lower-casing) and everything beyond ASCII.
LETTERS = ((_ASCII >= 0x30) & (_ASCII <= 0x39)) | ((_ASCII >= 0x61) & (_ASCII <= 0x7A)) | (_ASCII >= 0x80)
#: Everything but ASCII white space.
NOT_SPACE = ~((_ASCII == 0x20) | ((_ASCII >= 0x09) & (_ASCII <= 0x0D)))
LOWER = np.where((_ASCII >= 0x41) & (_ASCII <= 0x5A), _ASCII + 32, _ASCII).astype(np.uint8)

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 18)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, b, U64)]), dtype=U64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    def forget(self) -> None:
        """Give the powers up; they are made anew when asked for."""
        self.up = self.down = np.ones(1, U64)


_BYTES, _WORDS, _SECOND = _Powers(_BASE), _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair, by differences of one prefix sum modulo 2^64."""
    up, down = powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum((values + U64(1)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


class PrefixSums:
    """Prefix sums of one array under both word bases, for hashes of many overlapping runs."""

    def __init__(self, values: np.ndarray):
        self.sums, self.down = [], []
        for powers in (_WORDS, _SECOND):
            up, down = powers.to(len(values) + 1)
            sums = np.zeros(len(values) + 1, U64)
            np.cumsum((values + U64(1)) * up[: len(values)], out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)


def run_hashes_at(prefix: PrefixSums, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """As ``run_hashes`` of the array behind ``prefix``."""
    sums = prefix.sums[which]
    return mix((sums[ends] - sums[starts]) * prefix.down[which][starts] + (ends - starts).astype(U64))


class Words:
    """The words of a slice of texts.

    ``start`` and ``end`` are byte positions in ``data``; ``first[i]:first[i + 1]`` are the words of text ``i``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        inside = table[data]
        before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        before[1:], after[:-1] = inside, inside
        before[offsets], after[offsets] = False, False
        self.start = np.flatnonzero(inside & ~before[:-1])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.data, self.offsets = data, offsets
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data.astype(U64), self.start, self.end, _BYTES)

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts, each followed by one space, as bytes; and where each word begins there (one more at the end)."""
        size = self.end - self.start
        at = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(at[-1], 0x20, np.uint8)
        keep = np.zeros(len(self.data) + 1, np.int8)
        keep[self.start] += 1
        keep[self.end] -= 1
        spaces = np.ones(at[-1], bool)
        spaces[at[1:] - 1] = False
        out[spaces] = self.data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
        return out, at


def shingles(hashes: np.ndarray, first: np.ndarray, width: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every run of ``width`` words inside one text; ``second`` takes an independent hash."""
    size = np.diff(first)
    n = np.maximum(size - width + 1, 0)
    start = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return start, run_hashes(hashes, start, start + width, _SECOND if second else _WORDS)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary array; nulls count as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Return freed memory to the system, as a worker outlives the task that needed it."""
    for powers in (_BYTES, _WORDS, _SECOND):
        powers.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library that has it
        pass


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes of text; a longer text is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1, low + 1)
        high = min(high, n, low + 20_000)
        yield low, high
        low = high


def binary_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow array of byte strings cut from one buffer."""
    kind = kind or pa.large_binary()
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def add_columns(docs: DataFrame, fields: str, fn: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]], text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Rows as the struct ``row``, with the columns ``fields`` that ``fn()`` works out for slices of ``limit`` bytes of text.

    ``fn`` runs once in each task. Rows are neither dropped nor reordered; a null text is worked on as empty. Since the
    input sits in a struct, its columns may have the names of ``fields``.
    """
    nested = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([T.StructField("row", nested.schema["row"].dataType), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(text)
            _, offsets = buffers(texts)
            for low, high in slices(offsets, limit):
                found = work(texts.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([rows.slice(low, high - low), *(found[f.name] for f in added.fields)], ["row", *added.names])
        give_back()

    return nested.mapInArrow(run, schema)
