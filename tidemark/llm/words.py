"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

All functions work on a chunk: the joined bytes of some texts and the offsets between them.
Bytes of 0x80 and more belong to characters outside ASCII, so classes of ASCII characters
can be told on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once; bounds the memory of a task. A longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

#: Word characters of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing: digits, a-z, all non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Word characters of `[^\x20\x09-\x0D]`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[0x20] = NON_SPACE[0x09:0x0E] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_CODE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_key, doc_id, text): only what an operator needs, with a key that is unique even if ids repeat.

    Null text becomes empty. Other columns, whatever their names, are left out.
    """
    return df.select(
        F.monotonically_increasing_id().alias("row_key"),
        df[id_col].alias("doc_id"),
        F.coalesce(df[text_col], F.lit("")).alias("text"),
    )


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser with full avalanche)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Chunk(NamedTuple):
    """Some rows of a batch: their first and last row, joined bytes, and n + 1 offsets into these."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int | None = None) -> Iterator[Chunk]:
    """Divide a text column into chunks of about CHUNK_BYTES."""
    limit = limit or CHUNK_BYTES
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Chunk(first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


class Words(NamedTuple):
    """Byte range, text number within the chunk and hash of each word; words of text i are bounds[i]:bounds[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values; runs end at the borders of texts."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    ends = np.zeros(n + 1, bool)
    ends[1:] = mask
    ends[1:n] &= ~mask[1:]
    border = offsets[(offsets > 0) & (offsets < n)]
    begins[border] |= mask[border]
    ends[border] |= mask[border - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends)


def segment_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each non-empty byte range; ranges ascend and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.concatenate(([0], np.cumsum(length)))
    within = np.arange(first[-1]) - np.repeat(first[:-1], length)
    values = _BYTE_CODE[data[within + np.repeat(start, length)]] * powers(int(length.max()), base)[within]
    return mix(np.add.reduceat(values, first[:-1]))


def split_words(chunk: Chunk, table: np.ndarray = ALNUM, lower: bool = True) -> Words:
    """The words of a chunk, A-Z lower-cased first if asked for."""
    data = _LOWER[chunk.data] if lower else chunk.data
    start, end = runs(table[data], chunk.offsets)
    bounds = np.searchsorted(start, chunk.offsets)
    doc = np.repeat(np.arange(len(chunk.offsets) - 1), np.diff(bounds))
    return Words(start, end, doc, bounds, segment_hash(data, start, end))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def gram_hash(words: np.ndarray, k: int, base: int = 0xA0761D6478BD642F) -> np.ndarray:
    """A hash of each k consecutive words, also across texts; callers leave those out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(k, base)):
        total += words[j : j + n] * p
    return mix(total)


def whole_grams(words: Words, k: int) -> np.ndarray:
    """Numbers of the words at which k words of one text begin."""
    n = len(words.doc) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.doc[:n] == words.doc[k - 1 :])


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))
