"""Words of whole texts as byte spans and 64-bit hashes, for the operators that read text in Arrow batches."""
from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK_BYTES = 2 << 20

#: Words of 0-9, a-z, A-Z (folded to a-z) and every byte of a non-ASCII character.
FOLDED = "folded"
#: Words of anything but space, tab, line feed, vertical tab, form feed and carriage return.
UNSPACED = "unspaced"
_INSIDE = {FOLDED: np.array([chr(b).isalnum() if b < 128 else True for b in range(256)]), UNSPACED: np.array([b not in (9, 10, 11, 12, 13, 32) for b in range(256)])}

_random = np.random.RandomState(20240229)
_BYTE = {UNSPACED: _random.randint(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)}
_BYTE[FOLDED] = _BYTE[UNSPACED].copy()
_BYTE[FOLDED][65:91] = _BYTE[UNSPACED][97:123]
_GRAM = _random.randint(0, 1 << 63, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_Q = 0x9E3779B97F4A7C15
_Q_INVERSE = pow(_Q, -1, 1 << 64)
_powers: list[np.ndarray] = []


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ready(spark: SparkSession) -> None:
    """Executors get this package's code, and Arrow batches are bounded: one of very long texts must fit in a Python worker."""
    if spark.sparkContext.applicationId not in _shipped:
        root = Path(__file__).parent.parent
        # The driver serves this file to executors as long as it lives.
        folder = tempfile.TemporaryDirectory()
        with zipfile.ZipFile(f"{folder.name}/{root.name}_code.zip", "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(z.filename)
        _shipped[spark.sparkContext.applicationId] = folder
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        _powers[:] = [np.cumprod(np.concatenate(([U64(1)], np.full(size - 1, base, U64))), dtype=U64) for base in (_Q, _Q_INVERSE)]
    return _powers[0], _powers[1]


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each begins. A null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.zeros(1, np.int64) if not len(column) else np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


@dataclass
class Words:
    """Words of consecutive texts: text d of the chunk owns words first[d]:first[d + 1]."""
    low: int
    high: int
    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.high - self.low), np.diff(self.first))


def word_chunks(column: pa.Array, word: str, chunk: int = CHUNK_BYTES, hashed: bool = True) -> Iterator[Words]:
    """Whole texts, cut into chunks of about `chunk` bytes so that the arrays stay small; a text is never cut."""
    data, at = raw_text(column)
    low, n = 0, len(at) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + chunk, "right")) - 1)
        yield words_of(data[at[low]:at[high]], at[low:high + 1] - at[low], word, low, hashed)
        low = high


def words_of(data: np.ndarray, at: np.ndarray, word: str, low: int = 0, hashed: bool = True) -> Words:
    inside = _INSIDE[word][data]
    begins, ends = at[:-1][at[:-1] < len(data)], at[1:][at[1:] > 0] - 1
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[begins], after[ends] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    h = np.zeros(0, U64)
    if hashed:
        q, inverse = _power_tables(len(data) + 1)
        prefix = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE[word][data] * q[:len(data)], out=prefix[1:])
        h = mix((prefix[end] - prefix[start]) * inverse[start])
    return Words(low, low + len(at) - 1, data, at, start, end, np.searchsorted(start, at), h)


def hash_words(words: list[str], word: str) -> np.ndarray:
    """Hashes of single words, equal to those that `word_chunks` gives them in a text."""
    raw = [w.encode() for w in words]
    at = np.concatenate(([0], np.cumsum([len(w) for w in raw]))).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    q, inverse = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[word][data] * q[:len(data)], out=prefix[1:])
    return mix((prefix[at[1:]] - prefix[at[:-1]]) * inverse[at[:-1]])


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words; those that cross a text's end are for the caller to leave out."""
    n = max(0, len(h) - k + 1)
    total = np.zeros(n, U64)
    for j in range(k):
        total += h[j:j + n] * _GRAM[j]
    return mix(total)


def run_hashes(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash for each run h[start:stop] of any length."""
    q, inverse = _power_tables(len(h) + 1)
    prefix = np.zeros(len(h) + 1, U64)
    np.cumsum(h * q[:len(h)], out=prefix[1:])
    return mix((prefix[stop] - prefix[start]) * inverse[start] + U64(_Q) * (stop - start).astype(U64))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for length[0] values, then those of start[1], and so on."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    return np.arange(total) + np.repeat(start - begin, length)


def row_key(df: DataFrame, *columns: str):
    """A 64-bit hash of the columns for dealing rows out evenly; null and repeated values are allowed."""
    return F.xxhash64(*[df[c] for c in columns])


def text_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0
