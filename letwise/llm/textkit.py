"""Array helpers for the operators that work on Arrow batches of texts.

Everything here works on one bounded chunk of whole documents at a time (``chunks``); a single
document longer than the chunk size is a chunk of its own. Hashes are polynomial hashes modulo
2**64 over random byte values, finished by an avalanche step, so that equal byte strings get
equal numbers in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise.session import ship_package

CHUNK_BYTES = 1 << 18
BATCH_ROWS = 1000
_BASE = 0x9E3779B97F4A7C55 | 1
_M64 = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``BATCH_ROWS``: rows that hold whole texts are long, and a batch is
    held several times over in the JVM and in Python. Every operator with Python workers comes through here, so the
    package is shipped to them as well."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def returning_memory(batches: Iterable) -> Iterator:
    """The batches of a task; afterwards the worker, which Spark keeps for later tasks, gives free memory back."""
    yield from batches
    return_memory()


def return_memory() -> None:
    """Give this process's free memory back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def plainly_named(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``frame`` with columns ``c0, c1, ...``, which no name of an operator clashes with, and these by their old names."""
    names = {c: f"c{i}" for i, c in enumerate(frame.columns)}
    return frame.toDF(*names.values()), names


def named_back(names: dict[str, str], **instead: Column) -> list[Column]:
    """The columns of a plainly named frame under their old names; ``instead`` are columns to take for some of them."""
    return [instead.get(new, F.col(new)).alias(old) for old, new in names.items()]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_power["up"]) < n:
        m = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _power[name] = np.cumprod(steps)
    return _power["up"], _power["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step on uint64 numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (``len + 1``) of a string column; a null is an empty text."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges ``(first, last)`` of documents that hold about ``limit`` bytes; every document once."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a chunk of documents.

    ``start``, ``end``: byte positions; ``first``: index of each document's first word, plus the total.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, n = data, len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        edge[n] = True
        space = _SPACE[data]
        word = ~space
        before = edge[:n].copy()
        before[1:] |= space[:-1]
        after = edge[1:].copy()
        after[:-1] |= space[1:]
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix(self.data), self.start, self.end)


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each ``[start, end)``."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def grams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` numbers (``len - k + 1`` of them, none if shorter)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(seed * 2 + 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + n]
    return mix(out)


def starts_within(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the ``n`` positions start a run of ``k`` that ends in the same document."""
    ok = np.zeros(n + 1, np.int64)
    lo, hi = first[:-1], np.maximum(first[:-1], first[1:] - k + 1)
    np.add.at(ok, lo, 1)
    np.add.at(ok, hi, -1)
    return np.cumsum(ok[:n]) > 0
