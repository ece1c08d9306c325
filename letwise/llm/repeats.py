"""Rounds in which shards of documents ask which of their numbers other shards hold too.

The exact repeat operators name strings by 64-bit hashes and need to know, for each name, whether it
occurs elsewhere. Documents are dealt to shards of bounded size (``SHARD_BYTES``; one document longer than that
is taken whole). A shard folds its own repeats first, so a passage held by a third of all documents costs one
number a shard, packs its numbers by range (a part) and sends them on; each part meets all
shards' numbers in its range, and returns to each shard the ones that count. Packed arrays move
through Spark's shuffles as binary rows, so the work is Spark-partitioned while sorting runs in numpy.

The text is shuffled once: all passes over the shards read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 4 << 20
MESSAGE = "part long, shard long, kind int, blob binary"
_NAMES = ["part", "shard", "kind", "blob"]
_SCHEMA = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
ASK, TOLD, LOWER = 0, 1, 2


def sharded(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """doc_id, text and shard of every row, and the number of shards (from the bytes of all texts)."""
    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    return some.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))), n


def part_of(numbers: np.ndarray, parts: int) -> np.ndarray:
    """Part of each number: equal ranges of its upper half."""
    return ((numbers >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def packed(shard: int, parts: int, kind: int, numbers: np.ndarray, extra: np.ndarray | None = None) -> list[tuple]:
    """Sorted numbers (and one more array alongside) as a message to each part that they fall in."""
    part = part_of(numbers, parts)
    cut = np.flatnonzero(np.diff(part)) + 1
    out = []
    for lo, hi in zip([0, *cut], [*cut, len(numbers)]):
        if hi > lo:
            blob = numbers[lo:hi].tobytes() + (extra[lo:hi].tobytes() if extra is not None else b"")
            out.append((int(part[lo]), shard, kind, blob))
    return out


def table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SCHEMA)], schema=_SCHEMA)


def with_repeats(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers whose last bit tells whether the shard holds the number more than once."""
    found, count = np.unique(numbers | np.uint64(1), return_counts=True)
    return found ^ (count == 1).astype(np.uint64)


def _grouped(messages: pa.Table):
    return zip(messages["shard"].to_pylist(), messages["kind"].to_pylist(), messages["blob"].to_pylist())


def elsewhere(messages: pa.Table) -> pa.Table:
    """Of one part's ``with_repeats`` numbers: to each shard those (last bit set) that occur more than once."""
    asked = [(s, np.frombuffer(b, np.uint64)) for s, k, b in _grouped(messages) if k == ASK]
    out = [(0, s, k, b) for s, k, b in _grouped(messages) if k != ASK]
    if asked:
        every = np.concatenate([x for _, x in asked])
        every.sort()
        name = every | np.uint64(1)
        again = np.zeros(len(name), bool)
        again[1:] = name[1:] == name[:-1]
        names = np.unique(np.concatenate([name[again], every[(every & np.uint64(1)) == 1]]))
        for s, x in asked:
            mine = x | np.uint64(1)
            mine = mine[member(mine, names)]
            if len(mine):
                out.append((0, s, TOLD, mine.tobytes()))
    return table(out)


def blocks(messages: pa.Table) -> pa.Table:
    """Of one part's pairs of a core and a hull (last bit set if the shard has the pair more than once): to each shard
    its hulls that occur more than once with their core, and its open cores: those that occur more than
    once, but not always in such a hull. The last bits of the answers are set."""
    asked, out = [], []
    for s, k, b in _grouped(messages):
        half = len(b) // 2
        asked.append((s, np.frombuffer(b[:half], np.uint64), np.frombuffer(b[half:], np.uint64)))
    if asked:
        core = np.concatenate([x for _, x, _ in asked])
        raw = np.concatenate([x for _, _, x in asked])
        order = np.lexsort((raw, core))
        core, raw = core[order], raw[order]
        hull, several = raw | np.uint64(1), (raw & np.uint64(1)) == 1
        new_core = np.ones(len(core), bool)
        new_core[1:] = core[1:] != core[:-1]
        new = new_core.copy()
        new[1:] |= hull[1:] != hull[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(core))) + np.logical_or.reduceat(several, first)
        core_first = np.flatnonzero(new_core[first])
        lone = np.logical_or.reduceat(count == 1, core_first)
        places = np.add.reduceat(count, core_first)
        again = hull[first[count > 1]]
        again.sort()
        open_ = core[first[core_first[lone & (places > 1)]]]
        for s, x, y in asked:
            y = y | np.uint64(1)
            mine = np.concatenate([np.unique(x[member(x, open_)]), y[member(y, again)]])
            if len(mine):
                out.append((0, s, TOLD, mine.tobytes()))
    return table(out)


def smaller(messages: pa.Table) -> pa.Table:
    """Of one part's numbers with each shard's smallest id: to each shard those for which another shard has a
    smaller id. Messages of other kinds pass on."""
    asked, out = [], []
    for s, k, b in _grouped(messages):
        if k == LOWER:
            half = len(b) // 2
            asked.append((s, np.frombuffer(b[:half], np.uint64), np.frombuffer(b[half:], np.int64)))
        else:
            out.append((0, s, k, b))
    if asked:
        names, ids = np.concatenate([x for _, x, _ in asked]), np.concatenate([y for _, _, y in asked])
        order = np.lexsort((ids, names))
        names, ids = names[order], ids[order]
        first = np.ones(len(names), bool)
        first[1:] = names[1:] != names[:-1]
        names, ids = names[first], ids[first]
        for s, x, own in asked:
            mine = x[ids[np.searchsorted(names, x)] < own]
            if len(mine):
                out.append((0, s, LOWER, mine.tobytes()))
    return table(out)


def member(numbers: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which numbers are in the sorted array ``known``."""
    if not len(known) or not len(numbers):
        return np.zeros(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers


def answers(messages: pa.Table, kind: int) -> np.ndarray:
    """All numbers of a kind that came back to a shard, sorted."""
    found = [np.frombuffer(b, np.uint64) for _, k, b in _grouped(messages) if k == kind]
    out = np.concatenate(found) if found else np.zeros(0, np.uint64)
    out.sort()
    return out


def rounds(docs: DataFrame, parts: int, ask: Callable, reduce: Callable, ask_again: Callable, reduce_again: Callable,
           finish: Callable, schema: str) -> DataFrame:
    """Two rounds of questions over sharded documents.

    ``ask(docs)`` gives a shard's first messages, which ``reduce`` answers part by part; ``ask_again(docs, told)``
    gives the second ones, from what the first round told it, and ``reduce_again`` answers those; ``finish(docs, told)``
    makes a shard's result from all it was told. What the first round told is sent along to the last step.
    """
    def first(shard_docs: pa.Table) -> pa.Table:
        return table(ask(int(shard_docs["shard"][0].as_py()), shard_docs))

    def next_(shard_docs: pa.Table, told: pa.Table) -> pa.Table:
        if not shard_docs.num_rows:
            return table([])
        shard = int(shard_docs["shard"][0].as_py())
        keep = [(shard % parts, shard, TOLD, b) for _, k, b in _grouped(told) if k == TOLD]
        return table(ask_again(shard, shard_docs, told) + keep)

    def last(shard_docs: pa.Table, told: pa.Table) -> pa.Table:
        return finish(shard_docs, told)

    told = docs.groupBy("shard").applyInArrow(first, MESSAGE).groupBy("part").applyInArrow(reduce, MESSAGE)
    told = docs.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(next_, MESSAGE)
    told = told.groupBy("part").applyInArrow(reduce_again, MESSAGE)
    return docs.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(last, schema)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours (``len - width + 1`` of them)."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size:width - size + n])


def chosen(priority: np.ndarray, starts: np.ndarray, lo: int, width: int) -> np.ndarray:
    """For each window start the place of the smallest priority among ``width`` places from ``lo`` on, the
    leftmost of equal ones. The choice depends on the window's content only."""
    ranked = (priority & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(priority), dtype=np.uint64)
    return (sliding_min(ranked, width)[starts + lo] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``length`` at one of the starts."""
    edge = np.zeros(n + 1, np.int32)
    edge[starts] = 1
    np.subtract.at(edge, starts + length, 1)
    return np.cumsum(edge[:n]) > 0
