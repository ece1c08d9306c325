"""Exact removal of byte strings that occur elsewhere.

Blocks of equal suffixes are refined in rounds, as when Burrows-Wheeler transforms of shards are merged by
interleave refinement: a block is the set of all places, in all shards, that share the string
read so far; each round splits blocks by a longer string, and a block with one place is done. Blocks
are named by a hash of their string instead of their row in a merged transform, and depth grows in
three steps instead of byte by byte (the README has the figures that rule that out):

1. Each window of ``LENGTH`` bytes chooses the place with the smallest hash of 16 bytes within it, away from its
   ends. The bytes common to all windows that could choose the place are its core: if the core
   occurs once, so do these windows.
2. The bytes that these windows cover together are the place's hull: if the same core has the same hull at another
   place, so are all of the windows repeated.
3. A core that occurs more than once, but not always in a hull that does, is open: its windows are asked for
   one by one, at all of its places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from letwise.llm import repeats as rp
from letwise.llm import textkit as tk

LENGTH = 400
_GRAM = 16


class _Chunk:
    """Window starts of a chunk of documents, and the place each chooses."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        n = len(data)
        gram = min(_GRAM, length)
        spare = (length - gram) * 2 // 5
        self.lo, self.width = (length - gram - spare) // 2, spare + 1
        self.length, self.sums = length, tk.prefix(data)
        self.starts = np.flatnonzero(tk.starts_within(offsets, length, n))
        at = np.arange(max(0, n - gram + 1))
        rank = tk.span_hash(self.sums, at, at + gram)
        self.place = rp.chosen(rank, self.starts, self.lo, self.width) if len(self.starts) else self.starts
        self.anchors, self.anchor_of = np.unique(self.place, return_inverse=True)
        doc = np.searchsorted(offsets, self.anchors, "right") - 1
        first = np.maximum(offsets[doc], self.anchors - self.lo - self.width + 1)
        last = np.minimum(offsets[doc + 1], self.anchors - self.lo + length)
        self.core = self.names(self.anchors - self.lo, self.anchors - self.lo - self.width + 1 + length, 1)
        # the distance tells places of a short document apart whose hulls are the same bytes
        self.hull = self.names(first, last, 2) ^ tk.mix((self.anchors - first).astype(np.uint64)) | np.uint64(1)

    def names(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        return tk.mix(tk.span_hash(self.sums, start, end) + np.uint64(seed)) | np.uint64(1)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return self.names(starts, starts + self.length, 3)

    def known(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows known to be repeated, and windows of open cores."""
        core, hull = rp.member(self.core, told), rp.member(self.hull, told)
        return self.starts[hull[self.anchor_of]], self.starts[core[self.anchor_of]]

    def pairs(self) -> np.ndarray:
        return np.stack([self.core, self.hull], axis=1)


def _chunks(docs: pa.Table):
    data, offsets = tk.utf8(docs["text"].combine_chunks())
    for i, j in tk.chunks(offsets):
        yield data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 shard_bytes: int = rp.SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary: the remaining bytes) of every row.

    A byte goes if a string of ``length`` bytes that covers it starts at another place too, in any document, the
    same one included; overlapping places count, and strings are judged on the input. Matches never cross
    documents. Null and empty texts have no bytes; rows that repeat an id are documents of their own, and an
    empty table gives an empty result. Strings are compared by 64-bit hashes at up to three depths.
    """
    texts, parts = rp.sharded(docs, id_col, text_col, shard_bytes)

    def ask(shard, table):
        pairs = [np.zeros((0, 2), np.uint64), *(_Chunk(x, offsets, length).pairs() for x, offsets in _chunks(table))]
        core, hull = np.concatenate(pairs).T
        order = np.lexsort((hull, core))
        core, hull = core[order], hull[order]
        new = np.ones(len(core), bool)
        new[1:] = (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])
        first = np.flatnonzero(new)
        once = np.diff(np.append(first, len(core))) == 1
        return rp.packed(shard, parts, rp.ASK, core[first], hull[first] ^ once.astype(np.uint64))

    def ask_again(shard, table, told):
        told = rp.answers(told, rp.TOLD)
        names = [np.zeros(0, np.uint64)]
        for data, offsets in _chunks(table):
            c = _Chunk(data, offsets, length)
            names.append(c.windows(c.known(told)[1]))
        return rp.packed(shard, parts, rp.ASK, rp.with_repeats(np.concatenate(names)))

    def finish(table, told):
        told = rp.answers(told, rp.TOLD)
        ids, size, gone, runs, kept = table["doc_id"], [], [], [], []
        for data, offsets in _chunks(table):
            c = _Chunk(data, offsets, length)
            sure, open_ = c.known(told)
            drop = rp.covered(np.union1d(sure, open_[rp.member(c.windows(open_), told)]), length, len(data))
            for a, b in zip(offsets[:-1], offsets[1:]):
                mine = drop[a:b]
                size.append(b - a)
                gone.append(int(mine.sum()))
                runs.append(int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()))
                kept.append(data[a:b][~mine].tobytes())
        return pa.table({"doc_id": ids, "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "n_spans": pa.array(runs, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return rp.rounds(texts, parts, ask, rp.blocks, ask_again, rp.elsewhere, finish,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
