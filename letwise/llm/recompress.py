"""Substring dedup by recompression: runs of words that an earlier document holds are removed.

Recompression names adjacent pairs of tokens: a random bit of each token's name splits the alphabet in
left and right, and each left token followed by a right one becomes one symbol, named by a
hash of its parts. Hashes are the same everywhere, so equal substrings get equal symbols inside
without a dictionary. After ``LEVELS`` = 2 such rounds symbols span 1 to 4 words, and whether a symbol ends at a place
depends on two words on either side only; a run of one token stays single symbols, since a run that a
window cuts could have no name that both sides know.

Within each window of words the symbol end with the smallest name, at least four words from the window's ends, is
its place; the eight words around that are what windows share first. Round one asks which of
these occur more than once; round two asks, for the windows that have such a place, whether a
smaller document id holds the whole window, which verifies them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from letwise.llm import repeats as rp
from letwise.llm import textkit as tk

WINDOW = 13
_SIDE = 4
_NULL_ID = np.iinfo(np.int64).max
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def symbol_ends(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word: the joint name of the symbols on both sides if a level-2 symbol begins there, else the
    largest number. Documents' own edges are not marked."""
    n = len(names)
    out = np.full(n, _NEVER, np.uint64)
    if n < 4:
        return out
    bit = (names >> np.uint64(17)) & np.uint64(1)
    joined = np.zeros(n + 1, bool)
    joined[1:n] = (bit[:-1] == 0) & (bit[1:] == 1)
    pair = np.zeros(n, np.uint64)
    pair[:-1] = tk.mix(names[:-1] * np.uint64(0xD6E8FEB86659FD93) + names[1:])
    at = np.arange(2, n - 1)
    left = np.where(joined[at - 1], pair[at - 2], names[at - 1])
    right = np.where(joined[at + 1], pair[at], names[at])
    merged = ((tk.mix(left) >> np.uint64(23)) & np.uint64(1) == 0) & ((tk.mix(right) >> np.uint64(23)) & np.uint64(1) == 1)
    ends = ~joined[at] & ~merged
    out[at[ends]] = tk.mix(left * np.uint64(0x9FB21C651E98DF25) + right)[ends] >> np.uint64(1)
    return out


class _Chunk:
    """Words of a chunk of documents, its window starts, and the place each window chooses."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.words = tk.Words(data, offsets)
        self.names = self.words.hashes()
        self.window, first, n = window, self.words.first, len(self.names)
        self.starts = np.flatnonzero(tk.starts_within(first, window, n))
        self.doc = np.searchsorted(first, self.starts, "right") - 1
        if len(self.starts):
            width = window - 2 * _SIDE + 1
            place = rp.chosen(symbol_ends(self.names, first), self.starts, _SIDE, width)
        else:
            place = self.starts
        self.anchors, self.anchor_of = np.unique(place, return_inverse=True)
        around = tk.grams(self.names, 2 * _SIDE, 1)
        self.cores = around[self.anchors - _SIDE] | np.uint64(1)

    def asked(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, documents and names of the windows whose place is shared."""
        shared = rp.member(self.cores, told)[self.anchor_of]
        return self.starts[shared], self.doc[shared], tk.grams(self.names, self.window, 2)[self.starts[shared]]


def _chunks(docs: pa.Table):
    data, offsets = tk.utf8(docs["text"].combine_chunks())
    ids = docs["doc_id"].fill_null(_NULL_ID).to_numpy().astype(np.int64)
    for i, j in tk.chunks(offsets):
        yield ids[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _smallest(docs: pa.Table, told: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of a shard's shared windows, sorted, and the smallest id that holds each."""
    names, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for ids, data, offsets in _chunks(docs):
        _, doc, name = _Chunk(data, offsets, window).asked(told)
        names.append(name)
        owners.append(ids[doc])
    name, owner = np.concatenate(names), np.concatenate(owners)
    order = np.lexsort((owner, name))
    name, owner = name[order], owner[order]
    new = np.ones(len(name), bool)
    new[1:] = name[1:] != name[:-1]
    return name[new], owner[new]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 shard_bytes: int = rp.SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``window`` words that covers it also starts in
    a row with a smaller doc_id; windows are judged on the input. Null texts have no words. A null id counts as
    larger than any other; rows that share an id never remove from each other. An empty table gives an
    empty result. ``window`` must be 12 at least. Windows are compared by 64-bit hashes, after the words
    around their place.
    """
    if window < 3 * _SIDE:
        raise ValueError("a window of under 12 words need not hold a symbol end four words from its ends")
    texts, parts = rp.sharded(docs, id_col, text_col, shard_bytes)

    def ask(shard, table):
        names = [np.zeros(0, np.uint64)]
        for _, data, offsets in _chunks(table):
            names.append(_Chunk(data, offsets, window).cores)
        return rp.packed(shard, parts, rp.ASK, rp.with_repeats(np.concatenate(names)))

    def ask_again(shard, table, told):
        name, owner = _smallest(table, rp.answers(told, rp.TOLD), window)
        return rp.packed(shard, parts, rp.LOWER, name, owner)

    def finish(table, told):
        shared, lower = rp.answers(told, rp.TOLD), rp.answers(told, rp.LOWER)
        name, owner = _smallest(table, shared, window)
        out_ids, size, gone, kept = table["doc_id"], [], [], []
        for ids, data, offsets in _chunks(table):
            c = _Chunk(data, offsets, window)
            starts, doc, mine = c.asked(shared)
            drop = rp.member(mine, lower)
            if len(mine):
                drop |= owner[np.searchsorted(name, mine)] < ids[doc]
            off = rp.covered(starts[drop], window, len(c.names))
            raw, first = data.tobytes(), c.words.first
            begin, end = c.words.start.tolist(), c.words.end.tolist()
            for d in range(len(ids)):
                a, b = int(first[d]), int(first[d + 1])
                stay = np.flatnonzero(~off[a:b]) + a
                size.append(b - a)
                gone.append(b - a - len(stay))
                kept.append(b" ".join([raw[begin[w]:end[w]] for w in stay.tolist()]).decode())
        return pa.table({"doc_id": out_ids, "n_words": pa.array(size, pa.int64()),
                         "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.string())})

    return rp.rounds(texts, parts, ask, rp.elsewhere, ask_again, rp.smaller, finish,
                     "doc_id long, n_words long, n_removed long, kept string")
