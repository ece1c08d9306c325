"""Benchmark decontamination: a generalised suffix automaton of the test items, walked by the documents.

The automaton holds every run of words of every item. Documents stream through it in one pass
without a shuffle; at each word it knows the longest run of item words that ends there, so windows
of items show up as match lengths. An automaton holds ``item_chars`` characters of items at most
(plus one item); more items make more automata, and the documents pass through each of them in turn.
Between passes the documents are written to the shared folder and the automaton is dropped, so one
automaton at a time is in memory, whatever the number of items, while no item is left out.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letwise.llm import textkit as tk
from letwise.session import scratch_path

WINDOW = 13
ITEM_CHARS = 500_000
_FOLD = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A
    else 0x20 for c in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("longest", T.LongType()),
    T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def normalised_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a null has none."""
    return text.encode().translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton over words, with the windows of each item marked on its states."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, set[tuple[int, str]]] = {}
        for name, words in items:
            need = min(window, len(words))
            for _, state in self._ends(words, need):
                if need == window:
                    self.owners.setdefault(state, set()).add(name)
                else:
                    self.short.setdefault(state, set()).add((need, name))
        self.least = min((min(window, len(words)) for _, words in items if words), default=0)
        self.words = set().union(*(words for _, words in items)) if items else set()

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            clone = len(nxt)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = clone
            while p != -1 and nxt[p].get(w) == q:
                nxt[p][w] = clone
                p = link[p]
            return clone

        q = nxt[last].get(w)
        if q is not None:
            return q if length[q] == length[last] + 1 else split(last, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def walk(self, words):
        """After each word: the longest match that ends there, and its state."""
        nxt, link, length = self.next, self.link, self.length
        s = n = 0
        for w in words:
            t = nxt[s].get(w)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = nxt[s].get(w)
            if t is None:
                n = 0
            else:
                s, n = t, n + 1
            yield n, s

    def _state(self, s: int, need: int) -> int:
        while self.length[self.link[s]] >= need:
            s = self.link[s]
        return s

    def _ends(self, words, need):
        for e, (n, s) in enumerate(self.walk(words), 1):
            if need and n >= need:
                yield e, self._state(s, need)

    def match(self, words: list[bytes]) -> tuple[int, list[list[int]], set[str]]:
        """Longest match, spans of words inside occurrences of windows, and the items these belong to.

        An unknown word sends the automaton back to its root, so only runs of known words at least as
        long as the shortest window are walked.
        """
        longest, spans, found = 0, [], set()
        if not self.least:
            return longest, spans, found
        known = bytes(map(self.words.__contains__, words))
        for run in re.finditer(b"\x01{%d,}" % self.least, known):
            at = run.start()
            for e, (n, s) in enumerate(self.walk(words[at:run.end()]), at + 1):
                if n > longest:
                    longest = n
                if n < self.least:
                    continue
                most = 0
                if n >= self.window:
                    most = self.window
                    found |= self.owners.get(self._state(s, most), set())
                if self.short:
                    q = s
                    while q > 0:
                        for need, name in self.short.get(q, ()):
                            if need <= n:
                                most = max(most, need)
                                found.add(name)
                        q = self.link[q]
                if most:
                    if spans and e - most <= spans[-1][1]:
                        spans[-1][0], spans[-1][1] = min(spans[-1][0], e - most), e
                        while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                            spans[-2:] = [[min(spans[-2][0], spans[-1][0]), e]]
                    else:
                        spans.append([e - most, e])
        return longest, spans, found


def _merged(a: list, b: list) -> list:
    out: list = []
    for lo, hi in sorted([*map(list, a), *map(list, b)]):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _pass(frame: DataFrame, text_col: str, automaton, schema: T.StructType, more: bool, cut: bool) -> DataFrame:
    def matched(batches):
        machine = automaton.value
        for batch in tk.returning_memory(batches):
            old = batch.column("__hits").to_pylist() if more else None
            rows = []
            for i, text in enumerate(batch.column(text_col)):
                words = normalised_words(text.as_py())
                longest, spans, items = machine.match(words)
                if more:
                    longest = max(longest, old[i]["longest"])
                    spans, items = _merged(spans, old[i]["hits"]), items | set(old[i]["items"])
                rows.append({"n_words": len(words), "n_hit": sum(b - a for a, b in spans), "longest": longest,
                             "hits": spans, "items": sorted(items)})
            names = [x for x in batch.schema.names if x != "__hits"]
            columns = [*(batch.column(x) for x in names), pa.array(rows, _ARROW)]
            if cut:
                clean = [_without(t.as_py(), r["hits"], machine.window) for t, r in zip(batch.column(text_col), rows)]
                columns.append(pa.array(clean, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return frame.mapInArrow(matched, schema)


_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
                    ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def match_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = WINDOW, item_chars: int = ITEM_CHARS,
                cut: bool = False) -> DataFrame:
    """``docs`` with a struct column ``__hits``: n_words, n_hit, longest (match length in words), hits
    (spans of hit words, ``[first, last)``) and items (ids of items with an occurring window, sorted as strings).

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. Null or empty texts
    have no words and no hits; items without words have no window; items repeated under one id count once,
    a null id is the string ``null``. Rows stay one to one with ``docs``. With ``cut``, ``__clean`` is the text without
    its hit spans of ``window`` words or more. Columns already called so are replaced. Items that need several automata
    make this call run all passes but the last.
    """
    spark = docs.sparkSession
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("__hits", "__clean")])
    tk.small_batches(spark)
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
                         F.col(item_text).cast("string").alias("text")).where("text is not null")
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // item_chars))
    fields = [*docs.schema.fields, T.StructField("__hits", HITS)]
    out = docs
    for k in range(parts):
        rows = named.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).collect()
        machine = Automaton([(r["id"], normalised_words(r["text"])) for r in rows], window)
        last = cut and k == parts - 1
        schema = T.StructType([*fields, T.StructField("__clean", T.StringType())] if last else fields)
        sent = spark.sparkContext.broadcast(machine)
        out = _pass(out, text_col, sent, schema, k > 0, last)
        if k < parts - 1:
            path = scratch_path(spark, "pass")
            out.write.parquet(path)
            sent.destroy()
            out = spark.read.schema(out.schema).parquet(path)
    return out


def remove_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW,
                         coverage: float = 0.05, item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Documents with benchmark material taken out; columns as in ``docs``.

    A document of whose words at least the share ``coverage`` is hit goes as a whole. In the others each hit
    span of ``window`` words or more is cut out of the text (from its first word's first byte to its last
    word's last byte); shorter spans, which only items shorter than a window make, stay. Texts without hits
    are unchanged, null texts too.
    """
    plain, names = tk.plainly_named(docs)
    found = match_items(plain, items, names[text_col], item_id, item_text, window, cut=True)
    kept = found.where((F.col("__hits.n_hit") == 0) | (F.col("__hits.n_hit") < coverage * F.col("__hits.n_words")))
    return kept.select(*tk.named_back(names, **{names[text_col]: F.col("__clean")}))


def _without(text: str | None, hits: list, least: int) -> str | None:
    spans = [x for x in hits if x[1] - x[0] >= least]
    if not spans:
        return text
    data = text.encode()
    at = [m.span() for m in re.finditer(rb"\S+", data.translate(_FOLD))]
    out, last = [], 0
    for a, b in spans:
        out.append(data[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode()
