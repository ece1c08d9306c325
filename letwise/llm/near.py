"""MinHash near-dedup by a multi-index Hamming join.

A text's set of word shingles gets ``SYMBOLS`` = 32 MinHash values, of which 16 bits each are kept. The signature
distance of two sets is the number of symbols that differ. Signatures are split into ``CHUNKS`` = 8 chunks: of two
signatures that differ in at most 15 symbols, some chunk differs in at most one, so with every way to leave out
one symbol of a chunk as a key, all pairs up to distance 15 share a key (two sets of similarity 0.85 exceed that
distance with probability 3e-6, of 0.8 with 1e-4).
Links are confirmed on the full sets.

Sets are compared as classes of equal sets, so exact copies cost a row each and nothing more. A bucket of a key
does not emit its pairs:

1. Every class is compared with its buckets' smallest classes, their heads (a star a bucket).
2. Similarity distance is a metric: of two linked classes of a bucket, either both lie within 0.5 of its head, or both
   further than 0.5 less the largest distance of a link. So what is left to compare are the classes around
   each head, and the far classes of each bucket, and there only classes that the links so far leave in
   different components.
3. These groups are cut in blocks of bounded size; each pair of blocks is one task's matrix product, which
   returns only links that join components. A group's largest component is never compared with itself.

Class and shingle numbers are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letwise.llm import textkit as tk
from letwise.session import scratch_path

SHINGLE = 5
SYMBOLS, CHUNKS = 32, 8
BLOCK, BLOCK_SHINGLES, SLAB = 512, 1 << 18, 4096
_PER = SYMBOLS // CHUNKS
_RNG = np.random.default_rng(97)
_FACTOR = _RNG.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk, and where each document's begin (plus the end).

    A document of fewer than ``k`` words, but not none, has its whole sequence as its only shingle.
    """
    words = tk.Words(_FOLD[data], offsets)
    hashes, count = words.hashes(), np.diff(words.first)
    n = len(offsets) - 1
    every = tk.grams(hashes, k)
    at = np.flatnonzero(tk.starts_within(words.first, k, len(hashes)))
    doc = np.searchsorted(words.first, at, "right") - 1
    found = every[at]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        own = np.array([tk.grams(hashes[words.first[d]:words.first[d + 1]], int(count[d]))[0] for d in short], np.uint64)
        found, doc = np.concatenate([found, own]), np.concatenate([doc, short])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    found, doc = found[new], doc[new]
    return found, np.searchsorted(doc, np.arange(n + 1))


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols (16 bits each) of nonempty sets: a row each."""
    out = np.empty((len(first), SYMBOLS), np.uint64)
    for j in range(SYMBOLS):
        out[:, j] = tk.mix(np.minimum.reduceat(sets * _FACTOR[j] + _SHIFT[j], first)) & np.uint64(0xFFFF)
    return out


def bucket_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys of each signature: for each chunk and each symbol of it, the others with the place as a tag."""
    keys = []
    for c in range(CHUNKS):
        part = symbols[:, c * _PER:(c + 1) * _PER]
        for leave in range(_PER):
            kept = np.delete(part, leave, axis=1)
            key = np.full(len(part), c * _PER + leave, np.uint64)
            for j in range(kept.shape[1]):
                key = (key << np.uint64(16)) | kept[:, j]
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def _set_ids(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    count = np.diff(np.append(first, len(sets))).astype(np.uint64)
    return tk.mix(np.add.reduceat(tk.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), first) + count)


def _sets_of(column: pa.Array, k: int):
    """For each chunk of a text column: first row, sets, their bounds."""
    data, offsets = tk.utf8(column)
    for i, j in tk.chunks(offsets):
        sets, bounds = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
        yield i, sets, bounds


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, cid (class: hash of the whole set; null for an empty set) and keys of every row."""
    def sketched(batches):
        for batch in tk.returning_memory(batches):
            n = batch.num_rows
            size, cid, keys = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, SYMBOLS), np.int64)
            for i, sets, bounds in _sets_of(batch.column("text"), k):
                count = np.diff(bounds)
                full = np.flatnonzero(count)
                size[i:i + len(count)] = count
                if len(full):
                    first = bounds[:-1][full]
                    cid[i + full] = _set_ids(sets, first).view(np.int64)
                    keys[i + full] = bucket_keys(signatures(sets, first))
            used = np.flatnonzero(size)
            ends = np.concatenate([[0], np.cumsum(np.where(size > 0, SYMBOLS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size), pa.array(cid, mask=size == 0),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[used].ravel()))],
                ["doc_id", "n_shingles", "cid", "keys"])

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return some.mapInArrow(sketched, "doc_id long, n_shingles long, cid long, keys array<long>")


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _numbers(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), np.uint64)


def class_sets(cids: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``cid`` and ``shingles`` (its set, packed) of the classes asked for, and perhaps others of the same rows."""
    wanted = _written(cids.join(reps, "cid").select("rep").distinct(), "wanted")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
             .join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi"))

    def collected(batches):
        for batch in tk.returning_memory(batches):
            found, blobs = [np.zeros(0, np.int64)], []
            for _, sets, bounds in _sets_of(batch.column("text"), k):
                full = np.flatnonzero(np.diff(bounds))
                if len(full):
                    found.append(_set_ids(sets, bounds[:-1][full]).view(np.int64))
                    blobs += [sets[bounds[d]:bounds[d + 1]].tobytes() for d in full]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(blobs, pa.binary())],
                                             ["cid", "shingles"])

    return _written(texts.mapInArrow(collected, "cid long, shingles binary").dropDuplicates(["cid"]), "sets")


def common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes with the sizes of their sets, ``n`` and ``m``, and of the intersection, ``both``."""
    joined = (pairs.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")
              .join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a"))

    def compared(batches):
        for batch in tk.returning_memory(batches):
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = _numbers(x), _numbers(y)
                out[:, i] = len(x), len(y), _shared(x, y)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, out)],
                                             ["a", "b", "n", "m", "both"])

    return joined.select("a", "b", "sa", "sb").mapInArrow(compared, "a long, b long, n long, m long, both long")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _products(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of the sets at ``left`` with those at ``right``, a slab of shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    some = count[column] > 1
    owner, column = owner[some], (np.cumsum(count > 1) - 1)[column[some]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, SLAB):
        a, b = np.searchsorted(column, [lo, lo + SLAB])
        held = np.zeros((len(sets), SLAB), np.float32)
        held[owner[a:b], column[a:b] - lo] = 1
        out += held[left] @ held[right].T
    return out


def joining_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between two blocks (side 0 and 1), or within one (side 0 alone), that join different labels: enough of
    them to join all labels that any link joins."""
    side, cid, label = (table[c].to_numpy() for c in ("side", "cid", "label"))
    sets = [_numbers(x) for x in table["shingles"]]
    size = np.array([len(x) for x in sets])
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    alone = right is left
    if alone and len(set(label.tolist())) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    same = _products(sets, left, right) if len(sets) > 2 else np.array(
        [[_shared(sets[i], sets[j]) for j in right] for i in left], np.float32).reshape(len(left), len(right))
    union = size[left][:, None] + size[right][None, :] - same
    good = (100 * same >= percent * union) & (label[left][:, None] != label[right][None, :])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(good)):
        x, y = find(int(label[left[i]])), find(int(label[right[j]]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(cid[left[i]]), int(cid[right[j]])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def links_across(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join labels within groups (columns gid, cid, n, label; a class once a group).

    A group's members of its most frequent label are its main part, the others the rest; each part is dealt to
    blocks of about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles, and rest blocks meet each other and main blocks.
    """
    by_label = groups.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    parts = (by_label.groupBy("gid").agg(F.max(F.struct("c", "s", "label")).alias("top"), F.sum("c").alias("c"),
                                         F.sum("s").alias("s"), F.count(F.lit(1)).alias("labels"))
             .where("labels > 1"))

    def blocks(c, s):
        return F.greatest(F.ceil(c / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")

    parts = parts.select("gid", F.col("top.label").alias("main"), blocks(F.col("top.c"), F.col("top.s")).alias("mains"),
                         blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("rests"))
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("label") == F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    rows = groups.join(parts, "gid").withColumn("own", own).join(sets, "cid")
    mains, rests = F.sequence(F.lit(0), F.col("mains") - 1), F.sequence(F.lit(0), F.col("rests") - 1)

    def meet(kind, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    o = F.col("own")
    met = F.when(F.col("label") == F.col("main"), F.transform(rests, lambda i: meet(0, i, o, F.lit(1)))).otherwise(F.concat(
        F.transform(mains, lambda j: meet(0, o, j, F.lit(0))),
        F.transform(rests, lambda j: meet(1, F.least(o, j), F.greatest(o, j), o > j))))
    rows = rows.select("gid", "cid", "label", "shingles", F.explode(met).alias("met")).select(
        F.xxhash64("gid", "met.kind", "met.i", "met.j").alias("pair"), "met.side", "cid", "label", "shingles")
    return rows.groupBy("pair").applyInArrow(lambda table: joining_links(table, percent), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """``cid``, ``label`` (smallest class of the component) of every class with an edge.

    Each round takes the smallest label around a class, then the label of that label; rounds are written to
    the shared folder, and their number grows with the logarithm of a component's width.
    """
    both = _written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = _written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                      .withColumnRenamed("a", "cid"), "labels")
    while True:
        around = (both.join(labels.select(F.col("cid").alias("b"), "label"), "b").groupBy("a")
                  .agg(F.min("label").alias("near")))
        moved = (labels.join(around, labels["cid"] == around["a"])
                 .select("cid", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("cid").alias("label"), F.col("label").alias("next"))
        moved = moved.join(jump, "label", "left").select(
            "cid", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        labels = _written(moved, "labels")
        if not labels.where("old <> label").limit(1).count():
            return labels.select("cid", "label")


def near_groups(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id that links reach, itself included.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased. Rows without words or text link with nothing. Rows with
    a null id take part; their component is named by its smallest other id, or null. Rows that repeat an id get the
    same component if their texts link, and each its own row. An empty table gives an empty result.
    """
    tk.small_batches(docs.sparkSession)
    every = _written(sketch(docs, id_col, text_col, k), "sketch")
    member = every.where("cid is not null").select(F.explode("keys").alias("key"), "cid", F.col("n_shingles").alias("n"))
    heads = (member.groupBy("key").agg(F.min("cid").alias("head"), F.max("cid").alias("last"))
             .where("head <> last").select("key", "head"))
    shared = _written(member.join(heads, "key").groupBy("key", "head", "cid", "n").agg(F.lit(1).alias("one")).drop("one"),
                      "shared")
    reps = every.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("rep"))
    sets = class_sets(shared.select("cid").distinct(), reps, docs, id_col, text_col, k)
    star = shared.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct()
    star = _written(common(star, sets).withColumn("union", F.expr("n + m - both")), "star")
    links = star.where(100 * F.col("both") >= percent * F.col("union")).select("a", "b")
    labels = connected(links)
    close = star.where(2 * F.col("both") >= F.col("union"))
    around = (close.select(F.col("a").alias("gid"), F.col("b").alias("cid"), F.col("m").alias("n"))
              .union(close.select("a", "a", "n").distinct()).withColumn("kind", F.lit(0)))
    # nearer to the head than this, all links are around the head
    inner = star.where(100 * F.col("both") >= (150 - percent) * F.col("union")).select(F.col("a").alias("head"), F.col("b").alias("cid"))
    far = (shared.where("cid <> head").join(inner, ["head", "cid"], "left_anti")
           .select(F.col("key").alias("gid"), "cid", "n").withColumn("kind", F.lit(1)))
    groups = (around.union(far).join(labels, "cid", "left")
              .select(F.xxhash64("kind", "gid").alias("gid"), "cid", "n", F.coalesce("label", "cid").alias("label")))
    more = _written(links_across(groups, sets, percent), "links")
    labels = connected(links.union(more))
    groups = reps.join(labels, "cid", "left").select("cid", "rep", F.coalesce("label", "cid").alias("label"))
    named = groups.join(groups.groupBy("label").agg(F.min("rep").alias("component")), "label").select("cid", "component")
    return (every.drop("keys").join(named, "cid", "left")
            .select("doc_id", "n_shingles", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component"))
                    .alias("component_id")))


def drop_near_copies(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                     k: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group left, that with the smallest id; columns as in ``docs``.

    Rows without words, and rows with a null id, stay. Rows that repeat the id that stays all stay.
    """
    gone = _written(near_groups(docs, percent, id_col, text_col, k).where("doc_id <> component_id")
                    .select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    plain, names = tk.plainly_named(docs)
    return plain.join(gone, F.col(names[id_col]).cast("long") == F.col("__gone"), "left_anti").select(*tk.named_back(names))
