"""Ranked lexical search over a length-stratified index.

A document's score for a term depends on its length only through the normaliser m, so documents of equal m form a
stratum. In a stratum the postings of a term lie in runs of equal tf, highest first: the impact of a tf is computed
once for its run, and the first run's impact bounds the term in the whole stratum. The sum of these bounds over a
query's terms orders the strata; a query visits them from the highest bound and stops once no stratum left can reach
its k-th score.

Tokens are counted in one pass over the texts, for the terms that the queries hold; from then on only those counts
move. ``build_index`` groups them by stratum (large ones in pieces) into blocks of bounded size, one row a stratum;
``search`` answers all queries in each block and merges with a ranked window, which Spark limits before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from letwise.llm.textkit import chunks, returning_memory, small_batches, utf8
from letwise.session import scratch_path, ship_package

SLICE_BYTES = 4 << 20
BLOCK_POSTINGS = 2_000_000
CHUNK = 4 << 20
FIRST_DOCS = 256
SALTS = 64
UNIT = 1_000_000_000

_SEPARATOR = np.zeros(256, bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _SEPARATOR[_lo:_hi + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

COUNTS = "n long, terms array<int>, tfs array<int>"
INDEX = ("block int, m long, docs array<long>, terms array<int>, runs array<int>, run_tf array<int>, run_docs array<int>, "
         "places array<int>")


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of a chunk of texts in order, A-Z lower-cased, and each text's first term plus the total."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~_SEPARATOR[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    packed = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(_LOWER[data[word]]))
    return packed, np.searchsorted(start, offsets)


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and sizes of a column of lists without nulls."""
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values).cast(kind))


def term_counts(ids: pa.Array, texts: pa.Array, vocabulary: pa.Array) -> Iterator[pa.RecordBatch]:
    """``id, n, terms, tfs`` of each text: its number of terms, and the places in ``vocabulary`` of those it holds
    with their occurrences."""
    data, offsets = utf8(texts)
    size = len(vocabulary)
    for i, j in chunks(offsets, CHUNK):
        part = offsets[i:j + 1]
        words, first = tokens(data[part[0]:part[-1]], part - part[0])
        places = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(places >= 0)
        doc = np.searchsorted(first, known, "right") - 1
        pairs, tf = np.unique(doc * size + places[known], return_counts=True)
        lists = np.searchsorted(pairs, np.arange(j - i + 1, dtype=np.int64) * size)
        yield pa.RecordBatch.from_arrays(
            [ids.slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
             _lists(pairs % max(size, 1), lists, pa.int32()), _lists(tf, lists, pa.int32())], names=["id", "n", "terms", "tfs"])


def distinct_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id`` and ``terms``: the distinct terms of every query, by the tokens of the index. Rows that repeat an id
    are one query; rows without an id, or without a term, are none."""
    schema = queries.select(F.col(id_col).alias("item_id")).schema

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            words, first = tokens(data[offsets[0]:offsets[-1]], offsets - offsets[0])
            of = np.repeat(np.arange(len(b)), np.diff(first))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of)), words.cast(pa.string())], names=["item_id", "term"])

    words = (queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
             .mapInArrow(split, schema.add("term", "string")))
    return words.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


@dataclass
class Index:
    """Strata of the terms of ``vocabulary`` over all documents: rows (``INDEX``), N, L, and df of each term."""

    strata: DataFrame
    vocabulary: list[str]
    documents: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        """floor(1000 * ln((2 N + 2) / (2 df + 1))) of each term."""
        return np.floor(1000 * np.log((2 * self.documents + 2) / (2 * self.df + 1))).astype(np.int64)


def _stratum(m: int, docs: np.ndarray, place: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple:
    """A row of the index, from its postings: terms ascending, in each the runs of equal tf descending, in each the
    documents' places."""
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    new_run = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]) if len(term) else np.zeros(0, np.int64)
    run_term = term[new_run]
    new_term = np.flatnonzero(np.r_[True, run_term[1:] != run_term[:-1]]) if len(run_term) else np.zeros(0, np.int64)
    return (m, docs, run_term[new_term], np.diff(np.r_[new_term, len(new_run)]), tf[new_run], np.diff(np.r_[new_run, len(term)]), place)


def build_index(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text",
                block_postings: int = BLOCK_POSTINGS) -> Index:
    """The length-stratified index of ``vocabulary`` (sorted, bounded by the caller) over every document.

    A null text has no terms. Rows that repeat an id are documents of their own; rows without an id count in N, L and
    df but are not in the strata. Other columns are not read. An empty table gives an empty index.

    A stratum with more than an eighth of a block's postings is dealt into pieces, so a length that a third of all
    documents share is no hot group. The table of strata sizes has a row for each m, as many as there are different
    lengths at most."""
    spark = docs.sparkSession
    small_batches(spark)
    ship_package(spark)
    words = pa.array(vocabulary, pa.large_string())
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in returning_memory(batches):
            yield from term_counts(b.column(0), b.column(1), words)

    path = scratch_path(spark, "term-counts")
    chosen.mapInArrow(count, f"id long, {COUNTS}").write.parquet(path)
    counted = spark.read.parquet(path)
    total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length"),
                        F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]

    m = F.expr(f"50 + (50 * n * {total['docs']}L) div {max(1, total['length'])}L")
    held = counted.where(F.col("id").isNotNull() & (F.size("terms") > 0)).select("*", m.alias("m"))
    sizes = held.groupBy("m").agg(F.ceil(F.sum(F.size("terms")) / F.lit(max(1, block_postings // 8))).alias("pieces"))
    blocks = max(1, -(-total["postings"] // block_postings))
    # a length that many documents share would be one hot key of the join; salted, it is many
    salted = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = (held.withColumn("spread", F.xxhash64("id", F.monotonically_increasing_id()))
             .withColumn("salt", F.pmod(F.shiftright("spread", 32), F.lit(SALTS)).cast("int")).join(salted, ["m", "salt"])
             .select("m", "id", "terms", "tfs", F.pmod("spread", "pieces").alias("piece"))
             .withColumn("block", F.pmod(F.xxhash64("m", "piece"), F.lit(blocks)).cast("int")))

    def stratify(table: pa.Table) -> pa.Table:
        ms, pieces = table["m"].to_numpy(), table["piece"].to_numpy()
        ids = table["id"].to_numpy()
        order = np.lexsort((ids, pieces, ms))
        cut = np.flatnonzero(np.r_[True, (np.diff(ms[order]) != 0) | (np.diff(pieces[order]) != 0), True])
        (terms, size), (tfs, _) = _flat(table["terms"]), _flat(table["tfs"])
        first = np.r_[0, np.cumsum(size)]
        rows = []
        for own in (order[a:b] for a, b in zip(cut[:-1], cut[1:])):
            held, place = spans(first, own)
            rows.append(_stratum(int(ms[own[0]]), ids[own], place, terms[held], tfs[held]))
        columns = [pa.array(np.full(len(rows), table["block"][0].as_py(), np.int32)), pa.array([r[0] for r in rows], pa.int64())]
        for i, kind in enumerate((pa.int64(), *[pa.int32()] * 5), 1):
            columns.append(_lists(np.concatenate([r[i] for r in rows]), np.r_[0, np.cumsum([len(r[i]) for r in rows])], kind))
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in INDEX.split(", ")])

    path = scratch_path(spark, "strata")
    dealt.groupBy("block").applyInArrow(stratify, INDEX).write.parquet(path)
    return Index(spark.read.parquet(path), vocabulary, total["docs"], total["length"], df)


class Strata:
    """The strata of one block as flat arrays: entries (a term in a stratum), their runs, the runs' documents."""

    def __init__(self, table: pa.Table, terms: int):
        m = table["m"].to_numpy()
        self.docs, n_docs = _flat(table["docs"])
        self.doc_first = np.r_[0, np.cumsum(n_docs)]
        entry_term, n_entries = _flat(table["terms"])
        self.stratum = np.repeat(np.arange(len(m)), n_entries)
        n_runs, _ = _flat(table["runs"])
        self.run_first = np.r_[0, np.cumsum(n_runs)]
        tf, _ = _flat(table["run_tf"])
        run_stratum = np.repeat(self.stratum, n_runs)
        self.impact = UNIT * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 20 * m[run_stratum])
        run_docs, _ = _flat(table["run_docs"])
        self.place_first = np.r_[0, np.cumsum(run_docs)]
        places, n_places = _flat(table["places"])
        self.places = places + np.repeat(self.doc_first[:-1], n_places)
        self.entries = np.argsort(entry_term, kind="stable")
        self.term_first = np.searchsorted(entry_term[self.entries], np.arange(terms + 1))
        self.best = self.impact[self.run_first[:-1]]
        self.scores = np.zeros(len(self.docs), np.int64)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores above 0 of the ``k`` best documents for a query, ties to the smaller id, and the strata visited."""
        own = [self.entries[self.term_first[t]:self.term_first[t + 1]] for t in terms]
        entry, weight = np.concatenate(own), np.repeat(weights, [len(x) for x in own])
        bound = np.zeros(len(self.doc_first) - 1, np.int64)
        np.add.at(bound, self.stratum[entry], weight * self.best[entry])
        visit = np.argsort(-bound, kind="stable")
        visit = visit[:np.count_nonzero(bound)]
        rank = np.empty(len(bound), np.int64)
        rank[visit] = np.arange(len(visit))
        at = rank[self.stratum[entry]]
        by = np.argsort(at, kind="stable")
        entry, weight, at = entry[by], weight[by], at[by]
        met = np.cumsum(np.diff(self.doc_first)[visit])
        ids, scores, lo, docs = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST_DOCS
        while lo < len(visit) and not (len(ids) == k and bound[visit[lo]] < scores[-1]):
            hi = max(lo + 1, int(np.searchsorted(met, (met[lo - 1] if lo else 0) + docs, "right")))
            some = slice(*np.searchsorted(at, (lo, hi)))
            runs, of = spans(self.run_first, entry[some])
            places, run_of = spans(self.place_first, runs)
            np.add.at(self.scores, self.places[places], (weight[some][of] * self.impact[runs])[run_of])
            seen, _ = spans(self.doc_first, visit[lo:hi])
            got = self.scores[seen]
            self.scores[seen] = 0
            least = scores[-1] if len(ids) == k else 1
            seen, got = seen[got >= least], got[got >= least]
            if len(got) > k:
                high = got >= np.partition(got, len(got) - k)[len(got) - k]
                seen, got = seen[high], got[high]
            ids, scores = np.r_[ids, self.docs[seen]], np.r_[scores, got]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            lo, docs = hi, docs * 2
        return ids, scores, lo


def spans(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the spans ``first[i] .. first[i + 1]`` of each ``which`` one after another, and whose each is."""
    size = first[which + 1] - first[which]
    of = np.repeat(np.arange(len(which)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + first[which][of], of


def query_slices(terms: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[list]:
    """The queries (rows of ``item_id`` and ``terms``) in slices whose terms take at most ``slice_bytes``, one query at
    least. Only one slice is on the driver at a time."""
    held, size = [], 0
    for r in terms.toLocalIterator():
        more = sum(len(t) for t in r["terms"]) + 8 * len(r["terms"])
        if held and size + more > slice_bytes:
            yield held
            held, size = [], 0
        held.append(r)
        size += more
    if held:
        yield held


def search(index: Index, queries: list, k: int, item_type: str) -> DataFrame:
    """item_id, doc_id and score of the ``k`` best documents of each block for every query of a slice."""
    place = {t: i for i, t in enumerate(index.vocabulary)}
    weights, size = index.weights(), len(index.vocabulary)
    asked = []
    for r in queries:
        own = np.array([place[t] for t in r["terms"]], np.int64)
        asked.append((r["item_id"], own[weights[own] > 0], weights[own][weights[own] > 0]))
    kind = pa.string() if item_type == "string" else pa.int64()

    def answer(table: pa.Table) -> pa.Table:
        strata = Strata(table, size)
        out = []
        for item, own, weight in asked:
            if len(own):
                ids, scores, _ = strata.top(own, weight, k)
                out.append((item, ids, scores))
        return pa.table({"item_id": pa.array([x for x, ids, _ in out for _ in ids], kind),
                         "doc_id": pa.array(np.concatenate([np.zeros(0, np.int64), *[x for _, x, _ in out]])),
                         "score": pa.array(np.concatenate([np.zeros(0, np.int64), *[x for _, _, x in out]]))})

    return index.strata.groupBy("block").applyInArrow(answer, f"item_id {item_type}, doc_id long, score long")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents with the highest scores above 0 for every query,
    all if fewer; ties go to the smaller doc_id, and rows that repeat a document are ranked one by one.

    Queries without an id or a term give no rows. Ids of queries are whole numbers or texts, ids of documents whole
    numbers. Queries go in slices of bounded size; each slice has an index of its own terms, so what a task holds
    does not grow with the number of queries."""
    spark = docs.sparkSession
    ship_package(spark)
    item_type = "string" if dict(queries.dtypes)[item_col] == "string" else "long"
    terms = distinct_terms(queries.withColumn(item_col, F.col(item_col).cast(item_type)), item_col, item_text)
    path = scratch_path(spark, "query-terms")
    terms.write.parquet(path)
    found = None
    for held in query_slices(spark.read.parquet(path), slice_bytes):
        index = build_index(docs, sorted({t for r in held for t in r["terms"]}), id_col, text_col)
        part = search(index, held, k, item_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"item_id {item_type}, doc_id long, score long")
    best = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


RANKED_SQL = r"""
WITH low AS (SELECT doc_id, row_number() OVER () AS r, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM low WHERE t IS NOT NULL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
x AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0 AND doc_id IS NOT NULL)
WHERE rank <= 50
"""
