"""Line dedup by site-relative frequency: lines that too large a share of a host's pages hold go.

Pages are grouped by host; the share of a line is the number of the host's pages that contain it over the
number of the host's pages. Built-in functions only. Lines are counted by two 64-bit hashes after each
page's repeats are folded in the row, so the counting shuffle is pre-aggregated and a hot host or line
costs a row per task. The texts themselves are never shuffled when the table of boilerplate lines is
small: a host has at most (lines per page) / ratio such lines. That table is written to the shared
folder first, so that Spark knows its size and broadcasts it or not by its own threshold.

With ``copies_once`` copies of a page are not evidence of boilerplate: pages of a host with equal sets of lines
count once, and all pages of which ``CROWDED`` or more of the text is lines that many pages hold (near copies of
each other) count once together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letwise.llm.textkit import named_back, plainly_named
from letwise.session import scratch_path

RATIO = 0.01
MIN_PAGES = 3
CROWDED = 0.5


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(17), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    """A line as it is compared: without surrounding spaces, tabs and carriage returns."""
    return F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                      min_pages: int = MIN_PAGES) -> DataFrame:
    """``host``, ``lines`` (an array of line keys): lines that more than ``ratio`` of the host's pages hold, and at
    least ``min_pages`` pages. Blank lines are never counted. A null host is a host of its own."""
    host = F.struct(F.col(host_col).cast("string").alias("h"))
    total = docs.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(
        F.filter(F.transform(_lines(F.col(text_col)), _bare), lambda x: x != ""), _key))
    held = (docs.where(F.col(text_col).isNotNull()).select(host.alias("host"), F.explode(keys).alias("line"))
            .groupBy("host", "line").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= min_pages))
    return (held.join(total, "host").where(F.col("held") > ratio * F.col("pages"))
            .groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def boilerplate_beside_copies(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                              min_pages: int = MIN_PAGES) -> DataFrame:
    """As ``boilerplate_lines``, with copies of a page counted once.

    The sets of lines of the distinct pages are written to the shared folder, not their texts. Lines that many of
    these hold make a page a crowded one; the count is then taken again with all crowded pages of a host as one.
    """
    spark = docs.sparkSession
    host = F.struct(F.col(host_col).cast("string").alias("h"))
    bare = F.array_distinct(F.filter(F.transform(_lines(F.col(text_col)), _bare), lambda x: x != ""))
    lines = F.transform(bare, lambda x: F.struct(_key(x).alias("line"), F.length(x).alias("size")))
    each = (docs.where(F.col(text_col).isNotNull()).select(host.alias("host"), F.array_sort(lines).alias("lines"))
            .where(F.size("lines") > 0))
    page = F.struct(F.xxhash64("lines").alias("a"), F.xxhash64(F.lit(17), "lines").alias("b"))
    path = scratch_path(spark, "pages")
    each.groupBy("host", page.alias("page")).agg(F.first("lines").alias("lines")).write.parquet(path)
    pages = spark.read.parquet(path)

    def common(weighed: DataFrame) -> DataFrame:
        """``weighed``: pages with ``crowded``."""
        own, shared = F.sum(F.when(~F.col("crowded"), 1).otherwise(0)), F.max(F.col("crowded").cast("int"))
        total = weighed.groupBy("host").agg((own + shared).alias("pages"))
        held = (weighed.select("host", "crowded", F.explode("lines.line").alias("line"))
                .groupBy("host", "line").agg((own + shared).alias("held")).where(F.col("held") >= min_pages))
        found = (held.join(total, "host").where(F.col("held") > ratio * F.col("pages"))
                 .groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")))
        path = scratch_path(spark, "common")
        found.write.parquet(path)
        return spark.read.parquet(path)

    many = common(pages.withColumn("crowded", F.lit(False))).select(F.col("host").alias("__host"), F.col("lines").alias("__many"))

    def size(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + x["size"])

    shared = size(F.filter("lines", lambda x: F.array_contains(F.col("__many"), x["line"])))
    weighed = pages.join(many, F.col("host") == F.col("__host"), "left").select(
        "host", "lines", F.coalesce(shared >= CROWDED * size(F.col("lines")), F.lit(False)).alias("crowded"))
    return common(weighed)


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``docs`` with its boilerplate lines taken out of the text, and ``n_lines``, ``n_dropped`` (long) added.

    Every occurrence of a boilerplate line goes; what stays keeps its bytes and order, joined by newlines. A
    null text stays null (no lines), an empty text has one blank line and stays. Repeated rows are pages of
    their own unless ``copies_once``. Columns that are already called n_lines or n_dropped are replaced.
    """
    docs, names = plainly_named(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]))
    host_col, text_col = names[host_col], names[text_col]
    path = scratch_path(docs.sparkSession, "boilerplate")
    count = boilerplate_beside_copies if copies_once else boilerplate_lines
    count(docs, host_col, text_col, ratio, min_pages).write.parquet(path)
    found = docs.sparkSession.read.parquet(path).select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    host = F.struct(F.col(host_col).cast("string").alias("h"))
    lines = _lines(F.col(text_col))
    kept = F.when(F.col("__lines").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col("__lines"), _key(_bare(x)))))
    whole = F.when(F.col(text_col).isNotNull(), F.array_join("__kept", "\n"))
    return (docs.withColumn("__key", host).join(found, F.col("__key") == F.col("__host"), "left")
            .withColumn("__kept", kept)
            .select(*named_back(names, **{text_col: whole}),
                    F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long").alias("n_dropped")))


def boilerplate_sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """The same rule over ``documents`` in DuckDB SQL: doc_id, n_lines, n_dropped, text."""
    return f"""
WITH line AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS b FROM line),
total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
held AS (SELECT source, b, count(DISTINCT doc_id) AS held FROM bare WHERE b <> '' GROUP BY source, b),
bad AS (SELECT h.source, h.b FROM held h JOIN total t ON h.source IS NOT DISTINCT FROM t.source
        WHERE h.held >= {min_pages} AND h.held > {ratio!r} * t.pages),
kept AS (
  SELECT x.doc_id, count(*) AS n_lines, count(bad.b) AS n_dropped,
         string_agg(x.line, chr(10) ORDER BY x.pos) FILTER (bad.b IS NULL) AS text
  FROM bare x LEFT JOIN bad ON x.source IS NOT DISTINCT FROM bad.source AND x.b = bad.b
  GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
