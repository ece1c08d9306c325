"""Readers and writers of landed files.

Every text input is read with an explicit all-string schema: no type inference, so a
column of integers with a gap never turns into ``'3.0'`` text (T4).
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letwise import constants as K
from letwise import functions as LF
from letwise import schemas as S
from letwise.operators.dedup import latest_per_key

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table ``<base>/<name>.parquet``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_page_log(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed search pages (JSON, one page per line unless ``multi_line``), a row a page: ``(page_file,
    page_total, data, _corrupt_record)``. A page that does not parse, or has no ``data``, keeps its text in
    ``_corrupt_record``; blank lines are no pages."""
    schema = T.StructType(S.PAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    text = (spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_name").alias("page_file"), "value").where(F.trim("value") != ""))
    page = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    text = text.withColumn("_page", page)
    bad = F.col(f"_page.{CORRUPT}").isNotNull() | F.col("_page.data").isNull()
    return text.select("page_file", F.col("_page.meta.`total-results`").alias("page_total"), F.col("_page.data").alias("data"),
                       F.when(bad, F.col("value")).alias(CORRUPT))


def page_items(log: DataFrame) -> DataFrame:
    """One row per item of the good pages: ``(page_file, page_total, item)``."""
    return (log.where(F.col(CORRUPT).isNull())
            .select("page_file", "page_total", F.explode("data").alias("item")))


def bad_pages(log: DataFrame) -> DataFrame:
    """The pages to quarantine: ``(page_file, _corrupt_record)``."""
    return log.where(F.col(CORRUPT).isNotNull()).select("page_file", CORRUPT)


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The items of landed search pages (see ``read_page_log`` for the pages that are not good)."""
    return page_items(read_page_log(spark, path, multi_line))


def variant_items(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """S1 with Variant: ``(items, bad pages)`` of landed pages. Items are ``(page_file, page_total, item)`` with the item
    as a Variant, whatever its fields; a page that does not parse, or has no list ``data``, is bad. The page is parsed
    once, and no schema of the attributes is needed."""
    text = (spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_name").alias("page_file"), "value").where(F.trim("value") != ""))
    page = text.withColumn("page", F.try_parse_json("value"))
    page = page.withColumn("data", F.try_variant_get("page", "$.data", "array<variant>"))
    items = page.where(F.col("data").isNotNull()).select(
        "page_file", F.try_variant_get("page", "$.meta['total-results']", "long").alias("page_total"), F.explode("data").alias("item"))
    return items, page.where(F.col("data").isNull()).select("page_file", F.col("value").alias(CORRUPT))


def list_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files under a folder, but for combined snapshots: ``(file, modified)``. Only names and times
    are read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
             .load(path).select(F.col("path").alias("file"), F.col("modificationTime").cast("string").alias("modified")))
    return files.where(~F.element_at(F.split("file", "/"), -1).contains(K.COMBINED_MARKER))


def csv_layouts(spark: SparkSession, paths: list[str]) -> dict[tuple[str, bool], list[str]]:
    """Paths of the files by their header line and by whether a line is always a record. It is unless a line has an odd
    number of quotes, as where a quoted field holds a line break, or a carriage return inside. Layouts are few; the list
    of paths is as long as the scan's own. One pass over the text, of which a row a file is kept."""
    text = spark.read.option("lineSep", "\n").text(paths)
    line, first = F.col("value"), F.col("_metadata.file_block_start") == 0
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    broken = (quotes % 2 == 1) | F.rtrim(F.regexp_replace(line, "\r$", "")).contains("\r")
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.when(first, F.monotonically_increasing_id()).alias("n"),
                        F.when(first, line).alias("value"), broken.alias("broken"))
    found: dict[tuple[str, bool], list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "n").alias("header"), F.max("broken").alias("broken")).collect():
        header = row["header"].lstrip("\ufeff").rstrip("\r")
        found.setdefault((header, not row["broken"]), []).append(unquote(row["file"]))
    return {h: sorted(found[h]) for h in sorted(found)}


def _read_csv_group(spark: SparkSession, header: str, paths: list[str], by_line: bool = False) -> DataFrame:
    """Files of one header: every listing column as text, by name (missing ones NULL), the corrupt record, and
    the file and place of each row. A file without the key column is corrupt row by row. Files of which every line is a
    record (``by_line``) are split into many tasks; a file with line breaks in fields is one task."""
    names = next(csv.reader([header]), [])
    fields = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*fields, CORRUPT]])
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
          .option("multiLine", not by_line).option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnPruning", False)  # a row is short or not whatever columns are asked for
          .option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    at = {name.strip(): c for c, name in reversed(list(zip(fields, names)))}
    corrupt = F.col(CORRUPT)
    if S.KEY not in at:
        corrupt = F.coalesce(corrupt, F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in fields]))
    columns = [(F.col(at[c]) if c in at else F.lit(None).cast("string")).alias(c) for c in CSV_COLUMNS]
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    # splits of a file may be read in any order, the rows of a split come in theirs
    place = F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0"),
                        F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    return df.select(*columns, corrupt.alias(CORRUPT), name.alias("source_file"), place.alias("load_key"))


CSV_COLUMNS = [*S.RAW_COLUMNS, "CPI"]


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw or processed listing CSVs (a folder, or a list of files), every column text and found by its
    header name, whatever the order; missing columns are NULL and unknown ones ignored.

    Files are read in groups of one header, so a file with another header never disturbs the rest, and apart by whether
    fields hold line breaks, so that all others are split. Combined
    snapshots (``_ALL_`` in the name) are skipped; rows whose every field is missing are dropped (W1); NA
    tokens become NULL (P10); rows that do not parse, short ones included, and rows of files without a key
    column are kept apart in ``_corrupt_record``. ``load_key`` has the file and place of each row."""
    from letwise.operators.clean import drop_all_missing
    paths = [r["file"] for r in list_csv(spark, path).collect()] if isinstance(path, str) else list(path)
    groups = [_read_csv_group(spark, h, files, by_line) for (h, by_line), files in csv_layouts(spark, paths).items()] if paths else []
    schema = ", ".join(f"{c} string" for c in [*CSV_COLUMNS, CORRUPT, "source_file", "load_key"])
    df = groups[0] if groups else spark.createDataFrame([], schema)
    for g in groups[1:]:
        df = df.unionByName(g)
    df = drop_all_missing(df, [*CSV_COLUMNS, CORRUPT], corrupt=CORRUPT)
    return df.select(*[LF.na_to_null(c).alias(c) for c in CSV_COLUMNS], CORRUPT, "source_file", "load_key")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def write_raw(df: DataFrame, path: str, partition_cols=("state", "property_type_id")) -> None:
    """Raw listing rows as CSV, one folder per (state, type) slice, appended.

    Every file carries the full raw header in fixed order, so later reads need no
    inference. Empty input writes nothing."""
    full = df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
                       for c in S.RAW_COLUMNS])
    (full.select(*S.RAW_COLUMNS, *[F.col(c).alias(f"slice_{c}") for c in partition_cols])
       .write.mode("append").option("header", True).option("escape", '"')
       .partitionBy(*[f"slice_{c}" for c in partition_cols]).csv(path))


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """The type mapping CSV (header, first column raw, second standard; a raw cell
    may hold several names on separate lines). Positional, all text."""
    return (spark.read.schema(S.MAPPING_SCHEMA).option("header", True)
            .option("multiLine", True).option("escape", '"').csv(path)
            .withColumn("_row", F.monotonically_increasing_id()))


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """Coordinate table (Parquet). Lookups take one row per query (``geo.one_per_query``)."""
    return spark.read.schema(S.GEO_SCHEMA).parquet(path)


def geo_from_json_object(df: DataFrame, text_col: str = "value") -> DataFrame:
    """S6 import: a JSON object text ``{query: [lat, lon], ...}`` -> rows ``(query, lat, lon)``;
    ``[null, null]`` is a cached miss."""
    m = F.from_json(F.col(text_col), "map<string,array<double>>")
    e = df.select(F.explode(m).alias("query", "pair"))
    return e.select("query", F.col("pair")[0].alias("lat"), F.col("pair")[1].alias("lon"))


def write_geo(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the coordinate table, one row per query."""
    one = latest_per_key(df.select("query", "lat", "lon"), ["query"], ["lat", "lon"])
    one.write.mode(mode).parquet(path)


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """Probe log (Parquet) ``(ads_id, checked_at, http_ok, n_items)``."""
    return spark.read.schema(S.PROBE_SCHEMA).parquet(path)
