"""Landed CSV files as records without a fixed header (S3, S11, S12, ST1): for streams, where files with their columns
in any order come through one source.

Files come as lines, so that a large one is split into many tasks. Where every line of a file is a record for certain,
its lines are cut into fields by built-in functions; any other file (line breaks in quoted fields, stray quotes) is
parsed as a whole, a file a task, by the CSV reader. A record has up to ``WIDTH`` text fields. The first record of a file
is its header, and the fields of the file's other records are found by the header's names. Of a micro-batch's lines, which
are staged as Parquet, only the paths of files to be parsed whole are collected; the headers are an aggregate of the
records with one row a file.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letwise import constants as K
from letwise import functions as LF
from letwise import schemas as S
from letwise.session import scratch_path
from letwise.sources.files import CORRUPT, CSV_COLUMNS

WIDTH = 64
FIELDS = [f"c{i}" for i in range(WIDTH)]
RECORD = T.StructType([T.StructField(c, T.StringType(), True) for c in [*FIELDS, CORRUPT]])


def n_fields() -> Column:
    """Fields of a record. The reader keeps the text of every record that has not exactly ``WIDTH`` fields; its
    separators outside of quotes are counted."""
    bare = F.regexp_replace(F.col(CORRUPT), '"[^"]*+"', "")
    return F.when(F.col(CORRUPT).isNull(), F.lit(WIDTH)).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1)


def record_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None) -> DataFrame:
    """ST1: the lines of CSV files that land below a folder, but for combined snapshots: ``file``, ``block`` (where the
    task's part of the file begins) and ``value``; ``staged_records`` makes records of them. With ``archive_dir`` a
    file moves there once the micro-batch that loaded it is committed (S12); the folder must lie outside of
    ``source_dir``."""
    r = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return r.text(source_dir).where(~name.contains(K.COMBINED_MARKER)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def _is_record(line: Column) -> Column:
    """Whether a line (one carriage return at its end aside) is a record whatever stands around it: no quotes but those
    around whole fields, all of them closed. A null character or bytes that are no UTF-8 are left to the CSV reader."""
    text = F.regexp_replace(line, "\r\\z", "")
    stray = F.regexp_replace(F.concat(F.lit(","), text), f",{_QUOTED}(?=,|\\z)", ",").contains('"')
    return F.is_valid_utf8(line) & ~text.contains("\r") & ~text.contains("\0") & ~(text.contains('"') & stray)


def _line_records(lines: DataFrame) -> DataFrame:
    """Records of files of which every line is one. Blank lines are none, as in the CSV reader."""
    line = F.col("line")
    cut = F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_QUOTED}|[^,]*)"), F.lit(1)), lambda x: F.when(
        x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    lines = lines.withColumn("line", F.regexp_replace("value", "\r\\z", "")).where("line <> ''")
    lines = lines.withColumn("cut", F.when(line.contains('"'), cut).otherwise(F.split(line, ","))).withColumn("n", F.size("cut"))
    fields = F.transform(F.slice("cut", 1, WIDTH), lambda x: F.when(x != "", x))
    return lines.select("file", "block", "at", fields.alias("fields"), "n", F.when(F.col("n") != WIDTH, F.rtrim(line)).alias("record"))


def _whole_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of files that the CSV reader parses as a whole, a file a task: quoted fields may hold line breaks."""
    r = (spark.read.schema(RECORD).option("header", False).option("multiLine", True).option("escape", '"')
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    records = r.csv(literal).withColumn("n", n_fields())
    return records.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("at"),
                          F.slice(F.array(*FIELDS), F.lit(1), F.least("n", F.lit(WIDTH))).alias("fields"), "n",
                          F.rtrim(F.regexp_replace(CORRUPT, r"[\r\n]+$", "")).alias("record"))


def _staged(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def staged_records(batch: DataFrame) -> DataFrame:
    """The records of a micro-batch of lines: ``file``, ``block`` and running number ``at`` (their order in the file),
    ``fields``, ``n`` and ``record``, from what is written below the checkpoint folder. A file is parsed as a whole
    if some line of it may not be a record, or if only some of its lines end with a carriage return."""
    spark = batch.sparkSession
    lines = _staged(batch.withColumn("at", F.monotonically_increasing_id())
                    .withColumn("plain", _is_record(F.col("value"))), "lines")
    ends = F.col("value").endswith("\r")
    whole = [r["file"] for r in lines.groupBy("file").agg(F.min("plain").alias("plain"), F.min(ends).alias("none"), F.max(ends).alias("some"))
             .where("not plain or none <> some").collect()]
    if not whole:
        return _line_records(lines)
    parsed = _staged(_whole_records(spark, [unquote(f) for f in whole]), "records")
    # a literal column of the few paths, not a join: they are as many as the micro-batch has files
    return _line_records(lines.where(~F.col("file").isin(whole))).unionByName(parsed)


def named_rows(records: DataFrame) -> DataFrame:
    """The rows of staged records, as ``read_raw_csv`` gives them: every listing column as text (missing ones NULL, NA
    tokens NULL), ``_corrupt_record``, ``source_file`` and ``load_key``. Records with another number of fields than
    their file's header, or with more than ``WIDTH``, and all records of a file without the key column are corrupt;
    rows whose every field is missing are dropped."""
    spark = records.sparkSession
    place = F.struct("block", "at")   # splits of a file may be read in any order, the lines of a split come in theirs
    first = records.groupBy("file").agg(F.min_by(F.struct("fields", "n"), place).alias("head"), F.min(place).alias("head_at"))
    names = F.transform("head.fields", lambda x: LF.strip(F.regexp_replace(F.coalesce(x, F.lit("")), "^\ufeff", "")))
    path = scratch_path(spark, "headers")
    (first.withColumn("names", names)
     .select(F.col("file").alias("head_file"), "head_at", F.col("head.n").alias("head_n"),
             F.array(*[F.array_position("names", c).cast("int") for c in CSV_COLUMNS]).alias("where"))
     .write.parquet(path))
    headers = spark.read.parquet(path)   # as a table of its own its size is known: one row a file of the micro-batch
    j = records.join(headers, records["file"] == headers["head_file"]).where(place != F.col("head_at"))
    # the listing columns of a record in order, still as one array: W1 is one small predicate on it
    values = F.transform("where", lambda p: F.when(p > 0, F.get("fields", p - 1)))
    values = F.transform(values, lambda v: F.when(~v.isin(*K.NA_TOKENS), v))
    bad = (F.col("n") != F.col("head_n")) | (F.col("n") > WIDTH) | (F.col("where")[CSV_COLUMNS.index(S.KEY)] == 0)
    text = F.coalesce("record", F.array_join("fields", ",", ""))
    rows = j.select(values.alias("values"), F.when(bad, text).alias(CORRUPT), "file", "block", "at")
    rows = rows.where(F.col(CORRUPT).isNotNull() | F.exists("values", lambda v: v.isNotNull()))
    return rows.select(*[F.col("values")[i].alias(c) for i, c in enumerate(CSV_COLUMNS)], CORRUPT,
                       F.element_at(F.split("file", "/"), -1).alias("source_file"),
                       F.concat_ws("#", "file", F.lpad(F.col("block").cast("string"), 15, "0"),
                                   F.lpad(F.col("at").cast("string"), 20, "0")).alias("load_key"))
