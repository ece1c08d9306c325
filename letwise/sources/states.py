"""S7 with partitions: the fact table as one Parquet folder per state, of which a load rewrites only those it touches.

Layout: ``<root>/state_part=<name>/part-*.parquet``. ``state_part`` is a folder-safe name of the state (P11; ``type``
stands for none); the state itself stays in the rows, so states that share a name only share a folder. Rows also hold
``content_hash``, the hash of the columns that the content rule compares.

Folders are replaced by Spark's dynamic partition overwrite: rows are written to a staging folder first and moved when
all tasks are done. There is no log. A load that dies while folders are being moved is mended by running it again:
merging the same batch twice gives the same table. The table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from letwise import constants as K
from letwise import functions as LF
from letwise import schemas as S
from letwise.session import literal_frame

PART = "state_part"
HASH = "content_hash"
STORED = T.StructType([*S.TABLE_SCHEMA.fields, T.StructField(HASH, T.LongType(), True), T.StructField(PART, T.StringType(), True)])


def part_of(state) -> Column:
    """The folder name of a state."""
    return LF.slug(F.coalesce(F.col(state) if isinstance(state, str) else state, F.lit("")))


def content_hash() -> Column:
    """A hash of the content columns. Equal content has equal hashes; who compares content must still compare the
    columns, for different content may share a hash."""
    return F.xxhash64(*[F.col(c) for c in K.CONTENT_DEDUP_COLUMNS])


def to_stored(table: DataFrame) -> DataFrame:
    """Table rows with their content hash and folder."""
    return table.select(*S.TABLE_COLUMNS, content_hash().alias(HASH), part_of("state").alias(PART))


def read_stored(spark: SparkSession, root: str, parts: Iterable[str] | None = None) -> DataFrame:
    """The stored rows, all or those of some folders (a partition filter: other folders are not read). A table that
    was never written is empty; any other failure to read it is raised."""
    try:
        df = spark.read.schema(STORED).parquet(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = literal_frame(spark, [], STORED).where(F.lit(False))
    return df if parts is None else df.where(F.col(PART).isin(*parts))


def read_states(spark: SparkSession, root: str, states: Iterable[str] | None = None) -> DataFrame:
    """The table, all of it or some states: only the folders of these states are read."""
    if states is None:
        return read_stored(spark, root).select(*S.TABLE_COLUMNS)
    wanted = list(states)
    names = [r[0] for r in literal_frame(spark, [(s,) for s in wanted], "state string").select(part_of("state")).collect()]
    return read_stored(spark, root, names).where(F.col("state").isin(*wanted)).select(*S.TABLE_COLUMNS)


def overwrite_parts(rows: DataFrame, root: str) -> None:
    """Replace the folders of all states that ``rows`` (stored rows) hold, and no others."""
    (rows.select(*STORED.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART).parquet(root))


def empty_part(spark: SparkSession, root: str, part: str) -> None:
    """Leave a folder without rows (an overwrite without rows of a folder would not touch it)."""
    schema = T.StructType([f for f in STORED.fields if f.name != PART])
    literal_frame(spark, [], schema).where(F.lit(False)).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{PART}={part}")
