"""S7 bucketed: the fact table hashed and sorted by its key into a fixed number of files, so that a merge on the key
(J7, R2) moves only the batch.

Spark knows buckets through a table definition, not through the files. ``read_buckets`` states the definition for a
folder, so any session can open what another one wrote; definitions live as long as the session's catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import schemas as S
from letwise.operators.upsert import evolve_schema, merge_prepared, prepare_batch


def _name() -> str:
    return f"letwise_buckets_{uuid.uuid4().hex[:12]}"


def read_buckets(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The bucketed table in a folder that ``write_buckets`` wrote with as many buckets."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.TABLE_SCHEMA.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({S.KEY}) SORTED BY ({S.KEY}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_buckets(rows: DataFrame, path: str, buckets: int, placed: bool = False) -> None:
    """Write table rows as ``buckets`` sorted files. Rows that do not lie by bucket yet are moved once; with ``placed``
    they already do, as after a merge with a table of as many buckets, and are written where they are."""
    rows = rows if placed else rows.repartition(buckets, S.KEY)
    name = _name()
    rows.write.option("path", path).bucketBy(buckets, S.KEY).sortBy(S.KEY).format("parquet").saveAsTable(name)


def create(table: DataFrame, path: str, buckets: int) -> None:
    """The first version of a bucketed table, from rows that may lack columns (M4)."""
    write_buckets(evolve_schema(table), path, buckets)


def merged_buckets(spark: SparkSession, path: str, buckets: int, batch: DataFrame,
                   order_cols: Sequence[str] = ("scrape_date", "load_key"), guard_late: bool = True) -> DataFrame:
    """The upsert (M1) of a batch into a bucketed table: the batch is reduced to one row a key and then hashed to the
    buckets, whatever their number; the table side is read bucket by bucket without an exchange."""
    prepared = prepare_batch(batch, order_cols).where(F.col(S.KEY).isNotNull()).repartition(buckets, S.KEY)
    return merge_prepared(read_buckets(spark, path, buckets), prepared, order_cols, guard_late)


def merge_buckets(spark: SparkSession, path: str, next_path: str, buckets: int, batch: DataFrame,
                  order_cols: Sequence[str] = ("scrape_date", "load_key"), guard_late: bool = True) -> None:
    """Write the next version of a bucketed table, a file a bucket: the table is read and written, never shuffled."""
    write_buckets(merged_buckets(spark, path, buckets, batch, order_cols, guard_late), next_path, buckets, placed=True)
