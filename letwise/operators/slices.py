"""Slice handling: union of per-slice pulls (U1/S9), slice selection (W7) and state
key validation (W8)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letwise import constants as K
from letwise import functions as LF
from letwise.operators.dedup import first_per_key
from letwise.session import literal_frame


def combine_slices(frames: Sequence[DataFrame], key: str = "ads_id", order_col: str | None = None) -> DataFrame:
    """U1 + D1: bag union of per-slice frames whose columns may differ (missing -> NULL),
    then one row per key: the one from the earliest slice (and, within it, the smallest
    ``order_col`` when given). Adds ``slice_no``."""
    tagged = [f.withColumn("slice_no", F.lit(i)) for i, f in enumerate(frames)]
    union = tagged[0]
    for f in tagged[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    order = ["slice_no"] + ([order_col] if order_col else [])
    return first_per_key(union, [key], order)


def region_dimension(spark: SparkSession) -> DataFrame:
    """The fixed (state slug, region code) dimension."""
    return literal_frame(spark, sorted(K.REGION_CODES.items()), "state_key string, region_code string")


def type_dimension(spark: SparkSession) -> DataFrame:
    """The fixed (type id, type name) dimension of residential slices."""
    return literal_frame(spark, sorted(K.RESIDENTIAL_PROPERTY_TYPE_IDS.items()), "type_id int, type_name string")


def with_slice_names(df: DataFrame, state_col: str = "state", type_col: str = "property_type_id") -> DataFrame:
    """``df`` with ``region_code`` and ``type_name`` of each row's slice. States are compared as W8 does, types
    by their id; what a dimension does not know, null and blank values among it, gets null, and no row is lost. Columns
    of these two names are replaced. Both dimensions are literals of the plan, so Spark broadcasts them."""
    spark = df.sparkSession
    regions = region_dimension(spark).withColumnRenamed("state_key", "_state_key")
    types = type_dimension(spark).select(F.col("type_id").cast("string").alias("_type_id"), "type_name")
    rows = df.drop("region_code", "type_name")
    return (rows.join(regions, LF.normalise_state(state_col) == F.col("_state_key"), "left")
            .join(types, F.trim(F.col(type_col).cast("string")) == F.col("_type_id"), "left")
            .select(*[F.col(f"`{c}`") for c in rows.columns], "region_code", "type_name"))


def ordered_types(types: DataFrame) -> DataFrame:
    """L2: a type dimension (type_id, type_name) in the order in which slices run, by id, with its place from 1.
    The window has no partition: it is for the dimension, a row a type, not for listings."""
    return types.withColumn("place", F.row_number().over(Window.orderBy("type_id"))).orderBy("place")


def write_combined(frame: DataFrame, path: str, by: str = "state") -> None:
    """The combined snapshot as Parquet, a folder a state (the fixed state list bounds their number)."""
    frame.write.mode("overwrite").partitionBy(by).parquet(path)


def select_slices(df: DataFrame, state_col: str = "state", states: Iterable[str] | None = None,
                  type_col: str = "property_type_id", type_ids: Iterable[int] | None = None) -> DataFrame:
    """One state or all; all types or a subset. Literal ``isin`` lists, so Parquet
    partition pruning applies when the columns are partition columns."""
    out = df
    if states is not None:
        out = out.where(LF.normalise_state(state_col).isin(*[s.strip().lower() for s in states]))
    if type_ids is not None:
        out = out.where(F.col(type_col).cast("string").isin(*[str(t) for t in type_ids]))
    return out


def unknown_states(df: DataFrame, state_col: str = "state") -> DataFrame:
    """Distinct normalised state keys that the region dimension does not know."""
    dim = region_dimension(df.sparkSession)
    keys = df.select(LF.normalise_state(state_col).alias("state_key")).distinct()
    return keys.join(dim, "state_key", "left_anti")


def validate_states(df: DataFrame, state_col: str = "state") -> None:
    """Raise when any state key is unknown, with how many there are and the smallest one; the whole
    report is ``unknown_states``."""
    row = unknown_states(df, state_col).agg(F.count(F.lit(1)).alias("n"), F.min("state_key").alias("first")).first()
    if row["n"]:
        raise ValueError(f"{row['n']} state keys are not in the region table, such as {row['first']!r}")
