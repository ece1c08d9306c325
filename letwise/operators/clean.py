"""The clean job: field cleaning, category exclusion and type standardisation.

Order of steps follows the source pipeline: drop all-null rows -> rent -> category strip
-> exclude -> size -> rooms -> published date, then the standard type (``CPI``).
Each step only touches a column when it is present, like the source.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import functions as LF
from letwise.session import literal_frame


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows where every column is NULL."""
    return df.dropna(how="all")


def drop_all_missing(df: DataFrame, columns=None, tokens=K.NA_TOKENS, corrupt: str | None = None) -> DataFrame:
    """W1 on raw text, before NA tokens are turned into NULL: drop rows where every
    column is NULL or an NA token (what a pandas read + ``dropna(how='all')`` drops). Rows with a ``corrupt``
    record stay.

    Written as one OR over the raw columns so it stays a small predicate: applied after
    the NA projection instead, the optimizer would push it below that projection and
    then rewrite it once per aliased column (exponential constraint growth)."""
    cols = [c for c in columns or df.columns if c != corrupt]
    keep = F.col(corrupt).isNotNull() if corrupt else None
    for c in cols:
        e = F.col(c).isNotNull() & ~F.col(c).isin(*tokens)
        keep = e if keep is None else keep | e
    return df.where(keep)


def exclude_categories(df: DataFrame, column: str = "category_id",
                       excluded: Iterable[str] = K.EXCLUDED_CATEGORIES) -> DataFrame:
    """F5 + W2: strip ``', For rent'`` (NULL becomes ``''``) and drop excluded categories.
    NULL/blank categories are kept (T2)."""
    out = df.withColumn(column, LF.strip_category(column))
    return out.where(~F.col(column).isin(*list(excluded)))


def mapping_dimension(spark: SparkSession, rows: Sequence[tuple[str | None, str | None]] = tuple(K.TYPE_MAPPING)) -> DataFrame:
    """The (key, std) dimension of literal rows, by the rule of ``build_mapping``; resolved when the plan is built,
    so that plans hold a few literal rows and no aggregate."""
    found: dict[str, str] = {}
    for raw, std in rows:
        if raw is not None and std is not None:
            found |= {piece.strip(): std for piece in raw.split("\n") if piece.strip()}
    return literal_frame(spark, list(found.items()), "key string, std string")


def build_mapping(mapping: DataFrame, order_col: str | None = None) -> DataFrame:
    """F10 + W6 + T24: rows with both fields present; the raw text is split on newlines,
    each piece stripped and blanks dropped; for a duplicated key the last row wins.
    Output: ``(key, std)``, one row per key."""
    if order_col is None:
        mapping = mapping.withColumn("_row", F.monotonically_increasing_id())
        order_col = "_row"
    valid = mapping.where(F.col("raw").isNotNull() & F.col("std").isNotNull())
    pieces = valid.select(
        F.col(order_col).alias("_row"), F.col("std").cast("string").alias("std"),
        F.posexplode(F.split(F.col("raw").cast("string"), "\n")).alias("_piece", "_raw"),
    ).select("_row", "_piece", "std", LF.strip("_raw").alias("key")).where(F.col("key") != "")
    return pieces.groupBy("key").agg(
        F.max_by(F.col("std"), F.struct("_row", "_piece")).alias("std"))


def standardise_type(df: DataFrame, mapping: DataFrame, column: str = "property_type",
                     out: str = "CPI", default: str = K.DEFAULT_STANDARD_TYPE) -> DataFrame:
    """Stripped raw type -> standard type by a left join to the mapping dimension;
    unmatched, blank or NULL -> ``default``. Matching is case-sensitive.

    No hint: Spark broadcasts the dimension when its size is known to be small, as that of the literal one is."""
    m = mapping.select(F.col("key").alias("_map_key"), F.col("std").alias("_map_std"))
    keyed = df.withColumn("_type_key", LF.strip(column))
    joined = keyed.join(m, keyed["_type_key"] == m["_map_key"], "left")
    std = F.when(F.col(column).isNull(), F.lit(default)).otherwise(F.coalesce(F.col("_map_std"), F.lit(default)))
    return joined.withColumn(out, std).drop("_type_key", "_map_key", "_map_std")


def clean_listings(df: DataFrame, mapping: DataFrame | None = None,
                   excluded: Iterable[str] = K.EXCLUDED_CATEGORIES, drop_empty_rows: bool = True) -> DataFrame:
    """The whole clean step on a raw listing frame (text columns). Pass
    ``drop_empty_rows=False`` when the source already dropped all-missing rows
    (``drop_all_missing``, done by the raw readers)."""
    cols = set(df.columns)
    out = drop_all_null(df) if drop_empty_rows else df
    if "monthly_rent" in cols:
        out = out.withColumn("monthly_rent", LF.clean_rent("monthly_rent"))
    if "category_id" in cols:
        out = exclude_categories(out, "category_id", excluded)
    if "size" in cols:
        out = out.withColumn("size", LF.clean_size("size"))
    if "rooms" in cols:
        out = out.withColumn("rooms", LF.clean_rooms("rooms"))
    if "publishedDatetime" in cols:
        out = out.withColumn("publishedDatetime", LF.publish_date("publishedDatetime"))
    if mapping is not None and "property_type" in cols:
        out = standardise_type(out, mapping, "property_type", "CPI")
    return out


def category_purge(table: DataFrame, column: str = "category_id",
                   excluded: Iterable[str] = K.EXCLUDED_CATEGORIES) -> DataFrame:
    """M6: one-shot removal of rows whose (already stripped) category is excluded.
    NULL categories are kept."""
    return table.where(F.col(column).isNull() | ~F.col(column).isin(*list(excluded)))

