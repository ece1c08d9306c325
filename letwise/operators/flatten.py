"""Flattening of search-page items into the flat listing row (P1-P7, S1 output)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letwise import functions as LF
from letwise import schemas as S


def _text(a: str):
    """``str(a.get(x, ''))``: the attribute's text, ``''`` when absent."""
    return F.coalesce(F.col(f"a.{a}").cast("string"), F.lit(""))


def _joined(a: str):
    """P2 ``_join``: list -> ``', '``-joined text, scalar -> text, missing -> ``''``."""
    return LF.list_or_scalar_text(F.col(f"a.{a}"))


def item_to_row(items: DataFrame, item_col: str = "item") -> DataFrame:
    """One ``select`` turning each item struct ``{id, attributes{...}}`` into the 19
    listing fields (all text). Other columns of ``items`` are carried along."""
    carry = [c for c in items.columns if c != item_col]
    return _rows(items.select(*carry, F.col(f"{item_col}.attributes").alias("a")), carry, _joined)


def variant_to_row(items: DataFrame, item_col: str = "item") -> DataFrame:
    """P1 + P2 on Variant items (``files.variant_items``): a value is known to be a list or a scalar from the parse, so no
    list is printed and parsed again, and a scalar text that begins with ``[`` stays as it is. Numbers are printed in
    plain decimal form (``3.0`` as ``3``)."""
    carry = [c for c in items.columns if c != item_col]
    text = [F.try_variant_get(item_col, f"$.attributes.{c}", "string").alias(c) for c in S.ITEM_ATTRIBUTES]
    lists = [F.array_join(F.try_variant_get(item_col, f"$.attributes.{c}", "array<string>"), ", ").alias(c) for c in S.ITEM_ATTRIBUTES]

    def joined(a: str):
        return F.coalesce(F.col(f"lists.{a}"), F.col(f"a.{a}"), F.lit(""))

    rows = items.select(*carry, F.struct(*text).alias("a"), F.struct(*lists).alias("lists"))
    return _rows(rows, carry, joined)


def _rows(a: DataFrame, carry: list[str], joined) -> DataFrame:
    """The listing fields from a struct ``a`` of attribute texts; ``joined`` gives an attribute with lists joined."""
    published = F.when(LF.is_present(F.col("a.published_date")), joined("published_date")).otherwise(joined("date"))
    fields = [
        _text("list_id").alias("ads_id"),
        LF.rent_label(F.col("a.price_label")).alias("monthly_rent"),
        joined("property_type_name").alias("property_type"),
        _text("property_type_id").alias("property_type_id"),
        LF.category_label(F.col("a.category_name")).alias("category_id"),
        joined("region_name").alias("state"),
        joined("subarea_name").alias("region"),
        _text("subarea_id").alias("subarea_id"),
        joined("rooms_name").alias("rooms"),
        joined("bathroom_name").alias("bathroom"),
        LF.size_label(F.col("a.size"), F.col("a.size_suffix")).alias("size"),
        LF.address(F.col("a.building_name"), F.col("a.subarea_name"), F.col("a.region_name")).alias("address"),
        joined("name").alias("seller_name"),
        _text("company_ad").alias("company_ad"),
        _text("ad_seller_type").alias("ad_seller_type"),
        joined("store_verified").alias("store_verified"),
        joined("ad_expiry").alias("ad_expiry"),
        published.alias("publishedDatetime"),
        joined("adview_url").alias("adviewUrl"),
    ]
    return a.select(*carry, *fields,
                    LF.geocode_query(F.col("a.building_name"), F.col("a.subarea_name"),
                                     F.col("a.region_name")).alias("geo_query"))


def stamp_run(df: DataFrame, run_date: str) -> DataFrame:
    """The run date, passed in (not the clock) so reruns give the same rows."""
    return df.withColumn("scrape_date", F.lit(run_date))


def to_raw(df: DataFrame) -> DataFrame:
    """The raw-file layout: every raw column as text, in fixed order (missing -> NULL)."""
    return df.select(*[
        (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
        for c in S.RAW_COLUMNS
    ])
