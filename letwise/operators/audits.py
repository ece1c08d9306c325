"""Rent statistics, coverage and data-quality audits.

All aggregate partially before the shuffle. Means are
computed from an exact decimal sum so the result does not depend on the order in which
partitions are combined.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letwise import constants as K
from letwise.session import literal_frame


_EXACT = "decimal(32,8)"


def _exact(c: Column) -> Column:
    """A number as an exact decimal; NULL if it has more than 24 digits before the point."""
    return c.try_cast(_EXACT)


def exact_mean(c) -> Column:
    """Mean of a money column from an exact decimal sum: order-independent. Numbers too large for it
    are left out of sum and count; eight decimals count."""
    v = _exact(F.col(c) if isinstance(c, str) else c)
    n = F.count(v)
    return F.when(n > 0, F.try_sum(v).cast("double") / n)


def rent_summary(df: DataFrame, by: Sequence[str] = ("state",), value: str = "monthly_rent",
                 left_out: bool = False) -> DataFrame:
    """A1/A2/A3: listings, rows with a rent, mean and exact median rent per group; with ``left_out`` also the
    rents too large for the exact mean.

    Equal rents of a group are counted first, so all that follows works on distinct rents. The median is found in
    two steps: counts per range of rents (a fixed number of ranges) tell which range holds the middle, and only
    the rents of that range are then put in order. No task holds all rents of a group.
    """
    by = list(by)
    d = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col(value).alias("_v"))
    group = [f"_g{i}" for i in range(len(by))]
    v = F.col("_v")
    exact = _exact(v)
    counted = d.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"), F.try_sum(exact).alias("_s"),
                                          F.count(exact).alias("_e"))
    total = counted.groupBy(*group).agg(
        F.sum("_c").alias("n_listings"), F.sum(F.when(v.isNotNull(), F.col("_c")).otherwise(0)).alias("n_rent"),
        F.sum("_e").alias("_exact"), F.try_sum("_s").alias("_sum"))
    middle = _medians(counted.where(v.isNotNull()), group)
    m = middle.select(*[F.col(g).alias(f"m{g}") for g in group], "median_rent")
    on = None
    for g in group:
        e = F.col(g).eqNullSafe(F.col(f"m{g}"))
        on = e if on is None else on & e
    joined = total.join(m, on, "left")
    columns = [F.col(g).alias(c) for g, c in zip(group, by)]
    mean = F.when(F.col("_exact") > 0, F.col("_sum").cast("double") / F.col("_exact"))
    extra = [(F.col("n_rent") - F.col("_exact")).alias("n_left_out")] if left_out else []
    return joined.select(*columns, "n_listings", "n_rent", mean.alias("mean_rent"), "median_rent", *extra)


def _medians(counted: DataFrame, group: list[str]) -> DataFrame:
    """Exact median per group of distinct values ``_v`` with counts ``_c``."""
    v = F.col("_v")
    ranges = F.floor(F.signum(v) * F.log1p(F.abs(v)) * 64).cast("long")
    counted = counted.select(*group, "_v", "_c", F.when(v.isNull() | F.isnan(v), F.lit(1 << 40)).otherwise(ranges).alias("_range"))
    per = counted.groupBy(*group, "_range").agg(F.sum("_c").alias("_n"))
    whole, before = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*group, "_range", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all"))
    lo, hi = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    per = per.withColumn("_lo", lo).withColumn("_hi", hi)
    holds = lambda r: (F.col("_before") < F.col(r)) & (F.col(r) <= F.col("_before") + F.col("_n"))
    per = per.where(holds("_lo") | holds("_hi")).select(*[F.col(g).alias(f"r{g}") for g in group], F.col("_range").alias("_r"),
                                                       "_before", "_lo", "_hi")
    on = F.col("_range") == F.col("_r")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"r{g}"))
    some = counted.join(per, on)
    up_to = Window.partitionBy(*group, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    some = some.withColumn("_to", F.col("_before") + F.sum("_c").over(up_to))
    at = lambda r: F.max(F.when((F.col("_to") - F.col("_c") < F.col(r)) & (F.col(r) <= F.col("_to")), v))
    low, high = F.col("_low"), F.col("_high")
    return (some.groupBy(*group).agg(at("_lo").alias("_low"), at("_hi").alias("_high"))
            .select(*group, F.when(low == high, low).otherwise(low * 0.5 + high * 0.5).alias("median_rent")))


def rank_groups(summary: DataFrame, value: str = "mean_rent", out: str = "rank_desc") -> DataFrame:
    """Rank aggregated groups (one row per state) by a value, highest first.

    Runs on the aggregated rows only (one per state), so the single window partition is
    bounded by the number of states."""
    w_desc = Window.orderBy(F.col(value).desc_nulls_last())
    w_asc = Window.orderBy(F.col(value).asc_nulls_last())
    return summary.withColumn(out, F.rank().over(w_desc).cast("bigint")) \
                  .withColumn("rank_asc", F.rank().over(w_asc).cast("bigint"))


def top_bottom(summary: DataFrame, value: str = "mean_rent", key: str = "state",
               top: int = 3, bottom: int = 2) -> DataFrame:
    """L3: the ``top`` highest and ``bottom`` lowest groups by a value (ties by key)."""
    hi = summary.orderBy(F.col(value).desc_nulls_last(), F.col(key).asc()).limit(top) \
                .withColumn("side", F.lit("top"))
    lo = summary.orderBy(F.col(value).asc_nulls_last(), F.col(key).asc()).limit(bottom) \
                .withColumn("side", F.lit("bottom"))
    return hi.unionByName(lo)


def category_drift(df: DataFrame, column: str = "category", allowed: Iterable[str] = K.ALLOWED_CATEGORIES) -> DataFrame:
    """The observed category domain against the allowed closed set. Output rows
    ``(category, issue)``: ``unexpected`` (seen, not allowed) or ``missing`` (allowed, not
    seen). Empty = pass. The allowed side is a literal list."""
    spark = df.sparkSession
    allowed_df = literal_frame(spark, [(a,) for a in allowed], "category string")
    seen = df.select(F.col(column).alias("category")).where(F.col("category").isNotNull()).distinct()
    unexpected = seen.join(allowed_df, "category", "left_anti").withColumn("issue", F.lit("unexpected"))
    missing = allowed_df.join(seen, "category", "left_anti").withColumn("issue", F.lit("missing"))
    return unexpected.unionByName(missing)


def null_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("category_id",)) -> DataFrame:
    """A5: per group, row count and the share of NULLs of each column."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(F.col(c).isNull().cast("double")).alias(f"null_rate_{c}") for c in columns]
    return df.groupBy(*by).agg(*aggs)


def field_presence(df: DataFrame, fields: Sequence[str] = K.REQUIRED_FIELDS) -> DataFrame:
    """For each required field, the rows carrying it; a field absent from every row
    (or from the schema) is reported with ``present = false``. One pass, then a
    one-row unpivot."""
    aggs = [(F.count(F.col(f)) if f in df.columns else F.lit(0).cast("bigint")).alias(f) for f in fields]
    counts = df.agg(*aggs)
    stacked = counts.unpivot([], list(fields), "field", "n_present")
    return stacked.withColumn("n_present", F.col("n_present").cast("bigint")) \
                  .withColumn("present", F.col("n_present") > 0)


def slice_coverage(reported: DataFrame, fetched: DataFrame, slice_cols: Sequence[str],
                   depth_cap: int = K.OFFSET_CAP) -> DataFrame:
    """Per slice, the total the source reported, the rows fetched, their ratio, and
    whether the slice is past the depth cap (so it must be split further)."""
    slice_cols = list(slice_cols)
    r = reported.groupBy(*slice_cols).agg(F.max("total_results").alias("reported"))
    f = fetched.groupBy(*slice_cols).agg(F.count(F.lit(1)).alias("fetched"))
    j = r.join(f, slice_cols, "full_outer")
    return j.select(*slice_cols, *coverage_columns(F.col("reported"), F.col("fetched"), depth_cap))


def coverage_columns(reported: Column, fetched: Column, depth_cap: int = K.OFFSET_CAP) -> list[Column]:
    """The columns of A7 from a slice's reported total and its fetched rows."""
    rep = F.coalesce(reported, F.lit(0)).cast("bigint")
    got = F.coalesce(fetched, F.lit(0)).cast("bigint")
    return [rep.alias("reported"), got.alias("fetched"), F.when(rep > 0, got / rep).alias("coverage"),
            (rep > depth_cap).alias("over_cap")]


def completed_slices(coverage: DataFrame) -> DataFrame:
    """Slices of A7 whose rows fetched reach the total reported, within the depth that can be fetched."""
    return coverage.where((F.col("fetched") >= F.col("reported")) & (F.col("reported") > 0) & ~F.col("over_cap"))


def slice_totals(coverage: DataFrame, region_cols: Sequence[str]) -> DataFrame:
    """A7 check of totals: each slice's ``sane``: its total is above 0 and below that of its region (a region of
    one slice may equal it). A slice filter that the source ignored reports the region's total."""
    by = Window.partitionBy(*region_cols)
    sane = (F.col("reported") > 0) & ((F.col("reported") < F.col("region_total")) | (F.col("region_slices") == 1))
    return (coverage.withColumn("region_total", F.sum("reported").over(by))
            .withColumn("region_slices", F.count(F.lit(1)).over(by)).withColumn("sane", sane))


def type_leakage(df: DataFrame, type_col: str = "property_type_id", category_col: str = "category_id",
                 excluded: Iterable[str] = K.EXCLUDED_CATEGORIES) -> DataFrame:
    """Categories seen per requested type id, with a flag on excluded categories."""
    return df.groupBy(type_col, category_col).agg(F.count(F.lit(1)).alias("n")) \
             .withColumn("excluded", F.coalesce(F.col(category_col).isin(*list(excluded)), F.lit(False)))


def contamination(df: DataFrame, by: Sequence[str] = ("state",), category_col: str = "category_id",
                  value: str = "monthly_rent", excluded: Iterable[str] = K.EXCLUDED_CATEGORIES) -> DataFrame:
    """Per group, rows before/removed by the category exclusion and the mean rent
    before and after it, in one pass (conditional aggregation)."""
    bad = F.coalesce(F.col(category_col), F.lit("")).isin(*list(excluded))
    v = F.col(value)
    kept_v = F.when(~bad, v)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(bad, 1)).alias("n_removed"),
        exact_mean(v).alias("mean_before"),
        exact_mean(kept_v).alias("mean_after"),
    )


def coverage_growth(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per group in two snapshots, side by side, with the change."""
    by = list(by)
    b = before.groupBy(*by).agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy(*by).agg(F.count(F.lit(1)).alias("n_after"))
    j = b.join(a, by, "full_outer")
    nb = F.coalesce(F.col("n_before"), F.lit(0)).cast("bigint")
    na = F.coalesce(F.col("n_after"), F.lit(0)).cast("bigint")
    return j.select(*by, nb.alias("n_before"), na.alias("n_after"), (na - nb).alias("delta"))


def run_counters(counters: dict[str, Column], df: DataFrame) -> DataFrame:
    """A10: named counters as a one-row result, computed in one aggregation pass."""
    return df.agg(*[c.alias(name) for name, c in counters.items()])
