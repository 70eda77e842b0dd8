"""Weekly segment aggregate (H1) and its building blocks.

Plan shape: parquet scan (date filter pushed down) -> products that the rules drop leave before
anything is shuffled -> optional partial+final aggregate to day x store x product -> joins with
the dimensions -> one aggregate by segment-week and unit price, written as a stage table, from which the
weekly sums, means and the exact median are taken.  No step needs a segment-week's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (as_date, clean_attribute_code, clip, discount_fraction, month_floor_lookback,
                                 not_sentinel, number, require_columns, week_start)
from ..profiles import Profile, get_profile
from ..session import materialize

# Column names of the segment tables.
SEGMENT = ["product_att_01", "product_att_02", "product_att_05", "store_cluster"]
SEGMENT_DESCS = ["product_att_01_desc", "product_att_02_desc", "product_att_05_desc"]
WEEKLY_KEYS = ["product_att_01", "product_att_02", "product_att_05",
               "product_att_01_desc", "product_att_02_desc", "product_att_05_desc",
               "store_cluster", "week_start_date"]
PRODUCT_COLS = ["product_id", *WEEKLY_KEYS[:6]]


def normalize_sales(sales: DataFrame) -> DataFrame:
    """String ids (trimmed), DATE dates, numbers coerced with 0 for missing quantity."""
    out = sales
    for c in ("store_code", "product_id", "stok_kodu"):
        if c in out.columns:
            out = out.withColumn(c, F.trim(F.col(c).cast("string")))
    if "date" in out.columns:
        out = out.withColumn("date", as_date("date"))
    for c in ("discount_amount", "net_amount_wovat", "unit_price"):
        if c in out.columns:
            out = out.withColumn(c, number(c))
    if "net_quantity" in out.columns:
        out = out.withColumn("net_quantity", F.coalesce(number("net_quantity"), F.lit(0.0)))
    return out


def daily_unit_price(sales: DataFrame) -> DataFrame:
    """P8 (prod): sum by day x store x product; unit price = net amount / quantity, NULL on 0."""
    return (sales.groupBy("date", "store_code", "product_id")
                 .agg(F.sum("discount_amount").alias("discount_amount"),
                      F.sum("net_amount_wovat").alias("net_amount_wovat"),
                      F.sum("net_quantity").alias("net_quantity"))
                 .withColumn("unit_price", F.try_divide("net_amount_wovat", "net_quantity")))


def enrich_sales(sales: DataFrame, product: DataFrame, clusters: DataFrame,
                 product_cols: list[str] | None = None) -> DataFrame:
    """J1 + J2: left joins to the product and store-cluster dimensions.

    Both are left to the planner: AQE broadcasts a dimension whose measured size is under the
    threshold and shuffles on its key otherwise."""
    cols = product_cols or PRODUCT_COLS
    p = product.select(*[c for c in cols if c in product.columns])
    out = sales.join(p, "product_id", "left")
    return out.join(clusters.select("store_code", "store_cluster"), "store_code", "left")


def calendar_week_join(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """The week comes from the calendar; days off the calendar get a NULL week."""
    cal = calendar.select(as_date("date").alias("date"), week_start("date").alias("week_start_date"))
    return sales.join(cal, "date", "left")


def segment_products(product: DataFrame) -> DataFrame:
    """The products of the segment tables: attributes cleaned, none a sentinel or missing."""
    p = product.select(*PRODUCT_COLS).withColumn("product_att_02", clean_attribute_code("product_att_02"))
    p = p.filter(not_sentinel("product_att_01", [9]) & not_sentinel("product_att_02", [9]))
    return p.dropna(subset=PRODUCT_COLS)


def segment_rows(sales: DataFrame, product: DataFrame, clusters: DataFrame, calendar: DataFrame | None,
                 pf: Profile) -> DataFrame:
    """Sales rows with the segment-week keys; rows without a full key drop out.

    Attributes depend on the product only, so the dropped products leave before the daily
    aggregate is shuffled."""
    p = segment_products(product)
    s = sales
    if pf.daily_preaggregate:
        s = daily_unit_price(s.join(p.select("product_id"), "product_id", "left_semi"))
    if pf.week_from_calendar and calendar is not None:
        s = calendar_week_join(s, calendar)
    else:
        s = s.withColumn("week_start_date", week_start("date"))
    s = s.join(p, "product_id").join(clusters.select("store_code", "store_cluster"), "store_code")
    return s.dropna(subset=WEEKLY_KEYS)


def weekly_segment_sales(sales: DataFrame, product: DataFrame, clusters: DataFrame,
                         calendar: DataFrame | None = None, profile: "Profile | str | None" = None,
                         as_of: Column | None = None) -> DataFrame:
    """H1: weekly sales per (3 attribute codes, 3 descriptions, store cluster, week)."""
    pf = get_profile(profile)
    require_columns(sales, ["date", "store_code", "product_id", "net_quantity"], "history_sales")
    s = normalize_sales(sales)
    if pf.prep_lookback_months:
        anchor = as_of if as_of is not None else F.current_date()
        s = s.filter(F.col("date") >= month_floor_lookback(anchor, months=pf.prep_lookback_months))
    s = segment_rows(s, product, clusters, calendar, pf)
    frac, denom = discount_fraction()
    price = number("unit_price")
    if pf.unit_price_clip:
        price = clip(price, lo=0.0)
    s = s.select(*WEEKLY_KEYS, F.col("net_quantity"), price.alias("unit_price"), frac.alias("discount_frac"), denom.alias("rev_pre_disc"))
    by_price = s.groupBy(*WEEKLY_KEYS, "unit_price").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_quantity").alias("q"), F.sum("discount_frac").alias("f"),
        F.sum("rev_pre_disc").alias("w"), F.sum(F.col("discount_frac") * F.col("rev_pre_disc")).alias("fw"))
    by_price = by_price.withColumn("pn", F.col("unit_price") * F.col("n")).withColumn("priced", F.when(F.col("unit_price").isNotNull(), F.col("n")))
    sums = ["n", "q", "f", "w", "fw", "pn", "priced"]
    if pf.median_mode == "approx":
        median = s.groupBy(*WEEKLY_KEYS).agg(F.percentile_approx("unit_price", 0.5, pf.median_accuracy).cast("double").alias("unit_price_median"))
        out = by_price.groupBy(*WEEKLY_KEYS).agg(*[F.sum(c).alias(c) for c in sums]).join(median, WEEKLY_KEYS, "left")
    else:
        # the cells and the middle values both read it: written once, or the sales would be scanned and joined for each
        out = sums_and_median(materialize(by_price, "by-price"), WEEKLY_KEYS, sums, "unit_price", "n", "unit_price_median")
    mean_frac = F.col("f") / F.col("n")
    fallback = mean_frac if pf.wavg_fallback_mean else F.lit(None).cast("double")
    total = F.bround("q", 0) if pf.total_quantity_rounding == "half_even" else F.col("q")
    return out.select(*WEEKLY_KEYS, total.cast("long").alias("total_quantity"),
                      F.try_divide("pn", "priced").alias("unit_price_mean"), "unit_price_median",
                      mean_frac.alias("discount_frac_mean"),
                      F.when(F.col("w") > 0, F.col("fw") / F.col("w")).otherwise(fallback).alias("discount_frac_wavg"))


def value_bucket(value: Column) -> Column:
    """Ordered buckets of about one percent relative width; NULL for NULL."""
    width = F.floor(F.log2(F.abs(value) + 1e-9) * 64).cast("int") + 2000
    return F.when(value < 0, -width).when(value > 0, width).when(value == 0, 0)


def sums_and_median(counts: DataFrame, keys: list[str], sums: list[str], value: str, n: str, out: str) -> DataFrame:
    """Per key the sums of columns and the exact median, from distinct values and their counts; the
    keys are not NULL.

    One aggregate by key and value bucket carries the sums; the running counts over a key's buckets
    (some thousands at most) tell which of them hold the one or two middle ranks, and the same
    partitioning adds up the sums.  Only the values of the middle buckets are looked at again, on the one row that
    each key has by then."""
    v, b = F.col(value), F.col("_b")
    cells = counts.withColumn("_b", value_bucket(v)).groupBy(*keys, "_b").agg(
        *[F.sum(c).alias(c) for c in sums], F.coalesce(F.sum(F.when(v.isNotNull(), F.col(n))), F.lit(0)).alias("_s"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(F.asc_nulls_first("_b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("_to", F.sum("_s").over(upto)).withColumn("_n", F.sum("_s").over(whole))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    start = F.col("_to") - F.col("_s")

    def place(rank: Column) -> Column:
        """The bucket of a rank and how many values lie before it."""
        return F.max(F.when((start < rank) & (rank <= F.col("_to")), F.struct(b.alias("b"), start.alias("before"), rank.alias("rank"))))

    per_key = cells.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums], place(low).alias("_low"), place(high).alias("_high"))
    values = counts.filter(v.isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], v.alias("_v"), F.col(n).alias("_c"), value_bucket(v).alias("_vb"))
    met = per_key.join(values, [*(F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)), F.col("_vb").isin(F.col("_low.b"), F.col("_high.b"))], "left")
    running = Window.partitionBy(*keys, "_vb").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.withColumn("_upto", F.sum("_c").over(running))

    def at(which: str) -> Column:
        """The value that holds a rank."""
        rank = F.col(f"{which}.rank") - F.col(f"{which}.before")
        here = (F.col("_vb") == F.col(f"{which}.b")) & (F.col("_upto") - F.col("_c") < rank) & (rank <= F.col("_upto"))
        return F.sum(F.when(here, F.col("_v")))

    rows = met.groupBy(*keys).agg(*[F.first(f"_sum_{c}").alias(c) for c in sums], ((at("_low") + at("_high")) / 2).alias(out))
    return rows.select(*keys, *sums, out)


def median_of_counts(counts: DataFrame, keys: list[str], value: str, n: str, out: str = "median") -> DataFrame:
    """Exact median per key from distinct values and their counts; no group meets in one task.

    Values fall into buckets of about one percent relative width, in order.  The buckets of a key
    (some thousands at most) tell which of them hold the one or two middle ranks; only the values
    of those are ordered.  Keys whose values are all NULL have no row."""
    v = F.col(value)
    cells = counts.filter(v.isNotNull()).select(*keys, v.alias("_v"), F.col(n).alias("_c"), value_bucket(v).alias("_b"))
    in_order = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_of = Window.partitionBy(*keys)
    sizes = cells.groupBy(*keys, "_b").agg(F.sum("_c").alias("_s"))
    sizes = sizes.withColumn("_to", F.sum("_s").over(in_order)).withColumn("_n", F.sum("_s").over(all_of))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    start = F.col("_to") - F.col("_s")
    middle = sizes.filter((F.col("_to") >= low) & (start < high)).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), start.alias("_from"), low.alias("_low"), high.alias("_high"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    met = cells.join(middle, [*same, F.col("_b") == F.col("_kb")])
    running = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.withColumn("_upto", F.col("_from") + F.sum("_c").over(running))
    holds = lambda rank: F.sum(F.when((F.col("_upto") - F.col("_c") < rank) & (rank <= F.col("_upto")), F.col("_v")))
    return met.groupBy(*keys).agg(((holds(F.col("_low")) + holds(F.col("_high"))) / 2).alias(out))


# --------------------------------------------------------------- primitives (keys)

def weekly_quantity(sales_enriched: DataFrame) -> DataFrame:
    """G1: plain sum of quantity per segment-week."""
    return (sales_enriched.dropna(subset=WEEKLY_KEYS).groupBy(*WEEKLY_KEYS)
            .agg(F.sum("net_quantity").alias("total_quantity")))


def weekly_price_stats(sales_enriched: DataFrame) -> DataFrame:
    """Mean and exact median of the unit price per segment-week (NULLs skipped)."""
    counts = sales_enriched.dropna(subset=WEEKLY_KEYS).groupBy(*WEEKLY_KEYS, "unit_price").agg(F.count(F.lit(1)).alias("n"))
    priced = F.sum(F.when(F.col("unit_price").isNotNull(), F.col("n")))
    mean = counts.groupBy(*WEEKLY_KEYS).agg(F.try_divide(F.sum(F.col("unit_price") * F.col("n")), priced).alias("unit_price_mean"))
    return mean.join(median_of_counts(counts, WEEKLY_KEYS, "unit_price", "n", "unit_price_median"), WEEKLY_KEYS, "left")


def weighted_discount(sales_enriched: DataFrame, fallback: str = "null") -> DataFrame:
    """Revenue-weighted discount fraction; weight sum <= 0 -> mean ('mean') or NULL."""
    frac, denom = discount_fraction()
    s = sales_enriched.select(*WEEKLY_KEYS, frac.alias("f"), denom.alias("w")).dropna(subset=WEEKLY_KEYS)
    wsum = F.sum("w")
    fb = F.avg("f") if fallback == "mean" else F.lit(None).cast("double")
    return s.groupBy(*WEEKLY_KEYS).agg(
        F.when(wsum > 0, F.sum(F.col("f") * F.col("w")) / wsum).otherwise(fb).alias("discount_frac_wavg"))


def prepared_sales(sales: DataFrame, product: DataFrame, clusters: DataFrame,
                   as_of: Column | None = None, months: int | None = 24) -> DataFrame:
    """Shared input of the G1-G3 keys: prod-style daily sales, enriched and cleaned."""
    s = normalize_sales(sales)
    if months:
        s = s.filter(F.col("date") >= month_floor_lookback(as_of if as_of is not None else F.current_date(), months=months))
    return segment_rows(s, product, clusters, None, get_profile("prod"))


def top_segments(weekly: DataFrame, n: int = 20) -> DataFrame:
    """O1 + O2: the n largest segment-weeks by quantity (ties broken by the keys)."""
    return weekly.orderBy(F.col("total_quantity").desc(), *[F.col(k).asc_nulls_first() for k in WEEKLY_KEYS]).limit(n)


def segment_keys(weekly: DataFrame) -> DataFrame:
    """Distinct segments."""
    return weekly.select(*SEGMENT).distinct()
