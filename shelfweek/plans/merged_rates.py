"""Merged rate of sale per report item: wholesale, all-time retail and current retail side by side."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek import fixed_values as fv
from shelfweek.functions.dates import hour_boundaries, months_before
from shelfweek.functions.measures import RATE, rate, total_if, zero
from shelfweek.functions.text import pad_code
from shelfweek.operators.joins import absent, key_union, present
from shelfweek.plans.online_new import sections_of
from shelfweek.sources.layout import by_details, pair_keys
from shelfweek.sources.tables import Sources, staged

DAYS = "decimal(19,5)"
# Days per month of a current rate, and the span in hours of an item that shipped only once.
DAYS_PER_MONTH, SINGLE_SHIPMENT_HOURS = 30.3, 28 * 24
# Fixed value: spread of a store's rate above which it is averaged with the item's overall rate.
OUTLIER_ABOVE = 3


def available_stock(inventory: DataFrame, locations: DataFrame, in_transit: bool = False) -> DataFrame:
    """Free stock per item in storage locations, only where some is left; optionally with goods in transit."""
    free = F.col("on_hand_qty") - F.col("allocated_qty") - F.col("suspense_qty")
    if in_transit:
        free = free + F.col("in_transit_qty")
    storage = locations.where(F.col("location_class") == fv.STOCK_CLASS)
    held = present(inventory.where(F.col("company").isin(*fv.WAREHOUSE_COMPANIES)), storage, ["location"])
    return (
        held.groupBy("item")
        .agg(
            F.sum(free).alias("inv_qty"), F.min("received_date").alias("first_date"),
            F.max("received_date").alias("last_date"), F.count("*").alias("lines"),
        )
        .where("inv_qty > 0")
    )


def _days(start: Column, end: Column) -> Column:
    return (hour_boundaries(start, end).cast("double") / 24.0).cast(DAYS)


def _monthly(quantity: Column, months: int) -> Column:
    return (quantity.cast("double") / DAYS_PER_MONTH / float(months)).cast(RATE)


def wholesale_lines(*tiers: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Shipped wholesale lines of live and archive header/detail pairs, or of one pair that holds all tiers."""
    stacked = None
    for headers, details in by_details(tiers):
        keys = pair_keys(headers, details, "internal_shipment_num")
        heads = headers.where(F.col("actual_ship_date_time").isNotNull()).select(
            *keys, F.col("actual_ship_date_time").alias("shipped"),
            F.col("customer").alias("buyer"),
        )
        lines = details.where(
            F.col("order_type").isin(*fv.WHOLESALE_ORDER_TYPES)
            & (F.col("company") == "TTB")
            & ~F.col("customer").isin(*fv.WHOLESALE_SKIPPED_CUSTOMERS)
        ).select(*keys, "item", "total_qty")
        tier = lines.join(heads, keys).drop(*keys)
        stacked = tier if stacked is None else stacked.unionByName(tier)
    return stacked


def wholesale_rates(lines: DataFrame, items: DataFrame, stock: DataFrame, as_of: date, months: int = 3,
                    years: int = 15) -> DataFrame:
    """Wholesale quantities, buyers and rates per report item; items first shipped before the cutoff are left out."""
    since, cutoff = F.lit(months_before(as_of, months)), F.lit(months_before(as_of, 12 * years))
    current = F.col("shipped") >= since
    per_buyer = lines.groupBy("item", "buyer").agg(
        F.min("shipped").alias("first"), F.max("shipped").alias("last"), F.sum("total_qty").alias("qty"),
        total_if(current, F.col("total_qty")).alias("cr_qty"), F.max(current).alias("is_current"),
    )
    # After the grouping an item has one row per buyer, so this window stays small and saves a second scan.
    first_ever = F.min("first").over(Window.partitionBy("item"))
    kept = per_buyer.withColumn("first_ever", first_ever).where(F.col("first_ever") >= cutoff)
    kept = kept.withColumn("item_code", pad_code(F.col("item")))
    in_stock = stock.select("item", F.lit(True).alias("in_stock"))
    named = kept.join(items.select("item_code", "rpt_it"), "item_code", "left").join(in_stock, "item", "left")
    per_item = (
        named.groupBy(F.coalesce("rpt_it", "item_code").alias("rpt_it"))
        .agg(
            F.max("in_stock").alias("in_stock"), F.min("first").alias("first"), F.max("last").alias("last"),
            F.sum("cr_qty").alias("cr_sold_qty"), F.sum("qty").alias("at_sold_qty"),
            F.count_distinct(F.when(F.col("is_current"), F.col("buyer"))).alias("cr_custs"),
            F.count_distinct("buyer").alias("at_custs"),
        )
        .where("at_sold_qty > 0")
    )
    hours = F.coalesce(F.nullif(hour_boundaries(F.col("first"), F.col("last")), F.lit(0).cast("bigint")),
                       F.lit(SINGLE_SHIPMENT_HOURS).cast("bigint"))
    return per_item.select(
        "rpt_it",
        F.when(F.col("in_stock"), "active").otherwise("inac").alias("active"),
        F.col("first").alias("min_ship_dt"), "cr_sold_qty", "at_sold_qty", "cr_custs", "at_custs",
        _monthly(F.col("cr_sold_qty"), months).alias("cr_wh_ros"),
        rate(F.col("at_sold_qty") * 24, hours).alias("at_wh_ros"),
        (hours.cast("double") / 24.0).cast(DAYS).alias("active_days"),
        _days(F.col("last"), F.lit(as_of).cast("timestamp_ntz")).alias("days_diff"),
    )


def ledger_cells(ledger: DataFrame, as_of: date, months: int = 3) -> DataFrame:
    """The movement ledger per item and currently served store: first and last movement, shipped and sold quantities.

    Movements that are not current have no ``cr_loc``: which stores they went to is never asked, and an item has far more
    of those than current ones. Sales are negative in the ledger.
    """
    current = F.col("date") > F.lit(months_before(as_of, months))
    sent, sold = F.col("xacn").isin(*fv.OUTBOUND_LEDGER_KINDS), F.col("xacn").isin(*fv.SALE_LEDGER_KINDS)
    return ledger.groupBy("item_code", "item", F.when(current, F.col("loc")).alias("cr_loc")).agg(
        F.min("date").alias("first"), F.max("date").alias("last"),
        total_if(sent & current, F.col("qty")).alias("cr_ship_qty"), total_if(sent, F.col("qty")).alias("at_ship_qty"),
        total_if(sold & current, -F.col("qty")).alias("cr_sold_qty"),
        total_if(sold, -F.col("qty")).alias("at_sold_qty"),
    )


def stale_items(cells: DataFrame, items: DataFrame, cutoff: date) -> DataFrame:
    """Report items without a movement since the cutoff."""
    moved = cells.groupBy("item_code").agg(F.max("last").alias("last"))
    per_item = moved.join(items.select("item_code", "rpt_it"), "item_code").groupBy("rpt_it").agg(
        F.max("last").alias("last")
    )
    return per_item.where(F.col("last") < F.lit(cutoff)).select("rpt_it")


def alltime_retail_rates(base: DataFrame, equivs: DataFrame, items: DataFrame, stale: DataFrame, as_of: date,
                         months: int = 3) -> DataFrame:
    """Store rates summed per report item; outlying store rates are averaged with the item's overall rate.

    What is known of an item is brought together first, so that the rows per item and store meet it in one join.
    """
    since = F.lit(months_before(as_of, months))
    kept = absent(items.select("item_code", "rpt_it"), stale.select(F.col("rpt_it").alias("item_code")), ["item_code"])
    known = kept.join(equivs.select("item_code", "avg_ros"), "item_code")
    named = base.withColumnRenamed("rpt_it", "item_code").join(known, "item_code")
    ros, overall = F.col("ros").cast(RATE), F.col("avg_ros").cast(RATE)
    blended = F.when(F.col("z_ros") > OUTLIER_ABOVE, ((overall + ros) / 2).cast(RATE)).otherwise(ros)
    per_store = named.groupBy("rpt_it", "loc").agg(
        F.sum("lgi").alias("lgi"), F.sum("sold_qty").alias("at_sold_qty"), F.sum(blended).alias("at_ros"),
        F.max((F.col("lgi") > 1) & (F.col("max_dt") > since)).alias("is_current"), F.max(overall).alias("avg_ros"),
    )
    return per_store.groupBy("rpt_it").agg(
        F.count_if(F.col("is_current") & F.col("loc").isNotNull()).alias("cr_locs"),
        F.count("loc").alias("at_locs"), F.sum("lgi").alias("lgi"),
        F.sum("at_sold_qty").alias("at_sold_qty"), F.sum("at_ros").cast(RATE).alias("at_ros"),
        F.max("avg_ros").alias("avg_loc_ros"),
    )


def current_retail_rates(cells: DataFrame, items: DataFrame, master: DataFrame, stock: DataFrame, stale: DataFrame,
                         as_of: date, months: int = 3) -> DataFrame:
    """Shipped and sold quantities and rates per report item from the ledger cells."""
    listed = present(cells.withColumnRenamed("item_code", "_code").withColumnRenamed("item", "item_code"),
                     master, ["item_code"]).drop("item_code").withColumnRenamed("_code", "item_code")
    in_stock = stock.select(pad_code(F.col("item")).alias("item_code"), F.lit(True).alias("in_stock")).distinct()
    named = listed.join(items.select("item_code", "rpt_it"), "item_code").join(in_stock, "item_code", "left")
    named = absent(named, stale, ["rpt_it"])
    per_item = named.groupBy("rpt_it").agg(
        F.max("in_stock").alias("in_stock"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.count_distinct("cr_loc").alias("cr_locs"),
        *[F.sum(name).alias(name) for name in ("cr_ship_qty", "at_ship_qty", "cr_sold_qty", "at_sold_qty")],
    )
    return per_item.select(
        "rpt_it",
        F.when(F.col("in_stock"), "active").otherwise("inac").alias("active"),
        F.col("first").alias("min_ship_dt"),
        _days(F.col("first"), F.col("last")).alias("active_days"),
        _days(F.col("last"), F.lit(as_of).cast("timestamp_ntz")).alias("days_diff"),
        "cr_ship_qty", "at_ship_qty", "cr_locs", "cr_sold_qty",
        _monthly(F.col("cr_sold_qty"), months).alias("cr_ros"),
        "at_sold_qty",
        rate(F.col("at_sold_qty"), F.datediff("last", "first")).alias("at_ros"),
    )


def section_items(universe: DataFrame, src: Sources, stock: DataFrame) -> DataFrame:
    """Report items with group, section, default scheme and whether any of their items is in stock."""
    held = (
        stock.select(pad_code(F.col("item")).alias("item_code"), "inv_qty")
        .join(src.ledger_items.select("item_code", "rpt_it"), "item_code")
        .groupBy("rpt_it").agg(F.sum("inv_qty").alias("held"))
    )
    catalogue = src.products.select(
        F.col("item_code").alias("rpt_it"), F.trim("section_code").alias("section")
    ).join(src.item_master.select(F.col("item_code").alias("rpt_it"), "rord_grp"), "rpt_it")
    schemes = src.scheme_header.select(F.col("scheme_id").alias("default_scheme"), "total_scheme_qty")
    placed = (
        universe.select("rpt_it").join(catalogue, "rpt_it").join(sections_of(src.section_map), "section")
        .join(schemes, "default_scheme").join(held, "rpt_it", "left")
    )
    return placed.select(
        "rord_grp", "cap", "goal_grp", "secn", F.col("default_scheme").alias("def_scheme"),
        F.col("total_scheme_qty").alias("scheme_qty"), "rpt_it",
        F.when(zero(F.col("held")) > 0, "active").otherwise("inac").alias("active"),
    )


def merge_rates(items: DataFrame, alltime: DataFrame, current: DataFrame, wholesale: DataFrame) -> DataFrame:
    """One row per report item with all rates; each side has one row per item, so nothing is counted twice."""
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select("rpt_it", *[F.col(n).alias(f"{prefix}_{n}") for n in df.columns if n != "rpt_it"])

    joined = items
    for frame, prefix in ((alltime, "ar"), (current, "cr"), (wholesale, "wr")):
        joined = joined.join(side(frame, prefix), "rpt_it", "left")

    def summed(name: str, *parts: str, kind: str = "bigint") -> Column:
        return sum((zero(F.col(part)) for part in parts[1:]), zero(F.col(parts[0]))).cast(kind).alias(name)

    def larger(name: str) -> Column:
        none = F.lit(0).cast(DAYS)
        return F.greatest(F.coalesce(f"cr_{name}", none), F.coalesce(f"wr_{name}", none)).alias(name)

    return joined.select(
        "rord_grp", "cap", "goal_grp", "secn", "rpt_it", "active",
        F.coalesce("cr_min_ship_dt", "wr_min_ship_dt").alias("min_ship_dt"),
        larger("active_days"), larger("days_diff"),
        summed("lgi", "ar_lgi"),
        summed("cr_ros", "cr_cr_ros", "wr_cr_wh_ros", kind=RATE),
        summed("at_zid_ros", "ar_at_ros", "wr_at_wh_ros", kind=RATE),
        summed("at_ros", "cr_at_ros", "wr_at_wh_ros", kind=RATE),
        summed("cr_wh_ros", "wr_cr_wh_ros", kind=RATE),
        summed("at_wh_ros", "wr_at_wh_ros", kind=RATE),
        summed("at_rtl_ship_qty", "cr_at_ship_qty"), summed("at_rtl_sold_qty", "cr_at_sold_qty"),
        summed("cr_sold_qty", "cr_cr_sold_qty", "wr_cr_sold_qty"),
        summed("at_sold_qty", "cr_at_sold_qty", "wr_at_sold_qty"),
        summed("cr_wh_sold_qty", "wr_cr_sold_qty"), summed("at_wh_sold_qty", "wr_at_sold_qty"),
        summed("cr_locs", "ar_cr_locs"), summed("at_locs", "ar_at_locs"),
        summed("cr_wh_custs", "wr_cr_custs"), summed("at_wh_custs", "wr_at_custs"),
    )


def merged_rates(src: Sources, as_of: date, months: int = 3, years: int = 15) -> DataFrame:
    """Each side is aggregated per report item and staged, because the item universe and the merge both read it."""
    items = src.ledger_items
    stock = staged(available_stock(src.wh_inventory, src.wh_location), "free-stock")
    cells = staged(ledger_cells(src.ledger, as_of, months), "ledger-cells")
    stale = staged(stale_items(cells, items, months_before(as_of, 12 * years)), "stale-items")
    wholesale = staged(
        wholesale_rates(wholesale_lines(*src.wh_shipment_tiers), items, stock, as_of, months, years), "wholesale-rates"
    )
    alltime = staged(
        alltime_retail_rates(src.order_base, src.order_equivs, items, stale, as_of, months), "alltime-rates"
    )
    current = staged(
        current_retail_rates(cells, items, src.item_master, stock, stale, as_of, months), "current-rates"
    )
    universe = key_union(["rpt_it"], wholesale, alltime, current)
    return merge_rates(section_items(universe, src, stock), alltime, current, wholesale)
