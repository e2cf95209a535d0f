"""Warehouse shipments by week and work program."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek import fixed_values as fv
from shelfweek.functions.dates import last_sunday, with_week, with_year_week
from shelfweek.functions.measures import money, total
from shelfweek.plans.weekly import zero_false
from shelfweek.sources.tables import Sources

STORES, RETAIL = "HPB", "RETAIL"


def work_program(order_type: Column, category: Column, product_type: Column, cap: Column, company: Column,
                 customer: Column) -> Column:
    """Program a shipped line belongs to; lines no rule covers are labelled by order and product type."""
    to_stores, kind = customer == STORES, F.trim(product_type)
    push = zero_false(order_type.isin(*fv.PUSH_ORDER_TYPES) & to_stores)
    seasonal_cap = F.coalesce(cap, F.lit("NON")) == "SNL"
    seasonal = F.trim(category).isin(*fv.SEASONAL_CATEGORIES) | kind.isin(*fv.NEW_GOODS_SKIPPED_TYPES) | seasonal_cap
    supplies = order_type.isin(*fv.SUPPLY_ORDER_TYPES) | (company == "SUP")
    return (
        F.when(push & ~seasonal, "Push")
        .when(push & seasonal, "Snl&MiscPush")
        .when(order_type.isin(*fv.INITIAL_ORDER_TYPES) & (company == "TTB") & to_stores, "Init&Shorts")
        .when(order_type.isin(*fv.PULL_ORDER_TYPES) & to_stores, "Pull-TTB")
        .when(order_type.isin(*fv.PULL_ORDER_TYPES) & (customer == RETAIL), "Whsl-Rtl")
        .when(order_type.isin(*fv.STORE_PULL_ORDER_TYPES) & (company == "HPB") & to_stores, "Pull-HPB")
        .when(supplies & to_stores, "Supplies")
        .when(order_type.isin(*fv.OUTSIDE_ORDER_TYPES) & (customer != STORES), "Wholesale")
        .otherwise(F.concat(order_type, kind))
    )


def goal_group(cap: Column, category: Column) -> Column:
    """Detailed caps and kits are tracked by category, everything else by cap."""
    filled_cap = F.coalesce(F.trim(cap), F.lit("NON"))
    detailed = zero_false(filled_cap.isin(*fv.DETAILED_GOAL_CAPS)) | zero_false(category == "KITS")
    return F.when(detailed, F.trim(category)).otherwise(filled_cap)


def goal_week(wk: Column, cap: Column) -> Column:
    """Week a shipment counts for: caps of the other fortnight half count for the week before it closed."""
    half = F.when(wk % 2 == 1, "A").otherwise("B")
    own = cap.isin("NON", "SNL") | (cap == half)
    return F.when(own, wk).when(wk == 1, 52).otherwise(wk - 1)


def shipped_lines(src: Sources, start: date, end: date, by_shipment: bool = False) -> DataFrame:
    """Goods shipped from ``start`` to ``end``, both included, with item, cap and program.

    Lines are summed per week, item and routing; ``by_shipment`` keeps the shipments apart.
    """
    stamp = F.col("actual_ship_date_time")
    heads = src.wh_shipment_header.where(
        (stamp >= F.lit(start)) & (stamp <= F.lit(end).cast("timestamp_ntz"))
    )
    heads = with_week(heads, "actual_ship_date_time").select(
        "internal_shipment_num", "min_dt", F.col("customer").alias("head_customer"), "ship_to"
    )
    lines = src.wh_shipment_detail.select(
        "internal_shipment_num", "item", "order_type", "company", "customer", "total_qty"
    )
    keys = ["min_dt", "item", "order_type", "company", "customer", "head_customer", "ship_to"]
    if by_shipment:
        keys.append("internal_shipment_num")
    cells = lines.join(heads, "internal_shipment_num").groupBy(*keys).agg(F.sum("total_qty").alias("ship_qty"))
    items = src.wh_item.select(
        "item", F.col("item_category1").alias("category"), "item_category2", "user_def4"
    ).withColumn("identifier", F.trim("category"))
    types = src.wh_item_types.select(F.col("item_code").alias("item"), "prod_type")
    caps = src.section_caps.select("identifier", F.col("user1_value").alias("cap"))
    placed = cells.join(items, "item").join(types, "item", "left").join(caps, "identifier", "left")
    kind = F.coalesce("prod_type", "item_category2")
    return placed.withColumns(
        {
            "program": work_program(F.col("order_type"), F.col("category"), kind, F.col("cap"), F.col("company"),
                                    F.col("customer")),
            "goal_grp": goal_group(F.col("cap"), F.col("category")),
            "ship_cost": money(F.col("user_def4") * F.col("ship_qty")),
            "cap": F.coalesce(F.trim("cap"), F.lit("NON")),
        }
    )


def program_detail(src: Sources, as_of: date, weeks: int = 26) -> DataFrame:
    end = last_sunday(as_of)
    rows = shipped_lines(src, end - timedelta(weeks=weeks), end)
    sums = rows.groupBy("min_dt", "cap", "goal_grp", "program").agg(
        total(F.col("ship_qty")).alias("ship_qty"), money(total(F.col("ship_cost"))).alias("ship_cost")
    )
    return with_year_week(sums)


def program_rollup(src: Sources, as_of: date, weeks: int = 26) -> DataFrame:
    """Shipped quantity by week and program over the trailing weeks."""
    return program_detail(src, as_of, weeks).groupBy("yr", "wk", "program").agg(F.sum("ship_qty").alias("ship_qty"))


def wholesale_by_customer(src: Sources, start: date, end: date) -> DataFrame:
    """Shipments to anyone but the stores by week, program and ship-to, with shipment and item counts."""
    rows = shipped_lines(src, start, end, by_shipment=True).where(F.col("head_customer") != STORES)
    keys = ["min_dt", "program", F.col("head_customer").alias("customer"), "ship_to"]
    sums = rows.groupBy(*keys).agg(
        F.count_distinct("internal_shipment_num").alias("shipments"),
        F.count_distinct("item").alias("items"), F.sum("ship_qty").alias("ship_qty"),
        F.sum("ship_cost").alias("ship_cost"),
    )
    return with_year_week(sums)


def goal_base(src: Sources, start: date, end: date) -> DataFrame:
    """Push quantities by week, cap and goal group with the customers served and the week they count for."""
    rows = shipped_lines(src, start, end).where(
        F.col("order_type").isin(*fv.PUSH_ORDER_TYPES)
        & (F.col("company") == "HPB")
        & ~F.trim("category").isin(*fv.SEASONAL_CATEGORIES)
        & ~F.trim(F.coalesce("prod_type", "item_category2")).isin(*fv.NEW_GOODS_SKIPPED_TYPES)
    )
    sums = rows.groupBy("min_dt", "cap", "goal_grp").agg(
        F.count_distinct("customer").alias("customers"), F.sum("ship_qty").alias("ship_qty")
    )
    return with_year_week(sums).withColumn("goal_wk", goal_week(F.col("wk"), F.col("cap")))
