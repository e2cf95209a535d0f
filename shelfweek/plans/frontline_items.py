"""Frontline weekly facts per item and title code, store and online sales side by side."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.functions.dates import week_bounds, with_year_week, within
from shelfweek.functions.measures import MONEY, money, total, total_if
from shelfweek.functions.text import ean
from shelfweek.operators.joins import absent, present
from shelfweek.plans import online, weekly
from shelfweek.sources.tables import Sources, staged

KEYS = ["min_dt", "ean", "item_code", "src", "prog", "loc_no"]
MEASURES = {
    "ship_qty": "bigint", "ship_cost": MONEY, "ship_val": MONEY,
    "rcv_qty": "bigint", "rcv_cost": MONEY, "rcv_val": MONEY,
    "st_sold_qty": "bigint", "st_sold_val": MONEY, "md_st_sold_qty": "bigint", "md_st_sold_val": MONEY,
    "st_rfnd_qty": "bigint", "st_rfnd_val": MONEY,
    "onl_sold_qty": "bigint", "onl_sold_val": MONEY, "onl_sold_fee": MONEY,
    "md_onl_sold_qty": "bigint", "md_onl_sold_val": MONEY, "md_onl_sold_fee": MONEY,
    "onl_rfnd_qty": "bigint", "onl_rfnd_val": MONEY,
    "rfi_qty": "bigint", "rfi_cost": MONEY, "rfi_list": MONEY, "in_sts_qty": "bigint", "out_sts_qty": "bigint",
    "rtn_qty": "bigint", "rtn_cost": MONEY, "rtn_list": MONEY,
}
ROW_COUNTS_ON = [
    "ship_qty", "rcv_qty", "st_sold_qty", "md_st_sold_qty", "st_rfnd_qty", "onl_sold_qty", "md_onl_sold_qty",
    "onl_rfnd_qty", "rfi_qty", "in_sts_qty", "out_sts_qty", "rtn_qty", "st_sold_val", "st_rfnd_val",
    "onl_sold_val", "onl_rfnd_val",
]


def fold_web_sales(src: Sources, goods: DataFrame, categories: list[str], start: date, end: date) -> DataFrame:
    """Web sales and refunds per week, store and item; the refunded amount lowers the sold amount."""
    orders = online.web_orders(src).withColumn("item_code", online.item_of_sku(F.col("sku")))
    orders = orders.where(F.col("item_code").isNotNull())
    ordered, changed = F.col("order_date"), F.col("site_last_modified_date")
    events = online.dated_events(
        orders, F.lit(online.WEB), {"at": ordered}, {"at": changed},
        within(ordered, start, end), (F.col("item_refund_amount") > 0) & within(changed, start, end),
    )
    # Marked down depends on the list price, so lines are first summed per item and price paid.
    cells = (
        events.groupBy("min_dt", "loc_no", "item_code", "item_price", "dir")
        .agg(
            total(F.col("quantity")).alias("qty"), total(F.col("extended_amount")).alias("amount"),
            total(F.col("shipping_amount")).alias("fee"), total(F.col("item_refund_amount")).alias("refund"),
        )
    )
    priced = weekly.at_goods(weekly.dealt(cells), goods, ["price", *categories])
    is_sale, is_refund = F.col("dir") == online.SALE, F.col("dir") == online.REFUND
    below = F.col("item_price") < F.col("price")
    keys = list(dict.fromkeys(["min_dt", "loc_no", *categories]))
    refunds = total_if(is_refund, F.col("refund"))
    return priced.groupBy(*keys).agg(
        total_if(is_sale, F.col("qty")).alias("onl_sold_qty"),
        money(total_if(is_sale, F.col("amount")) - refunds).alias("onl_sold_val"),
        money(total_if(is_sale, F.col("fee"))).alias("onl_sold_fee"),
        total_if(is_sale & below, F.col("qty")).alias("md_onl_sold_qty"),
        money(total_if(is_sale & below, F.col("amount")) - refunds).alias("md_onl_sold_val"),
        money(total_if(is_sale & below, F.col("fee"))).alias("md_onl_sold_fee"),
        total_if(is_refund, F.col("qty")).alias("onl_rfnd_qty"),
        money(refunds).alias("onl_rfnd_val"),
    )


def frontline_item_activity(src: Sources, start: date, end: date) -> DataFrame:
    goods = weekly.frontline_products(src).withColumn("ean", ean(F.col("isbn"), F.col("upc")))
    categories = ["ean", "item_code", "src", "prog", weekly.SLICE]  # the slice keeps the folds of an item in one place
    args = (src, goods, categories, start, end)
    store_names = {
        "sold_qty": "st_sold_qty", "sold_val": "st_sold_val", "md_sold_qty": "md_st_sold_qty",
        "md_sold_val": "md_st_sold_val", "rfnd_qty": "st_rfnd_qty", "rfnd_val": "st_rfnd_val",
    }
    folds = [
        weekly.fold_shipments(*args), weekly.fold_receiving(*args),
        weekly.fold_sales(*args).withColumnsRenamed(store_names),
        fold_web_sales(*args), weekly.fold_transfers(*args),
    ]
    keys = [*KEYS, weekly.SLICE]
    wanted = {*keys, *MEASURES}
    folds = [fold.select(*[name for name in fold.columns if name in wanted]) for fold in folds]
    return weekly.activity(keys, MEASURES, *folds, counts_on=ROW_COUNTS_ON).select(*KEYS, *MEASURES)


def weekly_frontline_items(src: Sources, as_of: date | None = None, weeks: int = 1) -> DataFrame:
    """Sparse facts: a row exists only where something happened.

    Store and online measures are summed side by side before they meet, so a store row is not counted once
    per online row; the marked-down fee is the fee of marked-down lines; item, source and program stay
    together in the key.
    """
    start, end = week_bounds(as_of, weeks)
    acts = staged(present(frontline_item_activity(src, start, end), src.locations.select(
        F.col("location_no").alias("loc_no")), ["loc_no"]), "frontline-items")
    volume = sum(
        (F.abs(name) for name in ("st_sold_qty", "onl_sold_qty", "st_rfnd_qty", "onl_rfnd_qty")),
        sum((F.col(name) for name in ("rcv_qty", "rfi_qty", "in_sts_qty", "out_sts_qty", "rtn_qty")),
            F.col("ship_qty")),
    )
    kept = acts.where(F.col("loc_no").isNotNull() & F.col("item_code").isNotNull())
    for column in ("loc_no", "item_code"):
        # Few keys are silent; their list is stored, so that the planner knows its size and need not shuffle the facts for it.
        kept = absent(kept, staged(weekly.silent_only(acts, column, volume), "silent"), [column])
    return with_year_week(kept).select("yr", "wk", *KEYS, *MEASURES)
