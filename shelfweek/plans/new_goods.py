"""New goods weekly facts: shipped, received, sold and transferred per week, section and store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from shelfweek.functions.dates import week_bounds
from shelfweek.functions.measures import MONEY
from shelfweek.plans import weekly
from shelfweek.sources.tables import Sources

KEYS = ["min_dt", "section", "loc_no"]
SHIP_RECEIVE_SELL = {
    "ship_its": "bigint", "ship_qty": "bigint", "ship_cost": MONEY, "ship_val": MONEY,
    "rcv_its": "bigint", "rcv_qty": "bigint", "rcv_cost": MONEY, "rcv_val": MONEY,
    "sold_its": "bigint", "sold_qty": "bigint", "sold_cost": MONEY, "sold_val": MONEY, "list_val": MONEY,
    "md_sold_qty": "bigint", "md_cost": MONEY, "md_sold_val": MONEY, "md_list_val": MONEY,
}
REMOVED_AND_MOVED = {
    "rfi_qty": "bigint", "rfi_cost": MONEY, "rfi_list": MONEY, "in_sts_qty": "bigint", "out_sts_qty": "bigint",
}
MEASURES = {**SHIP_RECEIVE_SELL, **REMOVED_AND_MOVED}
ACTIVE_ON = ["ship_qty", "rcv_qty", "sold_qty", "rfi_qty", "in_sts_qty", "out_sts_qty"]


def new_goods_activity(src: Sources, start: date, end: date) -> DataFrame:
    goods = weekly.new_goods_products(src)
    stores = weekly.store_list(src.locations)
    folds = [
        fold(src, goods, ["section"], start, end, stores)
        for fold in (weekly.fold_shipments, weekly.fold_receiving, weekly.fold_sales, weekly.fold_transfers)
    ]
    return weekly.activity(KEYS, MEASURES, *folds)


def weekly_new_goods(src: Sources, as_of: date | None = None, weeks: int = 1) -> DataFrame:
    """Facts of the last ``weeks`` complete weeks before ``as_of``.

    Inbound transfers are kept by the receiving store, where the stored procedure tested the sender.
    """
    start, end = week_bounds(as_of, weeks)
    acts = new_goods_activity(src, start, end)
    return weekly.culled_detail(acts, KEYS, MEASURES, [], ACTIVE_ON, "new-goods")
