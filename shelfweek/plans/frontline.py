"""Frontline weekly facts with source and program, and vendor returns, per week, section and store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from shelfweek.functions.dates import week_bounds
from shelfweek.functions.measures import MONEY
from shelfweek.plans import weekly
from shelfweek.plans.new_goods import ACTIVE_ON, REMOVED_AND_MOVED, SHIP_RECEIVE_SELL
from shelfweek.sources.tables import Sources, literal_rows

KEYS = ["min_dt", "src", "prog", "section", "loc_no"]
MEASURES = {
    **SHIP_RECEIVE_SELL, **REMOVED_AND_MOVED,
    "rtn_its": "bigint", "rtn_qty": "bigint", "rtn_cost": MONEY, "rtn_list": MONEY,
}


def frontline_activity(src: Sources, start: date, end: date) -> DataFrame:
    goods = weekly.frontline_products(src)
    stores = weekly.store_list(src.locations)
    folds = [
        fold(src, goods, ["src", "prog", "section"], start, end, stores)
        for fold in (weekly.fold_shipments, weekly.fold_receiving, weekly.fold_sales, weekly.fold_transfers)
    ]
    return weekly.activity(KEYS, MEASURES, *folds)


def weekly_frontline(src: Sources, as_of: date | None = None, weeks: int = 1) -> DataFrame:
    start, end = week_bounds(as_of, weeks)
    acts = frontline_activity(src, start, end)
    kinds = literal_rows(
        acts.sparkSession, [("BS", "Init"), ("BS", "Rord"), ("Frln", "Init"), ("Frln", "Rord")],
        "src string, prog string",
    )
    return weekly.culled_detail(acts, KEYS, MEASURES, [kinds], ACTIVE_ON, "frontline")
