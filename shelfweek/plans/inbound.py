"""Inbound and stored goods by stage: purchase order, open receipt, stock, waved stock.

Stages become lines of one layout, likely duplicates are judged, and the lines are reported in detail and by
section. ``detail`` tables and header tables come in tiers (live, archive).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek import fixed_values as fv
from shelfweek.functions.measures import rate, total, total_if, zero
from shelfweek.functions.text import drop_last_three, filled, pad_code, varchar
from shelfweek.operators.joins import absent, key_union, look_up, nearest_in_time, not_in, present
from shelfweek.plans.merged_rates import available_stock
from shelfweek.plans.online_new import sections_of
from shelfweek.sources.layout import pair_keys
from shelfweek.sources.tables import Sources, staged

LINE = ["item", "scheme_id", "qty", "status", "last_date", "notes1", "notes2", "notes3"]
# How long an order without receipts, and an order after its last receipt, is waited for.
PO_DAYS, RECEIPT_DAYS = 366, 180
# Shipment status ranges of waved and in-progress lines.
WAVED, IN_PROGRESS = (100, 300), (300, 900)
Tiers = Iterable[tuple[DataFrame, DataFrame]]


def stock_with_waves(stock: DataFrame, shipment_detail: DataFrame) -> DataFrame:
    """Stock per item with the quantities store shipments have waved and started."""
    status, quantity = F.col("status1"), F.col("total_qty")
    waves = shipment_detail.where(F.col("customer") == "HPB").groupBy("item").agg(
        total_if((status >= WAVED[0]) & (status < WAVED[1]), quantity).alias("wave_qty"),
        total_if((status >= IN_PROGRESS[0]) & (status < IN_PROGRESS[1]), quantity).alias("prog_qty"),
        F.max("date_time_stamp").alias("last_wave_dt"),
    )
    return stock.join(waves, "item", "left").fillna(0, subset=["wave_qty", "prog_qty"])


def receipts(tiers: Tiers, items: DataFrame | None = None) -> DataFrame:
    """Receipt lines of all tiers, summed per item and receipt; with ``items``, only theirs are read on."""
    stacked = None
    for headers, details in tiers:
        keys = pair_keys(headers, details, "internal_receipt_num")
        heads = headers.select(*keys, "receipt_id", "ship_from", "receipt_type", "close_date", "receipt_date")
        lines = details if items is None else present(details, items, ["item"])
        lines = lines.groupBy(*keys, "item", "item_category3").agg(F.sum("total_qty").alias("qty"))
        tier = lines.join(heads, keys).drop(*keys)
        stacked = tier if stacked is None else stacked.unionByName(tier)
    return stacked


def purchase_orders(tiers: Tiers, items: DataFrame | None = None) -> DataFrame:
    """Order lines of all tiers, summed per item and order; with ``items``, only theirs are read on."""
    stacked = None
    for headers, details in tiers:
        keys = pair_keys(headers, details, "purchase_order_id")
        heads = headers.select(*keys, "ship_from", "receipt_type", "created_date_time")
        lines = details if items is None else present(details, items, ["item"])
        lines = lines.groupBy(*keys, "item", "item_category3").agg(F.sum("total_quantity").alias("qty"))
        tier = lines.join(heads, keys).drop(*keys[1:])
        stacked = tier if stacked is None else stacked.unionByName(tier)
    return stacked


def stock_lines(stock: DataFrame, rcts: DataFrame, pos: DataFrame, receipt_time: str = "close_date") -> DataFrame:
    """A line per stocked item with the receipt, or else the order, nearest in time to its arrival.

    The match looks both before and after the arrival; equal distances go to the smaller id.
    """
    found = {"receipt_id": "r_id", "ship_from": "r_from", "receipt_type": "r_type", "item_category3": "r_scheme"}
    ordered = {"ship_from": "p_from", "receipt_type": "p_type", "item_category3": "p_scheme"}
    with_receipt = nearest_in_time(
        stock, rcts.withColumnsRenamed(found), "item", "first_date", receipt_time, list(found.values()), ["r_id"]
    ).drop("hours_apart")
    matched = nearest_in_time(
        with_receipt, pos.withColumnsRenamed(ordered), "item", "first_date", "created_date_time",
        list(ordered.values()), ["purchase_order_id"],
    ).drop("hours_apart")
    waved = F.col("wave_qty") + F.col("prog_qty") != 0
    return matched.select(
        "item",
        F.coalesce("r_scheme", "p_scheme").alias("scheme_id"),
        F.greatest(F.col("inv_qty") - F.col("wave_qty"), F.lit(0)).cast("bigint").alias("qty"),
        F.when(waved, fv.STATUS_WAVED).otherwise(fv.STATUS_STOCK).alias("status"),
        F.col("first_date").alias("last_date"),
        varchar(F.coalesce("r_id", F.lit(fv.NO_RECEIPT)), 20).alias("notes1"),
        varchar(F.coalesce("r_from", "p_from"), 20).alias("notes2"),
        F.coalesce("r_type", "p_type").alias("notes3"),
    )


def _summed(lines: DataFrame, status: str, quantity: str, stamp: str, note: str, by_type: bool) -> DataFrame:
    """Lines of one stage per item and scheme, with the latest date and note."""
    keys = ["item", F.col("item_category3").alias("scheme_id"), *(["receipt_type"] if by_type else [])]
    sums = lines.groupBy(*keys).agg(
        F.sum(quantity).cast("bigint").alias("qty"), F.max(stamp).alias("last_date"),
        varchar(F.max(note), 20).alias("notes1"), F.max("ship_from").alias("notes2"),
    )
    kind = F.col("receipt_type") if by_type else F.lit(None).cast("string")
    return sums.withColumns({"status": F.lit(status), "notes3": kind}).select(*LINE)


def _ordered_lines(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Order lines of both companies; single-unit lines only exist to create item codes."""
    lines = details.where(F.col("company").isin(*fv.WAREHOUSE_COMPANIES) & (F.col("total_quantity") > 1))
    heads = headers.select("purchase_order_id", "ship_from", "receipt_type", "created_date_time")
    return lines.join(heads, "purchase_order_id")


@dataclass(frozen=True)
class OrderNumbers:
    """How an order is named elsewhere: in the order register, by its purchase order id, and in the order details, by a line's notes.

    The defaults take six characters, which is right only for numbers of that width; longer ones need rules of their own.
    """

    in_register: Callable[[Column], Column] = lambda order: F.right(order, F.lit(6))
    in_notes: Callable[[Column], Column] = lambda note: F.left(note, F.lit(6))


SIX_CHARACTERS = OrderNumbers()


def verified(lines: DataFrame, register: DataFrame, rule: OrderNumbers = SIX_CHARACTERS) -> DataFrame:
    """Order lines the order register still lists, matched on order number and padded code."""
    known = register.select(F.col("po_number").alias("po_key"), F.col("item_code").alias("item_key"))
    keyed = lines.withColumns(
        {"po_key": rule.in_register(F.col("purchase_order_id")), "item_key": pad_code(F.col("item"))}
    )
    return present(keyed, known, ["po_key", "item_key"]).drop("po_key", "item_key")


def received_order_ids(*receipt_details: DataFrame) -> DataFrame:
    stacked = receipt_details[0].select("receipt_id")
    for details in receipt_details[1:]:
        stacked = stacked.unionByName(details.select("receipt_id"))
    return stacked.select(drop_last_three(F.col("receipt_id")).alias("purchase_order_id")).distinct()


def open_po_lines(headers: DataFrame, details: DataFrame, receipt_details: Iterable[DataFrame], as_of: date,
                  register: DataFrame | None = None, by_type: bool = False, rule: OrderNumbers = SIX_CHARACTERS) -> DataFrame:
    """Lines of the last year's orders that have no receipt at all."""
    recent = headers.where(F.col("created_date_time") >= F.lit(as_of - timedelta(days=PO_DAYS)))
    lines = _ordered_lines(recent, details)
    if register is not None:
        lines = verified(lines, register, rule)
    open_lines = not_in(lines, "purchase_order_id", received_order_ids(*receipt_details))
    return _summed(open_lines, fv.STATUS_PO_ONLY, "total_quantity", "date_time_stamp", "purchase_order_id", by_type)


def unreceived_po_lines(headers: DataFrame, details: DataFrame, receipt_headers: DataFrame,
                        receipt_details: Iterable[DataFrame], as_of: date, by_type: bool = False) -> DataFrame:
    """Lines never received, on orders with a receipt closed (or, if open, created) in the last half year."""
    recent = receipt_headers.where(
        F.coalesce("close_date", "creation_date_time_stamp") > F.lit(as_of - timedelta(days=RECEIPT_DAYS))
    ).select(drop_last_three(F.col("receipt_id")).alias("purchase_order_id"))
    keys = ["item", "purchase_order_id"]
    lines = present(_ordered_lines(headers, details), recent, ["purchase_order_id"])
    lines = absent(lines, key_union(keys, *receipt_details), keys)
    return _summed(lines, fv.STATUS_PO_PARTIAL, "total_quantity", "date_time_stamp", "purchase_order_id", by_type)


def open_receipt_rows(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Lines of unclosed receipts on which nothing has been received."""
    lines = details.where(
        (F.col("total_qty") == F.col("open_qty")) & F.col("company").isin(*fv.WAREHOUSE_COMPANIES)
    )
    heads = headers.where(F.col("close_date").isNull()).select("internal_receipt_num", "ship_from", "receipt_type")
    return lines.join(heads, "internal_receipt_num")


def open_receipt_lines(headers: DataFrame, details: DataFrame, stocked: DataFrame | None = None,
                       by_type: bool = False) -> DataFrame:
    """Open receipts per item; with ``stocked``, without receipts whose goods are already counted as stock."""
    rows = open_receipt_rows(headers, details)
    if stocked is not None:
        seen = stocked.where(F.col("status").isin(fv.STATUS_STOCK, fv.STATUS_WAVED))
        rows = absent(rows, seen.select("item", F.col("notes1").alias("receipt_id")), ["item", "receipt_id"])
    return _summed(rows, fv.STATUS_OPEN_RECEIPT, "total_qty", "receipt_date", "receipt_id", by_type)


def prefer_adjusted(lines: DataFrame) -> DataFrame:
    """For items adjusted into stock without a receipt, keep only those lines."""
    adjusted = lines.where(F.col("notes1") == fv.NO_RECEIPT).select("item", F.lit(True).alias("adjusted")).distinct()
    marked = look_up(lines, adjusted, ["item"])
    return marked.where(F.col("adjusted").isNull() | (F.col("notes1") == fv.NO_RECEIPT)).drop("adjusted")


def stage_lines(src: Sources, as_of: date, receipt_time: str = "close_date", by_type: bool = False,
                register: bool = True, drop_stocked: bool = False, rule: OrderNumbers = SIX_CHARACTERS) -> DataFrame:
    """All stages in one layout, adjusted goods preferred.

    The lines are staged, because the preference reads them twice and would make every stage twice.
    """
    stock = staged(stock_with_waves(available_stock(src.wh_inventory, src.wh_location, in_transit=True),
                                    src.wh_shipment_detail), "stock")
    live_receipts, live_details = src.wh_receipt_tiers[0]
    order_heads, order_lines = src.wh_po_tiers[0]
    detail_tiers = [details for _, details in src.wh_receipt_tiers]
    stocked = staged(
        stock_lines(stock, receipts(src.wh_receipt_tiers, stock), purchase_orders(src.wh_po_tiers, stock), receipt_time),
        "stock-lines",
    )
    stages = [
        open_po_lines(order_heads, order_lines, detail_tiers[:2], as_of,
                      src.purchase_order_register if register else None, by_type, rule),
        unreceived_po_lines(order_heads, order_lines, live_receipts, detail_tiers, as_of, by_type),
        open_receipt_lines(live_receipts, live_details, stocked if drop_stocked else None, by_type),
    ]
    lines = stocked
    for stage in stages:
        lines = lines.unionByName(stage)
    return prefer_adjusted(staged(lines, "stage-lines"))


def status_digit(status: Column) -> Column:
    return F.left(status, F.lit(1))


def order_group(company_mark: Column, vendor: Column, group: Column) -> Column:
    """Reorder group of a line; retired reorder items fall back to warehouse goods."""
    return (
        F.when(company_mark == "TTB", "TRO")
        .when((vendor != "Inac") & (group == "HRO"), "HRO")
        .otherwise("CDC")
    )


def order_class(stores_and_rates: Column, status: Column, group: Column) -> Column:
    """Initial order when the item never sold or stood in stores; waved goods of reorder groups are reorders."""
    untouched = stores_and_rates == 0
    return F.when(untouched & ((status != fv.STATUS_WAVED) | (group == "CDC")), "init").otherwise("rord")


def days_of_supply(quantity: Column, on_hand: Column, per_day: Column) -> Column:
    return rate(quantity + zero(on_hand), per_day)


def dup_verdict(status: Column, titles: Column, titles_per_company: Column, best: Column) -> Column:
    """Whether a line is likely a second entry of a title that another line already covers."""
    partial = (status == fv.STATUS_PO_PARTIAL) & (titles >= 2) & (titles_per_company == 1)
    return (
        F.when(partial & (best == F.left(status, F.lit(2))), "maybe")
        .when((status != fv.STATUS_PO_ONLY) | (titles < 2) | (titles_per_company > 1), "ok")
        .otherwise("dup")
    )


def with_line_counts(lines: DataFrame) -> DataFrame:
    """Lines per item, per title and per title and company mark, and the title's earliest stage.

    A title (or its absence) may hold a large share of the lines, so the counts are grouped and looked up.
    """
    per_item = lines.groupBy("item").agg(F.count("*").alias("item_lines"))
    per_title = lines.groupBy("title").agg(
        F.count("*").alias("title_lines"), F.min(F.left("status", F.lit(2))).alias("best_status")
    )
    per_company = lines.groupBy("title", "company_mark").agg(F.count("*").alias("company_lines"))
    counted = look_up(lines, per_item, ["item"])
    counted = look_up(counted, per_title, ["title"], null_safe=True)
    return look_up(counted, per_company, ["title", "company_mark"], null_safe=True)


def named_lines(lines: DataFrame, src: Sources) -> DataFrame:
    """Lines with their warehouse and product columns."""
    wh = src.wh_item.select("item", "item_style", F.col("description").alias("title"),
                            F.col("user_def4").alias("cost"), F.col("net_price").alias("price"))
    goods = src.products.select(
        "item_code", F.col("user_char15").alias("company_mark"), "purchase_from_vendor_id", "isbn", "upc",
        "reorderable", "reorderable_item", F.trim("section_code").alias("section"),
    )
    coded = lines.withColumn("item_code", pad_code(F.col("item")))
    return coded.join(wh, "item", "left").join(goods, "item_code", "left")


def enrich_lines(lines: DataFrame, src: Sources, rule: OrderNumbers = SIX_CHARACTERS) -> DataFrame:
    """Lines with product, section, scheme, order and rate columns; each lookup has one row per key.

    The named lines are staged, because the counts read them again.
    """
    counted = with_line_counts(staged(named_lines(lines, src), "named-lines"))
    orders = src.order_detail.groupBy("item_code", "po_number").agg(
        F.max("special_instructions").alias("spec_instr")
    )
    new_items = src.ledger_items.select("item_code", F.col("rpt_it").alias("new_rpt"))
    old_items = src.reorder_items.select("item_code", F.col("rpt_it").alias("old_rpt"))
    master = src.item_master.select("item_code", F.col("vendor").alias("master_vendor"),
                                    F.col("rord_grp").alias("master_grp"))
    schemes = src.scheme_header.select("scheme_id", F.col("total_scheme_qty").cast("int").alias("orig_scheme_qty"))
    section_schemes = src.scheme_header.select(
        F.col("scheme_id").alias("default_scheme"), F.col("total_scheme_qty").cast("int").alias("secn_scheme_qty")
    )
    rates = src.rates.drop("rord_grp", "cap", "goal_grp", "secn", "active").withColumnRenamed("rpt_it", "rate_key")
    joined = counted.withColumn("po_number", rule.in_notes(F.col("notes1")))
    joined = joined.join(orders, ["item_code", "po_number"], "left")
    for side in (new_items, old_items, master):
        joined = joined.join(side, "item_code", "left")
    joined = joined.join(sections_of(src.section_map).select("section", "cap", "secn", "default_scheme"), "section",
                         "left")
    joined = joined.withColumn("rate_key", F.coalesce("new_rpt", "old_rpt", "item_code")).join(rates, "rate_key", "left")
    joined = joined.join(schemes, "scheme_id", "left").join(section_schemes, "default_scheme", "left")
    group = order_group(F.col("company_mark"), F.col("master_vendor"), F.col("master_grp"))
    presence = (
        zero(F.col("at_locs")) + zero(F.col("at_ros")) - zero(F.col("at_wh_ros")) + zero(F.col("lgi"))
    )
    numbers = {name: zero(F.col(name)) for name in (
        "lgi", "cr_sold_qty", "at_sold_qty", "cr_locs", "at_locs", "cr_ros", "at_ros", "cr_wh_ros", "at_wh_ros",
        "cr_wh_custs", "at_wh_custs", "orig_scheme_qty", "secn_scheme_qty",
    )}
    enriched = joined.withColumns(
        {
            "rord_grp": group,
            "rord_vendor": F.coalesce("purchase_from_vendor_id", F.lit("")),
            "title_code": F.coalesce(filled(F.col("isbn")), filled(F.col("upc")), "item_style"),
            "reorder_marks": F.coalesce(F.concat("reorderable_item", "reorderable"), F.lit("NN")),
            "order_class": order_class(presence, F.col("status"), group),
            "rpt_it": F.coalesce("new_rpt", "old_rpt", F.lit("new")),
            "days_cr_ros": days_of_supply(F.col("qty"), F.col("lgi"), F.col("cr_ros")),
            "days_at_ros": days_of_supply(F.col("qty"), F.col("lgi"), F.col("at_ros")),
            "status_id": status_digit(F.col("status")).cast("int"),
            "status_dt": F.to_date("last_date"),
            "orig_scheme_id": F.col("scheme_id"), "secn_scheme_id": F.col("default_scheme"),
            **numbers,
        }
    )
    verdict = dup_verdict(F.col("status"), F.col("title_lines"), F.col("company_lines"), F.col("best_status"))
    return enriched.withColumn("dup_line", verdict)


def rank_in_report_item(lines: DataFrame) -> DataFrame:
    """Order of stocked lines within their report item; lines without one are not ranked.

    Unlisted items are partitioned by item, so that they never meet in one task.
    """
    alone = F.when(F.col("rpt_it") == "new", F.col("item"))
    order = Window.partitionBy("rpt_it", alone).orderBy(F.desc("reorder_marks"), "item", "status", "notes1")
    stocked = (F.col("status_id") > 2) & (F.col("rpt_it") != "new")
    return lines.withColumn("rpt_it_rank", F.when(stocked, F.row_number().over(order)))


def suggested_orders(orders: DataFrame, set_id: int, oos_set_id: int) -> DataFrame:
    """Suggested quantity and stores per report item from the regular and the out-of-stock set; the larger wins.

    Equal quantities take the out-of-stock set.
    """
    regular, oos = F.col("set_id") == set_id, F.col("set_id") == oos_set_id
    wanted, quantity = F.col("order_qty") > 0, F.col("order_qty")
    per_store = orders.where(regular | oos).groupBy("rpt_it", "loc").agg(
        total_if(regular, quantity).alias("reg_qty"), total_if(oos, quantity).alias("oos_qty"),
        F.max(regular & wanted).alias("in_reg"), F.max(oos & wanted).alias("in_oos"),
    )
    placed = F.col("loc").isNotNull()
    sums = per_store.groupBy("rpt_it").agg(
        F.sum("reg_qty").alias("reg_qty"), F.count_if(F.col("in_reg") & placed).alias("reg_locs"),
        F.sum("oos_qty").alias("oos_qty"), F.count_if(F.col("in_oos") & placed).alias("oos_locs"),
    )
    larger = F.col("oos_qty") >= F.col("reg_qty")
    return sums.select(
        "rpt_it",
        *[F.when(larger, F.col(f"oos_{m}")).otherwise(F.col(f"reg_{m}")).alias(f"sugg_order_{m}")
          for m in ("qty", "locs")],
    )


def latest_set(orders: DataFrame) -> int | None:
    """Id of the most recent suggestion set, a one-row aggregate."""
    return orders.agg(F.max("set_id").alias("set_id")).first()["set_id"]


DETAIL = [
    "item_code", "status", "item_lines", "notes1", "notes2", "orig_scheme_id", "status_dt", "rord_grp", "rord_vendor",
    "cap", "secn", "secn_scheme_id", "spec_instr", "title_code", "title", "cost", "price", "qty", "orig_scheme_qty",
    "secn_scheme_qty", "reorder_marks", "order_class", "rpt_it", "lgi", "sugg_order_qty", "cr_sold_qty", "at_sold_qty",
    "sugg_order_locs", "cr_locs", "at_locs", "cr_ros", "at_ros", "cr_wh_ros", "at_wh_ros", "cr_wh_custs",
    "at_wh_custs", "days_cr_ros", "days_at_ros",
]


def inbound_detail(enriched: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Lines judged fine, without the known junk orders, beside their suggested orders."""
    kept = enriched.where((F.col("dup_line") == "ok") & ~F.col("notes1").isin(*fv.JUNK_PURCHASE_ORDERS))
    return look_up(kept, suggestions, ["rpt_it"]).select(*DETAIL)


def inbound_by_section(enriched: DataFrame, section_map: DataFrame) -> DataFrame:
    """Quantities and titles in stock, on receipt and on order per section, for both programs, side by side."""
    stage = F.when(F.col("status_id") > 2, "stock").when(F.col("status_id") == 2, "receipt").otherwise("order")
    programs = {"cdc": "CDC", "tro": "TRO"}
    kept = enriched.where((F.col("dup_line") == "ok") & F.col("rord_grp").isin(*programs.values()))
    per_item = kept.groupBy("secn", "rord_grp", "item", stage.alias("stage")).agg(
        F.sum("qty").alias("qty"),
        total_if(F.col("order_class") == "init", F.col("qty")).alias("init_qty"),
        F.max(F.col("order_class") == "init").alias("is_init"),
    )
    sums = []
    for name, group in programs.items():
        for step in ("stock", "receipt", "order"):
            here = (F.col("rord_grp") == group) & (F.col("stage") == step)
            sums += [total_if(here, F.col("qty")).alias(f"{name}_{step}_qty"),
                     F.count_if(here).alias(f"{name}_{step}_items")]
            if name == "tro":
                sums += [total_if(here, F.col("init_qty")).alias(f"init_{step}_qty"),
                         F.count_if(here & F.col("is_init")).alias(f"init_{step}_items")]
    per_section = per_item.groupBy(F.col("secn").alias("_secn")).agg(*sums)
    unplaced = F.col("section").isNull()
    grid = section_map.select(
        F.when(unplaced, "zzz").otherwise(F.col("cap")).alias("cap"),
        F.when(unplaced, fv.MISSING_SECTION).otherwise(F.col("secn")).alias("secn"),
        F.col("section"),
    ).distinct().where(~F.col("secn").isin(*fv.SKIPPED_SECTIONS))
    measures = [name for name in per_section.columns if name != "_secn"]
    placed = grid.join(per_section, F.col("section").eqNullSafe(F.col("_secn")), "left")
    return placed.groupBy("cap", "secn").agg(*[total(F.col(name)).alias(name) for name in measures])


def inbound(src: Sources, as_of: date, set_id: int | None = None, oos_set_id: int = 36,
            rule: OrderNumbers = SIX_CHARACTERS) -> tuple[DataFrame, DataFrame]:
    """Detail lines and the overview by section."""
    regular = latest_set(src.suggested_orders) if set_id is None else set_id
    enriched = staged(enrich_lines(stage_lines(src, as_of, rule=rule), src, rule), "inbound-lines")
    detail = inbound_detail(enriched, suggested_orders(src.suggested_orders, regular, oos_set_id))
    return detail, inbound_by_section(enriched, src.section_map)


def inbound_by_receipt_type(src: Sources, as_of: date) -> DataFrame:
    """Variant that matches receipts by creation date, carries the receipt type and skips receipts already in stock."""
    lines = stage_lines(src, as_of, receipt_time="receipt_date", by_type=True, register=False, drop_stocked=True)
    known = present(lines, src.wh_item, ["item"])
    return known.withColumn("status_id", status_digit(F.col("status")))
