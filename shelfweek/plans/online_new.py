"""Online new goods facts: sales and refunds per week, store, program, section and site."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.windows import first_row
from shelfweek.functions.dates import week_bounds, with_year_week
from shelfweek.functions.measures import money, total, total_if
from shelfweek.functions.text import varchar
from shelfweek.operators.joins import present
from shelfweek.plans import online, weekly
from shelfweek.sources.tables import Sources

KEYS = ["used_new", "src", "min_dt", "loc_no", "rord_grp", "vendor", "cap", "secn", "site"]
LOAD_KEYS = ["min_dt", "loc_no", "src", "vendor", "secn", "site"]
MEASURES = ["sold_ords", "sold_its", "sold_qty", "sold_cost", "sold_val", "sold_list", "sold_fee", "rfnd_ords",
            "rfnd_its", "rfnd_amt"]


def vendor_with_suffix(vendor: Column, product_type: Column) -> Column:
    """Warehouse goods are told apart by frontline (``-f``) and other (``-n``) product types."""
    suffix = F.when(F.right(F.rtrim(product_type), F.lit(1)) == "F", "-f").otherwise("-n")
    return F.when(vendor == "CDC", F.concat(vendor, suffix)).otherwise(vendor)


def sections_of(section_map: DataFrame) -> DataFrame:
    """One row of the map per section, taken as a whole, so that a lookup never multiplies rows nor mixes two of them."""
    return first_row(section_map.where(F.col("section").isNotNull()), "section", "cap", "goal_grp", "secn", "ttb_vendor", "default_scheme")


def online_cells(events: DataFrame) -> DataFrame:
    """Item events per week, store, site and direction; orders are counted once per cell."""
    coded = events.withColumn("item_code", online.item_of_sku(F.col("sku"))).where(F.col("item_code").isNotNull())
    return coded.groupBy("min_dt", "loc_no", "site", "dir", "item_code").agg(
        F.count_distinct("order_no").alias("orders"),
        F.count("*").alias("lines"),
        *[total(F.col(name)).alias(name) for name in ("qty", "amount", "fee", "refund")],
    )


def weekly_online_new(src: Sources, as_of: date | None = None, weeks: int = 1) -> DataFrame:
    """Cost and list value count once per line, as booked; order counts add up the orders of each item."""
    start, end = week_bounds(as_of, weeks)
    cells = online_cells(online.online_events(src, start, end))
    cells = present(cells, weekly.store_list(src.locations), ["loc_no"])
    goods = src.products.select("item_code", "price", "cost", "product_type", F.trim("section_code").alias("section"))
    master = src.item_master.select("item_code", "rord_grp", F.col("vendor").alias("master_vendor"))
    known = cells.join(goods, "item_code").join(master, "item_code")
    mapped = known.join(sections_of(src.section_map).select("section", "cap", "secn"), "section", "left")
    sale, refund = F.col("dir") == online.SALE, F.col("dir") == online.REFUND
    labelled = mapped.select(
        "*",
        F.lit("New").alias("used_new"),
        F.when(F.col("rord_grp") == "BS", "BS").otherwise("DIPS").alias("src"),
        varchar(vendor_with_suffix(F.col("master_vendor"), F.col("product_type")), 12).alias("vendor"),
    )
    rolled = labelled.groupBy(*KEYS).agg(
        total_if(sale, F.col("orders")).alias("sold_ords"),
        F.count_if(sale).alias("sold_its"),
        total(F.col("qty")).alias("sold_qty"),
        money(total_if(sale, F.col("lines") * F.col("cost"))).alias("sold_cost"),
        money(total(F.col("amount"))).alias("sold_val"),
        money(total_if(sale, F.col("lines") * F.col("price"))).alias("sold_list"),
        money(total(F.col("fee"))).alias("sold_fee"),
        total_if(refund, F.col("orders")).alias("rfnd_ords"),
        F.count_if(refund).alias("rfnd_its"),
        money(total(F.col("refund"))).alias("rfnd_amt"),
    )
    return with_year_week(rolled).select("yr", "wk", *KEYS, *MEASURES)
