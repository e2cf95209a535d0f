"""Title reports on the item facts: running totals per store and title, and comparisons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.joins import prior_year
from shelfweek.operators.windows import last_active, running_sum, series

WEEKLY = {"cur_sold_qty": "st_sold_qty", "cur_md_qty": "md_st_sold_qty", "cur_rtn_qty": "st_rfnd_qty"}


def bestseller_titles(item_facts: DataFrame, products: DataFrame) -> DataFrame:
    titles = products.select("item_code", "title")
    return item_facts.where(F.col("src") == "BS").join(titles, "item_code")


def title_weeks(item_facts: DataFrame, products: DataFrame) -> DataFrame:
    """Sold, marked-down and returned quantities per store, title code and week."""
    return bestseller_titles(item_facts, products).groupBy("loc_no", "min_dt", "yr", "wk", "ean").agg(
        F.max("title").alias("title"), *[F.sum(origin).alias(name) for name, origin in WEEKLY.items()]
    )


def title_running_totals(item_facts: DataFrame, products: DataFrame, since: date) -> DataFrame:
    """Weeks with sales or returns from ``since`` on, with totals over the title's whole history."""
    weeks = title_weeks(item_facts, products)
    over = series(["loc_no", "ean"])
    totals = {f"tot_{name[4:]}": running_sum(name, over) for name in WEEKLY}
    sold = F.col("cur_sold_qty") + F.col("cur_rtn_qty")
    totals["last_sold_wk"] = last_active(sold > 0, "min_dt", over)
    return weeks.withColumns(totals).where((F.col("min_dt") >= F.lit(since)) & (sold > 0))


def title_week_vs_total(item_facts: DataFrame, products: DataFrame, week: date) -> DataFrame:
    """One week against everything up to it per store and title, with the last week that had sales or returns."""
    rows = bestseller_titles(item_facts, products).where(F.col("min_dt") <= F.lit(week))
    this = F.col("min_dt") == F.lit(week)
    moved = F.col("st_sold_qty") + F.col("st_rfnd_qty") > 0
    sums = rows.groupBy("loc_no", "ean", "title").agg(
        F.sum(F.when(this, F.col("st_sold_qty")).otherwise(0)).alias("cur_sold_qty"),
        F.sum(F.when(this, F.col("md_st_sold_qty")).otherwise(0)).alias("cur_md_qty"),
        F.sum("st_sold_qty").alias("tot_sold_qty"), F.sum("md_st_sold_qty").alias("tot_md_qty"),
        F.max(F.when(moved, F.col("min_dt"))).alias("last_sold_wk"),
    )
    return sums.where("tot_sold_qty > 0")


def items_per_ean(item_facts: DataFrame) -> DataFrame:
    return item_facts.groupBy("ean").agg(F.count_distinct("item_code").alias("items"))


def store_weeks_vs_ly(item_facts: DataFrame, since: date) -> DataFrame:
    """Weekly totals per store beside the same week of the year before (zero where there was none)."""
    per_title = item_facts.groupBy("loc_no", "min_dt", "yr", "wk", "ean").agg(
        F.count_distinct("item_code").alias("items"),
        *[F.sum(name).alias(name) for name in ("ship_qty", "rcv_qty", "st_sold_qty", "md_st_sold_qty", "st_rfnd_qty")],
    )
    weeks = per_title.groupBy("loc_no", "min_dt", "yr", "wk").agg(
        F.count("ean").alias("titles"), F.sum("items").alias("items"),
        F.sum("ship_qty").alias("ship_qty"), F.sum("rcv_qty").alias("rcv_qty"),
        F.sum("st_sold_qty").alias("sold_qty"), F.sum("md_st_sold_qty").alias("md_qty"),
        F.sum("st_rfnd_qty").alias("rtn_qty"),
    )
    values = ["titles", "items", "ship_qty", "rcv_qty", "sold_qty", "md_qty", "rtn_qty"]
    compared = prior_year(weeks, ["loc_no"], {name: f"ly_{name}" for name in values})
    return compared.fillna(0, subset=[f"ly_{name}" for name in values]).where(F.col("min_dt") >= F.lit(since))
