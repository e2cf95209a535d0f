"""Chain and store reports: the four weekly facts in one layout, online sales merged in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.operators.windows import first_row
from shelfweek import fixed_values as fv
from shelfweek.functions.dates import week_boundaries, with_fiscal
from shelfweek.functions.measures import MONEY, total, total_if
from shelfweek.functions.text import fold_case
from shelfweek.operators.sets import missing_dates
from shelfweek.plans.online_new import sections_of
from shelfweek.sources.tables import Sources, literal_rows, staged

STORE_MEASURES = {
    "ship_qty": "bigint", "ship_cost": MONEY, "ship_list": MONEY, "rcv_qty": "bigint", "rcv_cost": MONEY,
    "rcv_list": MONEY, "sold_qty": "bigint", "sold_cost": MONEY, "sold_val": MONEY, "md_sold_qty": "bigint",
    "md_sold_cost": MONEY, "md_sold_val": MONEY, "rfi_qty": "bigint", "rfi_cost": MONEY, "moved_qty": "bigint",
    "bsm_qty": "bigint", "bsm_cost": MONEY, "rtn_qty": "bigint", "rtn_cost": MONEY,
}
ONLINE_MEASURES = {
    "onl_sold_qty": "bigint", "onl_sold_cost": MONEY, "onl_sold_val": MONEY, "onl_sold_fee": MONEY,
    "rfnd_ords": "bigint", "rfnd_amt": MONEY, "web_sold_qty": "bigint", "web_sold_val": MONEY,
}
MEASURES = {**STORE_MEASURES, **ONLINE_MEASURES}
KEPT_ON = ["ship_qty", "rcv_qty", "sold_qty", "rfi_qty", "moved_qty", "rtn_qty"]
# Where the layout's measures come from in each fact; what a fact does not list is zero there.
GOODS = {
    "ship_qty": "ship_qty", "ship_cost": "ship_cost", "ship_list": "ship_val", "rcv_qty": "rcv_qty",
    "rcv_cost": "rcv_cost", "rcv_list": "rcv_val", "sold_qty": "sold_qty", "sold_cost": "sold_cost",
    "sold_val": "sold_val", "md_sold_qty": "md_sold_qty", "md_sold_cost": "md_cost", "md_sold_val": "md_sold_val",
    "rfi_qty": "rfi_qty", "rfi_cost": "rfi_cost",
}
LAYOUT = {
    "base_inventory": ("Used", "BI", {
        "rcv_qty": "buy_qty", "rcv_cost": "buy_cost", "sold_qty": "sold_qty", "sold_val": "sold_val",
        "md_sold_qty": "md_sold_qty", "md_sold_val": "md_sold_val", "rfi_qty": "rfi_qty", "rfi_cost": "rfi_cost",
        "bsm_qty": "bsm_qty", "bsm_cost": "bsm_cost",
    }),
    "serial_items": ("Used", "SIPS", {
        "rcv_qty": "made_qty", "rcv_list": "made_list", "sold_qty": "sold_qty", "sold_val": "sold_val",
        "md_sold_qty": "md_sold_qty", "md_sold_val": "md_sold_val", "rfi_qty": "rfi_qty", "rfi_cost": "rfi_cost",
        "bsm_qty": "bsm_qty",
    }),
    "new_goods": ("New", "DIPS", GOODS),
    "frontline": ("New", "BS", {**GOODS, "rtn_qty": "rtn_qty", "rtn_cost": "rtn_cost"}),
}
TIME = ["yr", "wk", "min_dt"]


def labelled_facts(facts: Sources) -> dict[str, DataFrame]:
    """Each fact with its cap and section label; base inventory is labelled by product type."""
    sections = sections_of(facts.section_map).select("section", "cap", "secn")
    subjects = first_row(facts.section_map.where(F.col("subj").isNotNull()), "subj", "cap", "secn")
    types = facts.products.select("item_code", F.trim("product_type").alias("secn"), F.lit("").alias("cap"))
    return {
        "base_inventory": facts.base_inventory.join(types, "item_code"),
        "serial_items": facts.serial_items.join(subjects, "subj"),
        "new_goods": facts.new_goods.join(sections, "section"),
        "frontline": facts.frontline.where(F.col("src") == "BS").drop("src", "prog").join(sections, "section"),
    }


def stack_facts(facts: Sources, by: list[str], since_year: int, count_stores: bool) -> DataFrame:
    """The facts in one layout, summed per week, source and ``by``; half of each store-to-store move counts."""
    stacked = None
    for name, df in labelled_facts(facts).items():
        used_new, source, origin = LAYOUT[name]
        rows = df.where(F.col("yr") >= since_year).select(
            *TIME, F.lit(used_new).alias("used_new"), F.lit(source).alias("src"), "loc_no", "cap", "secn",
            *[F.col(origin[m]).alias(m) if m in origin else F.lit(0).cast(kind).alias(m)
              for m, kind in STORE_MEASURES.items() if m != "moved_qty"],
            (F.abs("in_sts_qty") + F.abs("out_sts_qty")).alias("moved_qty"),
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    sums = [total(F.col(m)).alias(m) for m in STORE_MEASURES]
    # One row per store first: the store count is then a plain count.
    per_store = stacked.groupBy("used_new", "src", *TIME, *dict.fromkeys([*by, "loc_no"])).agg(*sums)
    if count_stores:
        sums.append(F.count("*").alias("stores"))
    merged = per_store.groupBy("used_new", "src", *TIME, *by).agg(*sums)
    return merged.withColumns(
        {"moved_qty": (F.col("moved_qty") / 2).cast("bigint"),
         **{m: F.col(m).cast(kind) for m, kind in STORE_MEASURES.items() if m != "moved_qty"}}
    )


def online_by_week(online: DataFrame, weeks: DataFrame, by: list[str], count_stores: bool) -> DataFrame:
    """Online facts summed into the report layout and dated by the report's weeks; undated rows keep a null week."""
    dated = online.drop("min_dt").join(weeks.select("yr", "wk", "min_dt"), ["yr", "wk"], "left")
    value = F.col("sold_val") + F.col("sold_fee") - F.col("rfnd_amt")
    web = F.col("site") == "h"
    sums = {
        "onl_sold_qty": F.sum("sold_qty"), "onl_sold_cost": F.sum("sold_cost"), "onl_sold_val": F.sum(value),
        "onl_sold_fee": F.sum("sold_fee"), "rfnd_ords": F.sum("rfnd_ords"), "rfnd_amt": F.sum("rfnd_amt"),
        "web_sold_qty": total_if(web, F.col("sold_qty")), "web_sold_val": total_if(web, value),
    }
    aggregates = [value.cast(ONLINE_MEASURES[name]).alias(name) for name, value in sums.items()]
    if count_stores:
        aggregates.append(F.count_distinct("loc_no").alias("stores"))
    return dated.groupBy("used_new", "src", *TIME, *by).agg(*aggregates)


def report_weeks(stacked: DataFrame) -> DataFrame:
    """One date per year and week label (the first, where two weeks share a label)."""
    return stacked.groupBy("yr", "wk").agg(F.min("min_dt").alias("min_dt"))


def home_caps(stacked: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the cap they are reported under; ``at_store`` tells store rows from online rows.

    Store and online rows meet by week, source and section, whatever their caps. A store row keeps its cap. An online row
    keeps its own where a store row has it too, else it takes that of the store row, the first if there are several, so
    that its amounts count once; without a store row it keeps its own. A window holds the few rows of one label and week.
    """
    label = Window.partitionBy(*[name for name in keys if name != "cap"])
    first = F.min(F.when(F.col("at_store"), F.struct("cap"))).over(label)
    shared = F.max("at_store").over(Window.partitionBy(*keys))
    return stacked.withColumn("cap", F.when(F.col("at_store") | shared | first.isNull(), F.col("cap")).otherwise(first["cap"]))


def merge_online(store: DataFrame, online: DataFrame, by: list[str]) -> DataFrame:
    """Store and online rows of the same week, source and label side by side; totals count both.

    Both sides are stacked and grouped once, which stands for a full outer join on keys that may be null.
    """
    keys = ["used_new", "src", *TIME, *by]
    online = online.withColumnRenamed("stores", "onl_stores").withColumn("at_store", F.lit(False))
    stacked = store.withColumn("at_store", F.lit(True)).unionByName(online, allowMissingColumns=True)
    if "cap" in by:
        stacked = home_caps(stacked, keys)
    sums = [total(F.col(m)).cast(kind).alias(m) for m, kind in MEASURES.items()]
    if "stores" in store.columns:
        sums.append(F.coalesce(F.max("stores"), F.max("onl_stores")).alias("stores"))
    merged = stacked.groupBy(*keys).agg(*sums)
    both = {f"sold_{part}": F.col(f"sold_{part}") + F.col(f"onl_sold_{part}") for part in ("qty", "cost", "val")}
    active = sum((F.abs(name) for name in KEPT_ON[1:]), F.abs(KEPT_ON[0]))
    return with_fiscal(merged.withColumns(both).where(active > 0))


def merged_report(facts: Sources, by: list[str], since_year: int, count_stores: bool) -> DataFrame:
    stacked = staged(stack_facts(facts, by, since_year, count_stores), "report-facts")
    online = online_by_week(facts.online, report_weeks(stacked), by, count_stores)
    return merge_online(stacked, online, by)


def undated_online(facts: Sources, since_year: int = 2016) -> DataFrame:
    """Online rows of weeks the store facts do not have; none are expected."""
    weeks = report_weeks(stack_facts(facts, ["cap", "secn"], since_year, False))
    return missing_dates(online_by_week(facts.online, weeks, ["cap", "secn"], False))


def program(used_new: Column, source: Column) -> Column:
    return F.when(fold_case(used_new) == "used", "USED").when(source == "BS", "BS").otherwise("CDC")


def current_weeks(df: DataFrame) -> DataFrame:
    """The report's weeks of the last four weeks and of the same four a year before, numbered 1 (oldest) to 4."""
    dates = df.select("min_dt").distinct()
    latest = dates.agg(F.max("min_dt")).scalar()
    age = week_boundaries(F.col("min_dt"), latest)
    return dates.withColumn("age", age).where((F.col("age") < 4) | F.col("age").between(52, 55)).select(
        "min_dt", (4 - F.col("age") % 52).cast("int").alias("cur_4_wks")
    )


def with_current_weeks(df: DataFrame) -> DataFrame:
    marked = df.join(current_weeks(df), "min_dt", "left")
    return marked.withColumn("cur_4_wks", F.coalesce("cur_4_wks", F.lit(0)))


def chain_report(facts: Sources, since_year: int = 2016) -> tuple[DataFrame, DataFrame]:
    """Totals by week and source, and rows by section with the index of the current weeks."""
    merged = staged(merged_report(facts, ["cap", "secn"], since_year, True), "chain-report")
    return chain_by_source(merged), chain_by_section(merged)


def chain_by_source(merged: DataFrame) -> DataFrame:
    left_out = {"bsm_qty", "bsm_cost"}
    keys = ["used_new", "src", *TIME, "fy", "fw", "fw_wk"]
    sums = [F.sum(m).cast(kind).alias(m) for m, kind in MEASURES.items() if m not in left_out]
    return merged.groupBy(*keys).agg(*sums).withColumn("program", program(F.col("used_new"), F.col("src")))


def chain_by_section(merged: DataFrame) -> DataFrame:
    return with_current_weeks(merged).withColumn("program", program(F.col("used_new"), F.col("src")))


def section_rollup(merged: DataFrame, source: str | None = None) -> DataFrame:
    """Received, sold, marked-down and removed goods by section and week, over all sources or one."""
    rows = merged if source is None else merged.where(fold_case(F.col("src")) == source.lower())
    measures = ["rcv_qty", "sold_qty", "md_sold_qty", "rfi_qty", "rcv_cost", "sold_cost", "sold_val", "md_sold_val",
                "rfi_cost"]
    return rows.groupBy("secn", *TIME, "fy", "fw_wk").agg(*[F.sum(m).cast(MEASURES[m]).alias(m) for m in measures])


def reopen_weeks(stores: DataFrame, report: DataFrame, reopen_year: int, by_district: dict[str, int]) -> DataFrame:
    """Reported stores with region, district and the week their district reopened.

    Four stores reopened later than their district. The override moves the week number; the date stays the
    district's.
    """
    spark = stores.sparkSession
    weeks = literal_rows(spark, by_district.items(), "district_name string, district_week int")
    dates = report.where(F.col("yr") == reopen_year).groupBy(F.col("wk").alias("district_week")).agg(
        F.min("min_dt").alias("reopen_dt")
    )
    kept = stores.where(
        ~F.col("location_no").isin(*fv.STORE_REPORT_SKIPPED) & (F.col("location_no") < fv.STORE_REPORT_BELOW)
    )
    late = F.col("location_no").isin(*fv.LATE_REOPEN_STORES)
    return kept.join(weeks, "district_name").join(dates, "district_week").select(
        F.col("location_no").alias("loc_no"), "region_name", "district_name", "media_market",
        F.when(late, fv.LATE_REOPEN_WEEK).otherwise(F.col("district_week")).alias("reopen_wk"), "reopen_dt",
    )


def store_report(facts: Sources, since_year: int = 2016, shown_from: int = 2019, reopen_year: int = 2020,
                 by_district: dict[str, int] | None = None) -> DataFrame:
    """The report per store, with region, district, reopening week and the index of the current weeks."""
    merged = staged(merged_report(facts, ["loc_no"], since_year, False), "store-report")
    stores = reopen_weeks(facts.store_dim, merged, reopen_year, by_district or fv.REOPEN_WEEK_BY_DISTRICT)
    return with_current_weeks(merged).where(F.col("yr") >= shown_from).join(stores, "loc_no")
