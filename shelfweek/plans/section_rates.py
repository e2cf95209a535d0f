"""Section rates of sale: channel sums, moving rates, year-on-year comparison, expectations, open receipts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweek import fixed_values as fv
from shelfweek.functions.dates import (
    last_sunday, retail_year_week, week_boundaries, week_table, with_week,
)
from shelfweek.functions.measures import RATE, rate, total, total_if
from shelfweek.functions.text import pad_code
from shelfweek.operators.joins import absent, attach, dense_spine, prior_year
from shelfweek.operators.windows import deltas, frame_rate, leading_rate, looks_ahead, series, trailing_rate
from shelfweek.plans.inbound import open_receipt_rows
from shelfweek.plans.online_new import sections_of
from shelfweek.sources.layout import between_days, by_details, pair_keys
from shelfweek.sources.tables import Sources, staged

CHANNELS = {"": "sold_qty", "s": "st_sold_qty", "o": "onl_sold_qty", "w": "wh_sold_qty"}
MONTH, QUARTER_ROWS = 4, 16
# Look-back of the title counts (a year and sixteen weeks) and offsets of the report dates.
TITLE_WEEKS = 68
FENCE_OFFSETS = {"last": -1, "base": -16, "back_2m": -8, "back_1m": -4, "ahead_2m": 8, "ahead_1m": 4, "target": 16}
LOCAL_CAP = "loc"


def date_fence(spark: SparkSession, as_of: date) -> DataFrame:
    """One row with the report's end date and its neighbours, each with its retail week."""
    end = last_sunday(as_of)
    row = {"end_dt": end}
    for name, offset in FENCE_OFFSETS.items():
        day = end + timedelta(weeks=offset)
        row[f"{name}_dt"] = day
        row[f"{name}_yr"], row[f"{name}_wk"] = retail_year_week(day)
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in row.items()])


def report_weeks(spark: SparkSession, as_of: date) -> DataFrame:
    """Weeks before the end date whose year is the current one or one of the two before."""
    end = last_sunday(as_of)
    year = retail_year_week(end - timedelta(weeks=1))[0]
    weeks = week_table(spark, date(year - 3, 12, 1), end)
    return weeks.where(F.col("yr").between(year - 2, year))


def label_rows(section_map: DataFrame) -> DataFrame:
    """The sections with their labels, and the labels that stand at subjects only; those have no section."""
    sections = sections_of(section_map).select("section", "cap", "goal_grp", "secn")
    subjects = section_map.where(F.col("section").isNull()).select("section", "cap", "goal_grp", "secn").distinct()
    return sections.unionByName(absent(subjects, sections, ["cap", "secn"], null_safe=True))


def section_weeks(section_map: DataFrame, weeks: DataFrame) -> DataFrame:
    """Every label in every week; a label without a section has no sales, and so rows of zeros."""
    return dense_spine(label_rows(section_map), weeks.select("yr", "wk", "min_dt"))


def store_channel(new_goods: DataFrame) -> DataFrame:
    return new_goods.groupBy("section", "min_dt").agg(
        F.sum("ship_qty").alias("ship_qty"), F.sum("sold_qty").alias("st_sold_qty")
    )


def online_channel(online: DataFrame) -> DataFrame:
    """New goods sold online; the online facts name their section in the section map's own terms."""
    new = online.where(F.col("used_new") == "New")
    return new.groupBy(F.col("secn").alias("section"), "min_dt").agg(F.sum("sold_qty").alias("onl_sold_qty"))


def shipped_tiers(tiers, order_types, start: date | None = None, end: date | None = None,
                  company: str | None = None) -> DataFrame:
    """Shipped lines of live and archive tiers per week, section, order type and item."""
    stacked = None
    for headers, details in by_details(tiers):
        keys = pair_keys(headers, details, "internal_shipment_num")
        heads = between_days(headers.where(F.col("actual_ship_date_time").isNotNull()), "actual_ship_date_time", start, end)
        lines = details.where(F.col("order_type").isin(*order_types))
        if company is not None:
            lines = lines.where(F.col("company") == company)
        lines = lines.select(
            *keys, "order_type", "item", F.trim("item_category1").alias("section"), "total_qty"
        )
        dated = with_week(heads, "actual_ship_date_time").select(*keys, "min_dt")
        tier = lines.join(dated, keys).groupBy("min_dt", "section", "order_type", "item").agg(
            F.sum("total_qty").alias("qty")
        )
        stacked = tier if stacked is None else stacked.unionByName(tier)
    return stacked


def wholesale_channel(tiers, start: date) -> DataFrame:
    shipped = shipped_tiers(tiers, fv.WHOLESALE_ORDER_TYPES, start)
    return shipped.groupBy("section", "min_dt").agg(
        F.count_distinct("item").alias("wh_sold_its"), F.sum("qty").alias("wh_sold_qty")
    )


def combine_channels(spine: DataFrame, stores: DataFrame, online: DataFrame, wholesale: DataFrame) -> DataFrame:
    """Channel quantities per section label and week on the dense spine, with the number of contributing rows."""
    keys = ["section", "min_dt"]
    kept = spine.where(~F.col("secn").isin(*fv.SKIPPED_SECTIONS) & (F.col("cap") != LOCAL_CAP))
    joined = kept
    for channel in (stores, online, wholesale.drop("wh_sold_its")):
        joined = joined.join(channel, keys, "left")
    sums = joined.groupBy("yr", "wk", "min_dt", "cap", "secn").agg(
        total(F.col("ship_qty")).alias("ship_qty"), total(F.col("st_sold_qty")).alias("st_sold_qty"),
        total(F.col("onl_sold_qty")).alias("onl_sold_qty"), F.count("onl_sold_qty").alias("onl_rows"),
        total(F.col("wh_sold_qty")).alias("wh_sold_qty"), F.count("wh_sold_qty").alias("wh_rows"),
    )
    return sums.withColumn("sold_qty", F.col("st_sold_qty") + F.col("onl_sold_qty") + F.col("wh_sold_qty"))


def rates(channels: DataFrame) -> DataFrame:
    """Trailing and forward four-week rates, in total and per channel."""
    over = series(["secn"])
    columns = {}
    for mark, quantity in CHANNELS.items():
        columns[f"{mark}ros"] = trailing_rate(quantity, over, MONTH)
        columns[f"next_{mark}ros"] = leading_rate(quantity, over, MONTH)
    return channels.withColumns(columns)


def rate_momentum(rated: DataFrame, from_year: int) -> DataFrame:
    """Changes of the trailing rate and looks ahead along the forward rate, from a year on.

    The year is cut before the rows are compared, so the first rows have no predecessors.
    """
    over = series(["secn"])
    columns = {}
    for mark in CHANNELS:
        columns.update(deltas(f"{mark}ros", over))
        columns.update(looks_ahead(f"next_{mark}ros", over, MONTH))
    return rated.where(F.col("yr") >= from_year).withColumns(columns)


def expected_sales(momentum: DataFrame, last_week: date) -> DataFrame:
    """The last week beside the same week a year before: what then followed, month by month, is expected now."""
    before = {f"{mark}ros": f"ly_{mark}ros" for mark in CHANNELS}
    before.update({"sold_qty": "ly_sold_qty", "st_sold_qty": "ly_st_sold_qty"})
    for mark in CHANNELS:
        before[f"next_{mark}ros"] = f"exp_{mark}1mo"
        before.update({f"f{n}_next_{mark}ros": f"exp_{mark}{n + 1}mo" for n in range(1, 5)})
    compared = prior_year(momentum, ["secn"], before).where(F.col("min_dt") == F.lit(last_week))
    months = [f"exp_{mark}{n}mo" for mark in CHANNELS for n in range(1, 6)]
    scaled = {name: (F.col(name) * MONTH).cast(RATE) for name in months}
    rebased = {
        "mo_reb": rate(F.col("ros"), F.col("ly_ros")), "wk_reb": rate(F.col("sold_qty"), F.col("ly_sold_qty")),
        "mo_sreb": rate(F.col("sros"), F.col("ly_sros")),
        "wk_sreb": rate(F.col("st_sold_qty"), F.col("ly_st_sold_qty")),
    }
    moves = [f"d{n}_{mark}ros" for mark in CHANNELS for n in (1, 2)]
    rate_columns = [name for mark in CHANNELS for name in (f"{mark}ros", f"ly_{mark}ros")]
    return compared.withColumns({**scaled, **rebased}).select(
        "yr", "wk", "min_dt", "cap", "secn", *rate_columns, *months, *rebased, *moves
    )


def rates_output(expected: DataFrame) -> DataFrame:
    """Rates per channel beside last year's and the expected weekly rate of the next three months."""
    quarter = {
        f"{mark}_next_3mo": (sum(F.col(f"exp_{mark}{n}mo") for n in (1, 2, 3)).cast("double") / 12.0).cast(RATE)
        for mark in ("s", "o", "w")
    }
    return expected.select(
        "yr", "wk", "min_dt", "cap", "secn", "ly_sros", "sros", "ly_oros", "oros", "ly_wros", "wros",
        *[value.alias(name) for name, value in quarter.items()],
    )


def ships_by_program(tiers, section_map: DataFrame, as_of: date, spark: SparkSession) -> DataFrame:
    """Quantity and titles shipped per section label and week, in total, as reorders and wholesale."""
    end = last_sunday(as_of)
    start = end - timedelta(weeks=TITLE_WEEKS)
    sections = sections_of(section_map).select("section", "secn")
    order_types = fv.WHOLESALE_ORDER_TYPES + fv.REORDER_ORDER_TYPES
    shipped = shipped_tiers(tiers, order_types, start, end, "TTB").join(sections, "section")
    reorder = F.col("order_type").isin(*fv.REORDER_ORDER_TYPES)
    per_item = shipped.groupBy("secn", "min_dt", "item").agg(
        F.sum("qty").alias("ship_qty"), total_if(reorder, F.col("qty")).alias("tro_ship_qty"),
        total_if(~reorder, F.col("qty")).alias("wh_ship_qty"),
        F.max(reorder).alias("is_reorder"), F.max(~reorder).alias("is_wholesale"),
    )
    sums = per_item.groupBy("secn", "min_dt").agg(
        F.sum("ship_qty").alias("ship_qty"), F.count("*").alias("ship_its"),
        F.sum("tro_ship_qty").alias("tro_ship_qty"), F.count_if("is_reorder").alias("tro_ship_its"),
        F.sum("wh_ship_qty").alias("wh_ship_qty"), F.count_if("is_wholesale").alias("wh_ship_its"),
    )
    weeks = week_table(spark, start, end).select("yr", "wk", "min_dt")
    spine = dense_spine(sections.select("secn").where(F.col("secn").isNotNull()).distinct(), weeks)
    dense = attach(spine, sums, ["secn", "min_dt"], [c for c in sums.columns if c not in ("secn", "min_dt")])
    return dense.withColumn("weeks_off", week_boundaries(F.lit(end), F.col("min_dt")))


def before_after(ships: DataFrame) -> DataFrame:
    """Titles and quantity per week for the last month and four months, beside last year's before and after."""
    over = series(["secn"])
    year = 52
    frames = {
        "ly_1m": (-year - 3, -year, MONTH), "next_ly_1m": (1 - year, 4 - year, MONTH), "cr_1m": (-3, 0, MONTH),
        "ly_4m": (-year - 15, -year, QUARTER_ROWS), "next_ly_4m": (1 - year, 16 - year, QUARTER_ROWS),
        "cr_4m": (-15, 0, QUARTER_ROWS),
    }
    columns = {}
    for measure, mark in (("ship_its", "its"), ("ship_qty", "qty")):
        for name, (first, last, divisor) in frames.items():
            columns[f"{name}_{mark}"] = frame_rate(measure, over, first, last, divisor)
    framed = ships.withColumns(columns).where(F.col("weeks_off") == -1)
    return framed.select("yr", "min_dt", "secn", *columns)


def program_section_rates(merged: DataFrame, section_map: DataFrame, schemes: DataFrame, group: str = "TRO") -> DataFrame:
    """Items, rates and quantities per section of a reorder group, split into active and inactive items."""
    active, idle = F.col("active") == "active", F.col("active") == "inac"
    cr_sold, at_sold = F.col("cr_sold_qty") > 0, F.col("at_sold_qty") > 0

    def rates_if(test: Column | None, *names: str, mark: str = "") -> list[Column]:
        return [(F.sum(n) if test is None else total_if(test, F.col(n))).cast(RATE).alias(mark + n) for n in names]

    def counts_if(test: Column | None, *names: str, mark: str = "") -> list[Column]:
        return [(F.sum(n) if test is None else total_if(test, F.col(n))).alias(mark + n) for n in names]

    sums = merged.where(F.col("rord_grp") == group).groupBy("rord_grp", "cap", "goal_grp", "secn").agg(
        F.count("rpt_it").alias("items"), F.count_if(active).alias("ac_items"),
        F.count_if(idle & cr_sold).alias("ia_cr_items"), F.sum("lgi").alias("lgi"),
        *rates_if(None, "cr_ros", "cr_wh_ros", "at_ros", "at_zid_ros"),
        *rates_if(active, "cr_ros", "cr_wh_ros", "at_ros", "at_zid_ros", "at_wh_ros", mark="ac_"),
        *rates_if(idle & cr_sold, "cr_ros", "cr_wh_ros", mark="ia_"),
        *rates_if(idle & at_sold, "at_ros", "at_wh_ros", mark="ia_"),
        *counts_if(None, "cr_sold_qty", "at_sold_qty"),
        *counts_if(active, "cr_sold_qty", "cr_wh_sold_qty", "at_sold_qty", "at_wh_sold_qty", mark="ac_"),
        *counts_if(idle, "cr_sold_qty", "cr_wh_sold_qty", "at_sold_qty", "at_wh_sold_qty", mark="ia_"),
    )
    defaults = sections_of(section_map).select(F.col("section").alias("secn"), "default_scheme")
    sizes = schemes.select(F.col("scheme_id").alias("default_scheme"), F.col("total_scheme_qty").alias("scheme_qty"))
    return sums.join(defaults, "secn").join(sizes, "default_scheme", "left")


def open_receipts(src: Sources) -> DataFrame:
    """Unreceived receipt lines of warehouse goods and reorder programs, summed per receipt and item."""
    headers, details = src.wh_receipt_tiers[0]
    rows = open_receipt_rows(headers.where(F.left("receipt_id", F.lit(3)) != "HRO"), details)
    rows = rows.groupBy("receipt_id", "item", "company", "item_category1", "item_desc", "receipt_date", "ship_from").agg(
        F.sum("total_qty").alias("qty")
    )
    sections = sections_of(src.section_map).select(F.col("section").alias("item_category1"), "secn")
    groups = src.item_master.where(F.col("rord_grp").isin("CDC", "TRO")).select("item_code", "rord_grp")
    goods = src.products.select("item_code", "cost", "price")
    keyed = rows.withColumn("item_code", pad_code(F.col("item")))
    return (
        keyed.join(sections, "item_category1").join(groups, "item_code").join(goods, "item_code")
        .groupBy("company", "secn", "rord_grp", "receipt_id", F.to_date("receipt_date").alias("receipt_dt"),
                 F.col("ship_from").alias("vendor"), "item", F.col("item_desc").alias("title"), "cost", "price")
        .agg(F.sum("qty").alias("qty"))
    )


def channel_series(src: Sources, facts: Sources, as_of: date, wholesale_from: date | None = None) -> DataFrame:
    """All channels per section and week; wholesale counts from the first week of the report unless a date is given."""
    weeks = report_weeks(src.section_map.sparkSession, as_of)
    wholesale_from = wholesale_from or weeks.agg(F.min("min_dt")).first()[0]
    return combine_channels(
        section_weeks(src.section_map, weeks), store_channel(facts.new_goods), online_channel(facts.online),
        wholesale_channel(src.wh_shipment_tiers, wholesale_from),
    )


def section_rates(src: Sources, facts: Sources, as_of: date, wholesale_from: date | None = None) -> dict[str, DataFrame]:
    """The four outputs: channel rates, title counts, program rates and open receipts."""
    spark = src.section_map.sparkSession
    last_week = last_sunday(as_of) - timedelta(weeks=1)
    base_year = retail_year_week(last_week)[0] - 1
    series_frame = staged(channel_series(src, facts, as_of, wholesale_from), "channel-series")
    expected = expected_sales(rate_momentum(rates(series_frame), base_year), last_week)
    ships = ships_by_program(src.wh_shipment_tiers, src.section_map, as_of, spark)
    return {
        "rates": rates_output(expected),
        "title_counts": before_after(ships).where(F.col("secn") != "0"),
        "program_rates": program_section_rates(src.rates, src.section_map, src.scheme_header),
        "open_receipts": open_receipts(src),
    }
