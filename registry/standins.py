"""Retail source tables derived from the given test tables.

The test tables are orders, order lines, parts, suppliers, customers and events. Each function below derives one
retail table from them with plain expressions, so that every job runs over whole tables. ``oracle.py`` states the
same derivations in SQL.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweek.functions.dates import week_start, with_year_week
from shelfweek.functions.measures import MONEY
from shelfweek.plans.merged_rates import merged_rates
from shelfweek.sources.tables import Sources, literal_rows, union_tiers

AS_OF = date(2001, 11, 11)  # the day that reports with a "current" period are made on
REFUND_DAYS = 7  # the longest time from an online sale to its refund
LIVE_FROM = date(2000, 1, 1)
ARCHIVE_FROM = date(1997, 1, 1)

PRODUCT_TYPES = {"ECONOMY": "HBF", "LARGE": "TRF", "MEDIUM": "NBAF", "PROMO": "PRMO", "SMALL": "CALF",
                 "STANDARD": "BDGF"}
BUY_TYPES = {"1": "HBF", "2": "TRF", "3": "NBAF", "4": "CALF", "5": "BDGF"}
VENDORS = {"ring": "IDINGRAMDI", "bolt": "IDB&TDISTR", "gear": "IDCDCSPECU", "anvil": "IDTXBKSTAP"}
BOUGHT_FROM = {"small": "IDAURORA", "red": "TEXASBKMNB", "blue": "IDCDCSPECU", "hot": "WHPBSUPPLY"}
MASTER_VENDORS = {"ECONOMY": "BS-i", "LARGE": "BS-r", "MEDIUM": "CDC", "PROMO": "Inac", "SMALL": "TEXASBKMNA",
                  "STANDARD": "IDAURORA"}
MASTER_GROUPS = {"ECONOMY": "BS", "LARGE": "BS", "MEDIUM": "CDC", "PROMO": "HRO", "SMALL": "TRO", "STANDARD": "HRO"}
ORDER_TYPES = {1: "HPB Titles", 2: "TTB WHOLESALE", 3: "TTB Initial", 4: "HPB REORDERS", 5: "SUPPLIES",
               6: "WEBORDER", 7: "TTB Reorders"}
SUBJECT_LABEL = ("B", "Subjects only")  # cap and label of a subject that no section shares
COMPANIES = {"A": "HPB", "N": "TTB", "R": "SUP"}


def mapped(column: Column, values: dict, otherwise: Column | None = None) -> Column:
    chain = None
    for key, value in values.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain.otherwise(otherwise) if otherwise is not None else chain


def money(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def padded(column: str, width: int) -> Column:
    """Digits with leading zeros; longer numbers keep all their digits."""
    digits = F.col(column).cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


class Retail(Sources):
    """Raw tables by their own names and derived retail tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self._raw = lambda name: spark.read.parquet(f"{root}/{name}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        builder = globals().get(f"_{name}")
        self[name] = builder(self) if builder else self._raw(name)
        return self[name]

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


# --- shared ---------------------------------------------------------------------------------------

def _order_store(s):
    """Orders with the customer's nation as store and that nation's region as second store."""
    places = s.customer.join(s.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), padded("c_nationkey", 5).alias("store"),
        padded("n_regionkey", 5).alias("region_store"), F.col("c_mktsegment").alias("segment"),
    )
    orders = s.orders.withColumn("priority", F.left("o_orderpriority", F.lit(1)))
    return orders.join(places, "o_custkey")


def _line_store(s):
    """Order lines with the supplier's nation as store."""
    places = s.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey",
                               padded("s_nationkey", 5).alias("store"))
    return s.lineitem.join(places, "l_suppkey").withColumn("q", F.col("l_quantity").cast("int"))


def _report_keys(s):
    """The smallest part key of each name and brand stands for the parts that share them."""
    first = s.part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("report_key"))
    return s.part.join(first, ["p_name", "p_brand"])


# --- dimensions -----------------------------------------------------------------------------------

def _products(s):
    words = F.split("p_name", " ")
    return s.report_keys.select(
        padded("p_partkey", 20).alias("item_code"),
        F.when(F.col("report_key") == F.col("p_partkey"), "").otherwise(padded("report_key", 20)).alias(
            "report_item_code"),
        F.col("p_brand").alias("section_code"),
        mapped(F.col("p_type"), PRODUCT_TYPES).alias("product_type"),
        mapped(words[1], VENDORS, F.lit("IDOTHER")).alias("vendor_id"),
        mapped(words[0], BOUGHT_FROM, F.lit("IDTOYSMITH")).alias("purchase_from_vendor_id"),
        F.when((words[0] == "red") | (words[0] == "new"), "TTB").otherwise("").alias("user_char15"),
        F.when(F.col("p_size") > 25, "Y").otherwise("N").alias("reorderable"),
        F.when(F.col("p_retailprice") > 950, "Y").otherwise("N").alias("reorderable_item"),
        F.when(F.col("p_size") > 40, "").otherwise(F.concat(F.lit("978"), padded("p_partkey", 10))).alias("isbn"),
        F.concat(F.lit("555"), padded("p_partkey", 12)).alias("upc"),
        F.col("p_name").alias("title"),
        money("p_retailprice").alias("price"),
        money("p_size").alias("cost"),
    )


def _product_types(s):
    types = s.products.select("product_type").distinct()
    return types.withColumn("p_type_class", F.when(F.col("product_type") == "CALF", "USED").otherwise("NEW"))


def _vendors(s):
    ids = s.products.select(F.col("vendor_id")).union(s.products.select("purchase_from_vendor_id")).distinct()
    return ids.withColumn("user_char30", F.when(F.col("vendor_id").startswith("TEXAS"), "TTBReorder").otherwise(""))


def _base_inventory(s):
    return s.part.where("p_size = 50").select(padded("p_partkey", 20).alias("item_code"))


def _locations(s):
    return s.nation.select(F.col("n_nationkey").cast("string").alias("location_id"),
                           padded("n_nationkey", 5).alias("location_no"))


def _section_map(s):
    section = F.col("p_brand")
    cap = F.when(section < "Brand#2", "A").otherwise("B")
    secn = mapped(section, {"Brand#10": "Brand#1", "Brand#20": "Brand#2"}, section)
    brands = s.part.select("p_brand").distinct()
    shared = [cap.alias("cap"), cap.alias("goal_grp"), secn.alias("secn"),
              F.when(section < "Brand#2", "TEXASBKNON").alias("ttb_vendor"), section.alias("default_scheme")]
    null = F.lit(None).cast("string")
    alone = literal_rows(s.part.sparkSession, [(None, "ALONE", SUBJECT_LABEL[0], SUBJECT_LABEL[0], SUBJECT_LABEL[1], None, None)],
                         "section string, subj string, cap string, goal_grp string, secn string, ttb_vendor string, default_scheme string")
    return brands.select(section.alias("section"), null.alias("subj"), *shared).unionByName(
        brands.select(null.alias("section"), section.alias("subj"), *shared)).unionByName(alone)


def _item_master(s):
    code = padded("p_partkey", 20)
    return s.part.select(code.alias("item_code"), code.alias("item"),
                         mapped(F.col("p_type"), MASTER_VENDORS).alias("vendor"),
                         mapped(F.col("p_type"), MASTER_GROUPS).alias("rord_grp"))


def _stored_master(s):
    """A master from before the larger sizes were listed, when everything counted as warehouse goods."""
    code = padded("p_partkey", 20)
    return s.part.where("p_size <= 25").select(code.alias("item_code"), code.alias("item"), F.lit("CDC").alias("vendor"),
                                              F.lit("CDC").alias("rord_grp"))


def _scheme_header(s):
    return s.part.groupBy(F.col("p_brand").alias("scheme_id")).agg(F.count("*").alias("total_scheme_qty"))


def _store_dim(s):
    return s.nation.join(s.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        padded("n_nationkey", 5).alias("location_no"), F.col("r_name").alias("region_name"),
        F.col("r_name").alias("district_name"), F.col("n_name").alias("media_market"))


# --- store transactions ---------------------------------------------------------------------------

def _shipment_header(s):
    return s.order_store.select(
        F.col("o_orderkey").alias("transfer_id"),
        F.when(F.col("o_orderstatus") == "P", "00900").otherwise("00944").alias("from_location_no"),
        F.col("store").alias("to_location_no"), F.col("o_orderdate").alias("date_transferred"))


def _shipment_detail(s):
    return s.lineitem.select(F.col("l_orderkey").alias("transfer_id"), padded("l_partkey", 20).alias("item_code"),
                             F.col("l_quantity").cast("int").alias("qty"), money("l_extendedprice").alias("cost_each"))


def _receiving_header(s):
    return s.order_store.select(
        F.col("o_orderkey").alias("batch_id"), F.col("store").alias("location_no"),
        mapped(F.col("o_orderstatus"), {"F": "R", "O": "W"}, F.lit("X")).alias("shipment_type"))


def _receiving_detail(s):
    return s.lineitem.select(F.col("l_orderkey").alias("batch_id"), padded("l_partkey", 20).alias("item_code"),
                             F.col("l_quantity").cast("int").alias("qty"), F.col("l_shipdate").alias("process_date"))


def _sales(s):
    unit = money("l_extendedprice")
    register = (unit - money("l_discount")).cast(MONEY)
    return s.line_store.select(
        F.col("s_nationkey").cast("string").alias("location_id"), padded("l_partkey", 20).alias("item_code"),
        F.concat(F.lit("1"), padded("l_partkey", 9)).alias("serial_code"),
        mapped(F.col("l_returnflag"), {"R": "y", "N": "n"}).alias("is_return"),
        F.col("q").alias("quantity"), unit.alias("unit_price"), register.alias("register_price"),
        F.when(F.col("l_returnflag") == "R", -register).otherwise(register).alias("extended_amt"),
        F.when(F.col("l_linestatus") == "O", "A").otherwise("V").alias("status"),
        F.to_date("l_shipdate").alias("business_date"),
        F.col("l_orderkey").alias("sales_xaction_id"), F.col("l_linenumber").cast("string").alias("xaction_type"))


def _sales_line(s):
    return s.sales.drop("serial_code")


def _transfer_header(s):
    digit = F.col("priority").cast("int")
    partial = F.when(digit <= 2, 6).when(digit <= 4, 7).otherwise(8)
    late = (F.col("priority") == "5") & (F.col("o_orderstatus") == "O")
    return s.order_store.select(
        F.col("o_orderkey").alias("transfer_bin_no"), F.col("store").alias("location_no"),
        F.col("region_store").alias("to_location_no"),
        F.when(F.col("o_orderstatus") == "P", partial).otherwise(digit).alias("transfer_type"),
        F.when(late, 2).otherwise(3).alias("status_code"), F.col("o_orderdate").alias("update_time"))


def _transfer_detail(s):
    return s.lineitem.select(
        F.col("l_orderkey").alias("transfer_bin_no"), padded("l_partkey", 20).alias("dips_item_code"),
        F.concat(F.lit("1"), padded("l_partkey", 9)).alias("sips_item_code"),
        F.col("l_quantity").cast("int").alias("quantity"), (money("l_discount") * 1000).cast(MONEY).alias("dips_cost"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("status_code"))


def _buys(s):
    return s.order_store.select(
        F.col("store").alias("location_no"), mapped(F.col("priority"), BUY_TYPES).alias("buy_type"),
        F.when(F.col("o_orderstatus") == "P", "V").otherwise("A").alias("status"),
        F.dayofmonth("o_orderdate").alias("quantity"), money("o_totalprice").alias("line_offer"),
        money("o_totalprice").alias("total_offer"), F.col("o_orderdate").alias("end_date"))


# --- serialised goods -----------------------------------------------------------------------------

def _serial_inventory(s):
    first = s.lineitem.groupBy("l_partkey").agg(F.min("l_shipdate").alias("date_in_stock"))
    parts = s.part.join(first, F.col("p_partkey") == F.col("l_partkey"))
    place = F.floor(F.col("p_size") / 2).cast("int")
    return parts.select(
        F.col("p_partkey").cast("int").alias("item_code"), F.lpad(place.cast("string"), 5, "0").alias("location_no"),
        place.cast("string").alias("location_id"), F.col("p_partkey").alias("sips_id"),
        F.col("p_brand").alias("subject_key"),
        F.when(F.col("p_type") == "ECONOMY", "NOST").otherwise(mapped(F.col("p_type"), PRODUCT_TYPES)).alias(
            "product_type"),
        (money("p_retailprice") * F.col("p_size")).cast(MONEY).alias("price"), "date_in_stock")


def _serial_master(s):
    return s.part.where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("sips_id"))


def _subjects(s):
    return s.part.select(F.col("p_brand").alias("subject_key")).distinct()


def _price_changes(s):
    """Price log of each part at the store that holds it."""
    held = s.serial_inventory.select("item_code", "location_no")
    return s.lineitem.join(held, F.col("l_partkey") == F.col("item_code")).select(
        "item_code", "location_no", money("l_quantity").alias("old_price"),
        (money("l_discount") * 100).cast(MONEY).alias("new_price"), F.col("l_shipdate").alias("modified_time"))


def _serial_sales_line(s):
    return s.sales.drop("item_code").withColumnRenamed("serial_code", "item_code")


def _sales_header(s):
    states = s.orders.select(F.col("o_orderkey").alias("sales_xaction_id"),
                             F.when(F.col("o_orderstatus") == "P", "V").otherwise("A").alias("status"))
    keys = s.sales.select("location_id", "business_date", "sales_xaction_id", "xaction_type").distinct()
    return keys.join(states, "sales_xaction_id").withColumn("end_date", F.col("business_date").cast("timestamp_ntz"))


# --- online ---------------------------------------------------------------------------------------

def _event_rows(s):
    k = F.get_json_object("props", "$.k")
    day = F.date_format("ts", "yyyyMMdd")
    value = money("value")
    return s.events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props", k.alias("k"),
        F.concat_ws("-", F.col("user_id").cast("string"), day).alias("order_no"),
        (F.floor(F.col("value") / 100) + 1).cast("int").alias("qty"), value.alias("amount"),
        F.when(F.col("value") > 100, value).otherwise(F.lit(0).cast(MONEY)).alias("refund"),
        F.col("user_id").cast(MONEY).alias("fee"))


def _sku(new_type: str) -> Column:
    return F.when(F.col("event_type") == new_type, F.concat(F.lit("D"), F.lpad("k", 20, "0"))).otherwise(
        F.concat(F.lit("S_"), F.col("k"))).alias("sku")


def _orders_marketplace(s):
    return s.event_rows.where(F.col("event_type").isin("purchase", "signup")).select(
        F.col("user_id").alias("facility_id"), F.col("event_id").alias("isis_order_id"),
        F.col("order_no").alias("market_order_id"), _sku("purchase"),
        F.when(F.col("value") < 1, "Cancelled").otherwise("Shipped").alias("order_status"),
        F.col("qty").alias("shipped_quantity"), F.col("amount").alias("price"), F.col("fee").alias("shipping_fee"),
        F.col("refund").alias("refund_amount"), F.col("ts").alias("order_date"),
        (F.col("ts") + F.expr("interval 7 days")).alias("refund_date"))


def _orders_web(s):
    return s.event_rows.where(F.col("event_type").isin("click", "error")).select(
        F.col("user_id").alias("facility_id"), F.col("order_no").alias("market_order_id"), _sku("click"),
        F.when(F.col("value") < 1, "Canceled").otherwise("open").alias("order_status"),
        F.when(F.col("value") < 2, "canceled ").otherwise("open").alias("item_status"),
        F.col("qty").alias("quantity"), F.col("amount").alias("item_price"),
        (F.col("amount") * F.col("qty")).cast(MONEY).alias("extended_amount"), F.col("fee").alias("shipping_amount"),
        F.col("refund").alias("item_refund_amount"), F.col("ts").alias("order_date"),
        (F.col("ts") + F.expr("interval 3 days")).alias("site_last_modified_date"))


def _marketplace_detail(s):
    return s.event_rows.where("event_type = 'view'").select(
        F.left("k", F.lit(1)).alias("server_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(" ")).alias("location_no"),
        F.col("order_no").alias("market_order_id"), F.concat(F.lit("M"), F.col("k")).alias("sku"),
        F.when(F.col("value") < 5, "Cancelled").otherwise("Shipped").alias("status"),
        F.col("qty").alias("shipped_quantity"), F.col("amount").alias("price"), F.col("fee").alias("shipping_fee"),
        F.col("refund").alias("refund_amount"), F.col("ts").alias("order_date"),
        (F.col("ts") + F.expr("interval 5 days")).alias("last_status_modified"))


def _facilities(s):
    return s.events.select(F.col("user_id").alias("facility_id"), padded("user_id", 5).alias("store_no")).distinct()


def _fulfil_header(s):
    return s.event_rows.where(F.col("event_type").isin("purchase", "signup")).select(
        F.col("event_id").alias("order_id"), F.col("event_id").alias("isis_order_id"),
        F.when(F.left("k", F.lit(1)) == "9", "SAS").otherwise("MON").alias("order_system"))


def _fulfil_detail(s):
    return s.event_rows.where(F.col("event_type").isin("purchase", "signup")).select(
        F.col("event_id").alias("order_id"), F.lpad("k", 5, "0").alias("location_no"),
        F.when(F.col("value") > 5, 1).otherwise(2).alias("status"),
        F.when(F.col("value") > 200, 3).when(F.col("value") > 100, 0).alias("problem_status_id"),
        F.col("amount").alias("price"))


def _avg_cost(s):
    """Average cost per store, product type and month; the month runs ahead of the sales by twenty days."""
    goods = s.serial_inventory.select(F.col("item_code").cast("string").alias("k"), "product_type", "sips_id")
    sizes = s.part.select(F.col("p_partkey").alias("sips_id"), "p_size")
    rows = s.event_rows.join(goods, "k").join(sizes, "sips_id")
    return rows.groupBy(
        padded("user_id", 5).alias("location_no"), "product_type",
        F.trunc(F.date_add(F.to_date("ts"), 20), "month").alias("first_day_of_month"),
    ).agg(F.count("*").alias("quantity"), F.max("p_size").cast(MONEY).alias("cost"))


def _cost_factors(s):
    types = s.serial_inventory.select("product_type").distinct()
    return types.withColumn("cog_factor", (F.length("product_type") * 10).cast(MONEY))


# --- warehouse ------------------------------------------------------------------------------------

def _wh_shipment_header(s):
    segments = {"HOUSEHOLD": "HPB", "MACHINERY": "HPB", "FURNITURE": "RETAIL"}
    return s.order_store.select(
        F.col("o_orderkey").alias("internal_shipment_num"), mapped(F.col("segment"), segments, F.col("segment")).alias(
            "customer"), F.col("o_orderdate").alias("actual_ship_date_time"), F.col("store").alias("ship_to"))


def _wh_shipment_detail(s):
    brands = s.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item_category1"))
    return s.lineitem.join(brands, "l_partkey").select(
        F.col("l_orderkey").alias("internal_shipment_num"), F.col("l_partkey").cast("string").alias("item"),
        mapped(F.col("l_linenumber"), ORDER_TYPES).alias("order_type"),
        mapped(F.col("l_returnflag"), COMPANIES).alias("company"),
        F.when(F.col("l_linestatus") == "O", "HPB").otherwise("RETAIL").alias("customer"), "item_category1",
        F.col("l_quantity").cast("int").alias("total_qty"), (F.col("l_linenumber") * 130).alias("status1"),
        F.col("l_shipdate").alias("date_time_stamp"))


def _wh_shipment_tiers(s):
    stamp = F.col("actual_ship_date_time")
    return [(heads, s.wh_shipment_detail) for heads in _by_age(s.wh_shipment_header, stamp)]


def _by_age(df: DataFrame, stamp: Column) -> list[DataFrame]:
    return [df.where(stamp >= F.lit(LIVE_FROM)),
            df.where((stamp >= F.lit(ARCHIVE_FROM)) & (stamp < F.lit(LIVE_FROM))),
            df.where(stamp < F.lit(ARCHIVE_FROM))]


def _wh_item(s):
    return s.part.select(
        F.col("p_partkey").cast("string").alias("item"),
        F.when(F.col("p_type") == "PROMO", "Puzzles").otherwise(F.col("p_brand")).alias("item_category1"),
        mapped(F.col("p_type"), PRODUCT_TYPES).alias("item_category2"), F.col("p_brand").alias("item_category3"),
        F.col("p_name").alias("description"), F.concat(F.lit("ST"), F.col("p_partkey").cast("string")).alias(
            "item_style"), money("p_size").alias("user_def4"), money("p_retailprice").alias("net_price"))


def _wh_item_types(s):
    return s.part.where("p_size > 45").select(F.col("p_partkey").cast("string").alias("item_code"),
                                             F.lit("NBAF").alias("prod_type"))


def _section_caps(s):
    brand = F.col("p_brand")
    cap = F.when(brand < "Brand#2", "A").when(brand == "Brand#25", "SNL").when(brand != "Brand#24", "B")
    return s.part.select(brand.alias("identifier"), cap.alias("user1_value")).distinct()


def _wh_inventory(s):
    back = F.col("l_returnflag") == "R"
    rows = s.line_store.groupBy("l_partkey", "l_suppkey", "s_nationkey").agg(
        F.sum(F.when(~back, F.col("q")).otherwise(0)).alias("on_hand_qty"),
        F.sum(F.when(back, F.col("q")).otherwise(0)).alias("allocated_qty"),
        F.sum(F.when(F.col("l_tax") > 0.07, 1).otherwise(0)).alias("suspense_qty"),
        F.count("*").alias("in_transit_qty"), F.min("l_shipdate").alias("received_date"))
    company = F.when(F.col("s_nationkey") < 10, "TTB").when(F.col("s_nationkey") < 20, "HPB").otherwise("SUP")
    return rows.select(F.col("l_partkey").cast("string").alias("item"),
                       F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("location"),
                       company.alias("company"), "on_hand_qty", "allocated_qty", "suspense_qty", "in_transit_qty",
                       "received_date")


def _wh_location(s):
    return s.supplier.select(F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("location"),
                             F.when(F.col("s_acctbal") > 2000, "Inventory").otherwise("Dock").alias("location_class"))


def _wh_receipt_header(s):
    """Receipts of all but the most urgent orders."""
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 3 days"))
    return s.orders.where("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("internal_receipt_num"),
        F.concat(F.lit("P"), padded("o_orderkey", 6), F.lit(".01")).alias("receipt_id"),
        F.col("o_orderpriority").alias("ship_from"), F.col("o_orderstatus").alias("receipt_type"),
        closed.alias("close_date"), F.col("o_orderdate").alias("receipt_date"),
        F.col("o_orderdate").alias("creation_date_time_stamp"))


def _wh_receipt_detail(s):
    goods = s.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item_category1"),
                          F.col("p_name").alias("item_desc"))
    order = F.concat(F.lit("P"), padded("l_orderkey", 6))
    return s.lineitem.where("l_linenumber <= 5").join(goods, "l_partkey").join(
        s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderdate"), "l_orderkey"
    ).where("o_orderpriority <> '1-URGENT'").select(
        F.col("l_orderkey").alias("internal_receipt_num"), F.concat(order, F.lit(".01")).alias("receipt_id"),
        F.col("l_partkey").cast("string").alias("item"), order.alias("purchase_order_id"),
        mapped(F.col("l_returnflag"), COMPANIES).alias("company"), "item_category1",
        F.concat(F.lit("Sch"), F.col("l_linenumber").cast("string")).alias("item_category3"), "item_desc",
        F.col("l_quantity").cast("int").alias("total_qty"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int")).otherwise(0).alias("open_qty"),
        F.col("l_shipdate").alias("date_time_stamp"), F.col("l_shipdate").alias("receipt_date"), "o_orderdate")


def _wh_receipt_tiers(s):
    heads = _by_age(s.wh_receipt_header, F.col("receipt_date"))
    details = _by_age(s.wh_receipt_detail, F.col("o_orderdate"))
    return list(zip(heads, [d.drop("o_orderdate") for d in details]))


def _wh_po_header(s):
    return s.orders.select(
        F.concat(F.lit("P"), padded("o_orderkey", 6)).alias("purchase_order_id"),
        F.col("o_orderpriority").alias("ship_from"), F.col("o_orderstatus").alias("receipt_type"),
        F.col("o_orderdate").alias("created_date_time"))


def _wh_po_detail(s):
    """Lines meet their orders on the text number, by which readers join them too."""
    def number(column: str) -> Column:
        return F.concat(F.lit("P"), padded(column, 6)).alias("purchase_order_id")

    lines = s.lineitem.select(number("l_orderkey"), "l_partkey", "l_returnflag", "l_linenumber",
                              F.col("l_quantity").cast("int").alias("total_quantity"), "l_shipdate")
    return lines.join(s.orders.select(number("o_orderkey"), "o_orderdate"), "purchase_order_id").select(
        "purchase_order_id", F.col("l_partkey").cast("string").alias("item"),
        mapped(F.col("l_returnflag"), COMPANIES).alias("company"),
        F.concat(F.lit("Sch"), F.col("l_linenumber").cast("string")).alias("item_category3"),
        "total_quantity", F.col("l_shipdate").alias("date_time_stamp"), "o_orderdate")


def _wh_po_tiers(s):
    heads, details = s.wh_po_header, s.wh_po_detail
    live, dated = F.col("created_date_time") >= F.lit(LIVE_FROM), F.col("o_orderdate") >= F.lit(LIVE_FROM)
    return [(heads.where(live), details.where(dated).drop("o_orderdate")),
            (heads.where(~live), details.where(~dated).drop("o_orderdate"))]


def _purchase_order_register(s):
    return s.lineitem.where("l_tax < 0.07").select(padded("l_orderkey", 6).alias("po_number"),
                                                  padded("l_partkey", 20).alias("item_code"))


def _order_detail(s):
    return s.lineitem.select(
        padded("l_partkey", 20).alias("item_code"),
        F.concat(F.lit("P"), padded("l_orderkey", 6)).alias("po_number"),
        F.concat("l_linestatus", "l_returnflag").alias("special_instructions"))


# --- movements and orders -------------------------------------------------------------------------

def _ledger(s):
    kind = F.concat("l_linestatus", "l_returnflag")
    kinds = {"OA": "CDC", "ON": "Sale", "OR": "Rtrn", "FA": "Drps", "FN": "iSale"}
    sale = kind.isin("ON", "FN")
    code = padded("l_partkey", 20)
    return s.line_store.select(code.alias("item_code"), code.alias("item"), F.col("store").alias("loc"),
                               mapped(kind, kinds, F.lit("Move")).alias("xacn"),
                               F.when(sale, -F.col("q")).otherwise(F.col("q")).alias("qty"),
                               F.col("l_shipdate").alias("date"))


def _ledger_items(s):
    """Report item of every part but the promotional ones."""
    return s.report_keys.where("p_type <> 'PROMO'").select(
        padded("p_partkey", 20).alias("item_code"), padded("report_key", 20).alias("rpt_it"))


def _reorder_items(s):
    return s.report_keys.where("p_size > 25").select(
        padded("p_partkey", 20).alias("item_code"), padded("report_key", 20).alias("rpt_it"))


def _order_base(s):
    rows = s.line_store.groupBy("l_partkey", F.col("store").alias("loc")).agg(
        F.count("*").alias("lines"), F.sum("q").alias("sold_qty"), F.max("l_shipdate").alias("max_dt"))
    return rows.select(padded("l_partkey", 20).alias("rpt_it"), "loc", F.col("lines").alias("lgi"), "sold_qty",
                       (F.col("lines") * F.lit(0.125)).alias("ros"), F.col("lines").cast("double").alias("z_ros"),
                       "max_dt")


def _order_equivs(s):
    rows = s.line_store.groupBy("l_partkey").agg(F.count_distinct("store").alias("stores"))
    return rows.select(padded("l_partkey", 20).alias("item_code"), (F.col("stores") * F.lit(0.25)).alias("avg_ros"))


def _suggested_orders(s):
    return s.line_store.select(
        F.when(F.col("l_linestatus") == "O", 51).otherwise(36).alias("set_id"),
        padded("l_partkey", 20).alias("rpt_it"), F.col("store").alias("loc"),
        F.when(F.col("l_tax") > 0.01, F.col("q")).otherwise(0).alias("order_qty"))


def _rates(s):
    """Merged rates per report item, as the rate job stores them."""
    return merged_rates(s, AS_OF, months=9, years=6)


# --- stored facts for the reports -----------------------------------------------------------------

def _fact_lines(s):
    """Order lines by week and store with the flags the fact columns are summed from."""
    rows = s.line_store.join(s.products.withColumn("l_partkey", F.col("item_code").cast("bigint")), "l_partkey")
    return rows.select(
        week_start(F.col("l_shipdate")).alias("min_dt"), F.col("store").alias("loc_no"), "item_code",
        F.col("section_code").alias("section"), "product_type", "isbn", "upc", "q", money("l_extendedprice").alias("v"),
        (F.col("l_returnflag") == "A").alias("a"), (F.col("l_returnflag") == "N").alias("n"),
        (F.col("l_returnflag") == "R").alias("r"), (F.col("l_linestatus") == "O").alias("o"),
        (F.col("l_discount") > 0.05).alias("m"), F.col("l_linenumber").alias("ln"))


def _sums(**columns) -> list[Column]:
    aggregates = []
    for name, (test, value, kind) in columns.items():
        aggregates.append(F.sum(F.when(F.expr(test), F.col(value)).otherwise(0)).cast(kind).alias(name))
    return aggregates


GOODS = dict(
    ship_qty=("a", "q", "bigint"), ship_cost=("a", "v", MONEY), ship_val=("a and m", "v", MONEY),
    rcv_qty=("n", "q", "bigint"), rcv_cost=("n", "v", MONEY), rcv_val=("n and m", "v", MONEY),
    sold_qty=("o", "q", "bigint"), sold_cost=("o and m", "v", MONEY), sold_val=("o", "v", MONEY),
    md_sold_qty=("o and m", "q", "bigint"), md_cost=("o and m and a", "v", MONEY),
    md_sold_val=("o and m and n", "v", MONEY),
    rfi_qty=("r", "q", "bigint"), rfi_cost=("r", "v", MONEY),
    in_sts_qty=("ln = 3", "q", "bigint"), out_sts_qty=("ln = 4", "q", "bigint"),
)


def _fact_new_goods(s):
    rows = s.fact_lines.groupBy("min_dt", "section", "loc_no").agg(*_sums(**GOODS))
    return with_year_week(rows)


def _fact_frontline(s):
    kind = F.when(F.col("product_type").isin("HBF", "TRF"), "BS").otherwise("Frln").alias("src")
    rows = s.fact_lines.groupBy("min_dt", kind, F.lit("Init").alias("prog"), "section", "loc_no").agg(
        *_sums(**GOODS, rtn_qty=("r and m", "q", "bigint"), rtn_cost=("r and m", "v", MONEY)))
    return with_year_week(rows)


def _fact_base_inventory(s):
    names = ("rfi_qty", "rfi_cost", "in_sts_qty", "out_sts_qty", "sold_qty", "sold_val", "md_sold_qty", "md_sold_val")
    rows = s.fact_lines.groupBy("min_dt", "item_code", "loc_no").agg(
        *_sums(**{name: GOODS[name] for name in names}, buy_qty=("n", "q", "bigint"), buy_cost=("n", "v", MONEY),
               bsm_qty=("ln = 5", "q", "bigint"), bsm_cost=("ln = 5", "v", MONEY)))
    return with_year_week(rows)


def _fact_serial_items(s):
    names = ("rfi_qty", "rfi_cost", "in_sts_qty", "out_sts_qty", "sold_qty", "sold_val", "md_sold_qty", "md_sold_val")
    rows = s.fact_lines.groupBy("min_dt", F.col("section").alias("subj"), "loc_no").agg(
        *_sums(**{name: GOODS[name] for name in names}, made_qty=("n and m", "q", "bigint"),
               made_list=("n and m", "v", MONEY), bsm_qty=("ln = 6", "q", "bigint")))
    return with_year_week(rows)


def _fact_online(s):
    used = F.col("product_type") == "CALF"
    secn = mapped(F.col("section"), {"Brand#10": "Brand#1", "Brand#20": "Brand#2"}, F.col("section"))
    keys = ["min_dt", F.when(used, "Used").otherwise("New").alias("used_new"),
            F.when(used, "SIPS").when(F.col("product_type").isin("HBF", "TRF"), "BS").otherwise("DIPS").alias("src"),
            "loc_no", F.when(F.col("section") < "Brand#2", "A").otherwise("B").alias("cap"), secn.alias("secn"),
            F.when(F.col("o"), "h").otherwise("i").alias("site")]
    rows = s.fact_lines.groupBy(*keys).agg(*_sums(
        sold_qty=("n", "q", "bigint"), sold_cost=("n and m", "v", MONEY), sold_val=("n", "v", MONEY),
        sold_fee=("n", "q", MONEY), rfnd_ords=("r", "ln", "bigint"), rfnd_amt=("r and m", "v", MONEY)))
    return with_year_week(rows)


def _fact_items(s):
    ean = F.coalesce(F.nullif("isbn", F.lit("")), F.left("upc", F.lit(13))).alias("ean")
    kind = F.when(F.col("product_type").isin("HBF", "TRF", "NBAF"), "BS").otherwise("Frln").alias("src")
    rows = s.fact_lines.groupBy("min_dt", ean, "item_code", kind, "loc_no").agg(*_sums(
        ship_qty=("a", "q", "bigint"), rcv_qty=("n", "q", "bigint"), st_sold_qty=("o", "q", "bigint"),
        md_st_sold_qty=("o and m", "q", "bigint"), st_rfnd_qty=("r", "q", "bigint")))
    return with_year_week(rows)


def facts(s: Retail) -> Sources:
    """The stored facts under the names the reports use."""
    return Sources(
        base_inventory=s.fact_base_inventory, serial_items=s.fact_serial_items, new_goods=s.fact_new_goods,
        frontline=s.fact_frontline, online=s.fact_online, section_map=s.section_map, products=s.products,
        store_dim=s.store_dim)


def sales_by_year(s: Retail) -> list[DataFrame]:
    """One shard a year, and one for lines without a date; an empty table is one empty shard."""
    year = F.year("business_date")
    first, last = s.sales_line.agg(F.min(year), F.max(year)).first()
    shards = [s.sales_line.where(year == y) for y in range(first, last + 1)] if first is not None else []
    return [*shards, s.sales_line.where(year.isNull())]


def _covering(*bounds: tuple[DataFrame, Column, Column]) -> tuple[date, int]:
    """(as_of, weeks) of the window that holds all weeks between the first and the last of the given days; one row a table."""
    found = [df.agg(F.min(week_start(first)), F.max(week_start(last))).first() for df, first, last in bounds]
    firsts, lasts = [r[0] for r in found if r[0] is not None], [r[1] for r in found if r[1] is not None]
    if not firsts:
        return AS_OF, 1
    end = max(lasts) + timedelta(weeks=1)
    return end, (end - min(firsts)).days // 7


def order_weeks(s: Retail) -> tuple[date, int]:
    """All weeks of the orders and their lines, as the tables have them."""
    ordered, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    return _covering((s.orders, ordered, ordered), (s.lineitem, shipped, shipped))


def online_weeks(s: Retail) -> tuple[date, int]:
    """All weeks of the events, with those of the refunds that follow."""
    return _covering((s.events, F.col("ts"), F.col("ts") + F.expr(f"interval {REFUND_DAYS} days")))


def all_weeks(s: Retail) -> tuple[date, int]:
    """From the first to the last week of orders and events."""
    windows = [order_weeks(s), online_weeks(s)]
    end, start = max(w[0] for w in windows), min(w[0] - timedelta(weeks=w[1]) for w in windows)
    return end, (end - start).days // 7


__all__ = ["AS_OF", "Retail", "all_weeks", "facts", "online_weeks", "order_weeks", "sales_by_year", "union_tiers"]
