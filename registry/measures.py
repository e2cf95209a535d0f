"""Measures: signed sums, markdowns, transfers, ages, distinct counts, price corrections, cost estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query
from registry.oracle_tables import M, code
from registry.standins import online_weeks, order_weeks
from shelfweek.functions.dates import week_bounds
from shelfweek.functions.measures import age_bucket_sums, any_nonzero, net, net_marked_down, plausible_cost, rate, total
from shelfweek.operators.windows import latest_value
from shelfweek.plans import serial_items, weekly
from shelfweek.plans.online_used import used_cells, with_estimated_cost, serial_events

KINDS = {1: "tsh", 2: "dnt", 3: "out_sts", 4: "bsm", 5: "mkt", 6: "rtn", 7: "dmg"}
PIVOT = ", ".join(
    f"sum(CASE WHEN NOT inbound AND kind = {k} THEN q ELSE 0 END) AS {n}_qty, "
    f"sum(CASE WHEN NOT inbound AND kind = {k} THEN q * cost ELSE 0 END) AS {n}_cost" for k, n in KINDS.items())


@query(
    "min_dt:s loc_no:s in_sts_qty:i in_sts_cost:d " + " ".join(f"{n}_qty:i {n}_cost:d" for n in KINDS.values()),
    f"""SELECT min_dt, loc_no, {PIVOT}, sum(CASE WHEN inbound THEN q ELSE 0 END) AS in_sts_qty,
        sum(CASE WHEN inbound THEN q * cost ELSE 0 END) AS in_sts_cost FROM transfer_ends GROUP BY ALL""",
)
def transfer_pivot(s):
    """Transfers by kind in columns, per week and store."""
    cells = weekly.transfer_cells(weekly.transfer_lines(s, *week_bounds(*order_weeks(s))))
    measures = [name for name in cells.columns if name not in weekly.CELL]
    return cells.groupBy("min_dt", "loc_no").agg(*[F.sum(name).alias(name) for name in measures])


@query(
    "loc_no:s in_sts_qty:i in_sts_cost:d out_sts_qty:i out_sts_cost:d net_sts_qty:i net_sts_cost:d",
    """SELECT *, in_sts_qty - out_sts_qty AS net_sts_qty, in_sts_cost - out_sts_cost AS net_sts_cost FROM (
        SELECT loc_no, sum(CASE WHEN inbound THEN q ELSE 0 END) AS in_sts_qty, sum(CASE WHEN inbound THEN q * cost ELSE 0 END) AS in_sts_cost,
            sum(CASE WHEN NOT inbound AND kind = 3 THEN q ELSE 0 END) AS out_sts_qty,
            sum(CASE WHEN NOT inbound AND kind = 3 THEN q * cost ELSE 0 END) AS out_sts_cost FROM plausible_ends GROUP BY 1)""",
)
def transfer_balance(s):
    """Goods moved in, out and net per store, plausible lines only."""
    cells = weekly.transfer_cells(weekly.transfer_lines(s, *week_bounds(*order_weeks(s)), plausible_only=True))
    return weekly.transfer_balance(cells, ["loc_no"])


@query(
    "loc_no:s net_qty:i net_lines:i net_val:d",
    "SELECT loc_no, sum(sgn * q) AS net_qty, sum(sgn) AS net_lines, sum(sgn * unit) AS net_val FROM sales GROUP BY 1",
)
def net_sales_sign(s):
    flag = F.col("is_return")
    return s.sales_line.join(s.locations, "location_id").groupBy(F.col("location_no").alias("loc_no")).agg(
        F.sum(net(flag, F.col("quantity"))).alias("net_qty"), F.sum(net(flag, F.lit(1))).alias("net_lines"),
        F.sum(net(flag, F.col("unit_price"))).alias("net_val"))


@query(
    "item_code:s md_qty:i md_lines:i md_list:d",
    """SELECT item_code, sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * q ELSE 0 END) AS md_qty,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn ELSE 0 END) AS md_lines,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * unit ELSE 0 END) AS md_list FROM sales GROUP BY 1""",
)
def markdown_sum(s):
    args = [F.col(name) for name in ("is_return", "register_price", "unit_price")]
    return s.sales_line.groupBy("item_code").agg(
        F.sum(net_marked_down(*args, F.col("quantity"))).alias("md_qty"),
        F.sum(net_marked_down(*args, F.lit(1))).alias("md_lines"),
        F.sum(net_marked_down(*args, F.col("unit_price"))).alias("md_list"))


@query(
    "section:s age_015:i age_030:i age_060:i age_180:i age_365:i",
    """SELECT p_brand AS section, """ + ", ".join(
        f"count(*) FILTER (WHERE d >= {lo} AND d < {hi}) AS age_{hi:03d}"
        for lo, hi in ((-99999, 15), (15, 30), (30, 60), (60, 180), (180, 365))) +
    """ FROM (SELECT p_brand, date_diff('day', o_orderdate, l_shipdate) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN part ON p_partkey = l_partkey) GROUP BY 1""",
)
def age_buckets(s):
    """Lines by days between order and shipment."""
    cells = s.lineitem.join(s.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_partkey").agg(
        *[count.alias(name) for name, count in age_bucket_sums(F.col("o_orderdate"), F.col("l_shipdate")).items()])
    names = [name for name in cells.columns if name != "l_partkey"]
    return cells.join(s.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("section")).agg(
        *[F.sum(name).alias(name) for name in names])


@query(
    "loc_no:s items:i sold_items:i return_items:i",
    """SELECT loc_no, count(DISTINCT item_code) AS items, count(DISTINCT CASE WHEN sgn = 1 AND ok THEN item_code END) AS sold_items,
        count(DISTINCT CASE WHEN flag = 'y' THEN item_code END) AS return_items FROM sales GROUP BY 1""",
)
def cond_distinct_count(s):
    """Distinct items, overall and under a condition: one row per item first, then plain counts."""
    sold = (F.col("status") == "A") & F.coalesce(F.col("is_return") != "y", F.lit(True))
    per_item = s.sales_line.groupBy("location_id", "item_code").agg(
        F.max(sold).alias("sold"), F.max(F.coalesce(F.col("is_return") == "y", F.lit(False))).alias("returned"))
    return per_item.join(s.locations, "location_id").groupBy(F.col("location_no").alias("loc_no")).agg(
        F.count("*").alias("items"), F.count_if("sold").alias("sold_items"), F.count_if("returned").alias("return_items"))


@query(
    "item_code:s loc_no:s lines:i net_qty:i",
    """SELECT item_code, loc_no, count(*) AS lines, sum(sgn * q) AS net_qty FROM sales GROUP BY ALL
        HAVING sum(sgn * q) <> 0 AND count(*) > 2""",
)
def having_filter(s):
    sums = s.sales_line.groupBy("item_code", "location_id").agg(
        F.count("*").alias("lines"), F.sum(net(F.col("is_return"), F.col("quantity"))).alias("net_qty"))
    kept = sums.where(any_nonzero("net_qty") & (F.col("lines") > 2))
    return kept.join(s.locations, "location_id").withColumnRenamed("location_no", "loc_no")


@query(
    "l_partkey:i l_extendedprice:d",
    "SELECT l_partkey, arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) AS l_extendedprice FROM lineitem GROUP BY 1",
)
def latest_value_per_item(s):
    return latest_value(s.lineitem, ["l_partkey"], "l_extendedprice", "l_shipdate", tie="l_extendedprice")


@query(
    "serial:i loc_no:s fixed_price:d",
    "SELECT serial, loc_no, fixed AS fixed_price FROM price_fixes JOIN serials USING (serial)",
)
def price_correction(s):
    fixes = serial_items.corrected_prices(s.serial_inventory, s.price_changes)
    return fixes.withColumnsRenamed({"item_code": "serial", "location_no": "loc_no"})


@query(
    "kind:i plausible:b lines:i qty:i",
    f"""SELECT kind, NOT (cost > 75 AND CAST(cost AS DOUBLE) / q < 50) AND q < 1000 AND cost < 500 AS plausible, count(*) AS lines,
        sum(q) AS qty FROM transfer_lines GROUP BY ALL""",
)
def plausible_lines(s):
    heads = s.transfer_header.where("status_code = 3 and transfer_type between 1 and 7")
    lines = s.transfer_detail.where("status_code = 1").join(heads.drop("status_code"), "transfer_bin_no")
    test = plausible_cost(F.col("dips_cost"), F.col("quantity")).alias("plausible")
    return lines.groupBy(F.col("transfer_type").alias("kind"), test).agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("qty"))


@query(
    "item_code:s qty:i days:i per_day:d",
    f"""SELECT {code('l_partkey')} AS item_code, sum(CAST(l_quantity AS INTEGER)) AS qty,
        date_diff('day', min(l_shipdate), max(l_shipdate)) AS days,
        CAST(CAST(sum(CAST(l_quantity AS INTEGER)) AS DOUBLE) / nullif(CAST(date_diff('day', min(l_shipdate), max(l_shipdate)) AS DOUBLE), 0)
             AS DECIMAL(19,6)) AS per_day FROM lineitem GROUP BY l_partkey""",
)
def guarded_rate(s):
    sums = s.lineitem.groupBy(F.lpad(F.col("l_partkey").cast("string"), 20, "0").alias("item_code")).agg(
        total(F.col("l_quantity").cast("int")).alias("qty"),
        F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).alias("days"))
    return sums.withColumn("per_day", rate(F.col("qty"), F.col("days")))


@query(
    "min_dt:s loc_no:s product_type:s subj:s dir:s site:s orders:i items:i qty:i amount:d listed:d sold_cost:d",
    f"""SELECT c.min_dt, c.loc_no, c.product_type, subj, dir, site, orders, items, c.qty, amount, listed,
        coalesce(c.qty * a.cost, amount * length(c.product_type) * 10 * 0.01) AS sold_cost
        FROM (SELECT *, CAST(date_trunc('month', d + to_months(CAST(round(day(d) / 28.0) AS INTEGER))) AS DATE) AS month FROM (
              SELECT *, make_date(year(min_dt) + CASE WHEN min_dt = DATE '2023-12-31' THEN 1 ELSE 0 END, 1, 1) + CAST(7 * w AS INTEGER) AS d FROM (
              SELECT min_dt, CASE WHEN min_dt = DATE '2023-12-31' THEN 1 ELSE (dayofyear(min_dt) - 1 + 1) // 7 + 1 END AS w,
                o.loc_no, product_type, subj, dir, site, count(DISTINCT order_no) AS orders, count(DISTINCT k) AS items,
                sum(qty) AS qty, coalesce(sum(used_amount), 0) AS amount, sum(qty * list_price) AS listed
              FROM online_rows o JOIN priced p ON CAST(k AS INTEGER) = serial WHERE NOT is_new GROUP BY ALL))) c
        LEFT JOIN (SELECT home AS loc_no, product_type, CAST(date_trunc('month', CAST(ts AS DATE) + 20) AS DATE) AS month,
                CAST(max(p_size) AS {M}) AS cost FROM event_rows JOIN serials ON serial = CAST(k AS INTEGER) GROUP BY ALL) a
        ON a.loc_no = c.loc_no AND a.product_type = c.product_type AND a.month = c.month""",
)
def cost_fallback(s):
    """Serialised goods sold online with the average cost of store, type and month, or a share of the amount."""
    start, end = week_bounds(*online_weeks(s))
    return with_estimated_cost(used_cells(serial_events(s, start, end)), s.avg_cost, s.cost_factors)
