"""Join, set and row-change operators over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry.base import query
from registry.oracle_tables import code, wk, yr
from registry.standins import padded, sales_by_year
from shelfweek.functions.dates import with_year_week
from shelfweek.operators import joins, sets, windows
from shelfweek.plans import weekly
from shelfweek.plans.item_master import classified_catalogue, excluded_items
from shelfweek.sources import tables


def _week_cells(s):
    """Quantity per week, section and store."""
    return s.fact_lines.groupBy("min_dt", "section", "loc_no").agg(F.sum("q").alias("qty"))


@query(
    "item_code:s lines:i qty:i",
    f"""SELECT {code('l_partkey')} AS item_code, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 50) GROUP BY 1""",
)
def anti_exclude(s):
    kept = joins.absent(s.shipment_detail, s.base_inventory, ["item_code"])
    return kept.groupBy("item_code").agg(F.count("*").alias("lines"), F.sum("qty").alias("qty"))


@query(
    "item_code:s lines:i qty:i",
    f"""SELECT {code('l_partkey')} AS item_code, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem
        WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 50) GROUP BY 1""",
)
def semi_members(s):
    repeated = s.base_inventory.union(s.base_inventory)
    kept = joins.present(s.shipment_detail, repeated, ["item_code"])
    return kept.groupBy("item_code").agg(F.count("*").alias("lines"), F.sum("qty").alias("qty"))


@query(
    "test:s nation:i customers:i",
    """SELECT 'plain' AS test, c_nationkey AS nation, count(*) AS customers FROM customer
        WHERE (CASE WHEN c_acctbal >= 0 THEN c_custkey END) NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY ALL
       UNION ALL SELECT 'null listed', c_nationkey, count(*) FROM customer
        WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders) GROUP BY ALL
       UNION ALL SELECT 'empty list', c_nationkey, count(*) FROM customer
        WHERE (CASE WHEN c_acctbal >= 0 THEN c_custkey END) NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey IS NULL) GROUP BY ALL""",
)
def not_in_null_aware(s):
    """Customers without a partly shipped order; null values asked for, nulls in the list, and an empty list, which admits all."""
    customers = s.customer.withColumn("asked", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")))
    lists = {
        "plain": ("asked", s.orders.where("o_orderstatus = 'P'").select("o_custkey")),
        "null listed": ("c_custkey", s.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))),
        "empty list": ("asked", s.orders.where("o_orderkey is null").select("o_custkey")),
    }
    count = F.count("*").alias("customers")
    shown = [joins.not_in(customers, column, values).groupBy(F.lit(name).alias("test"), F.col("c_nationkey").alias("nation")).agg(count)
             for name, (column, values) in lists.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query(
    "flag:s loc_no:s sold:i returned:i",
    """SELECT a.flag, a.loc_no, a.sold, b.returned FROM
        (SELECT flag, loc_no, sum(q) AS sold FROM sales WHERE ok GROUP BY ALL) a JOIN
        (SELECT flag, loc_no, sum(q) AS returned FROM sales WHERE NOT ok GROUP BY ALL) b
        ON a.flag IS NOT DISTINCT FROM b.flag AND a.loc_no = b.loc_no""",
)
def eq_null_safe_join(s):
    def per_flag(status, name):
        rows = s.sales_line.where(F.col("status") == status).join(s.locations, "location_id")
        return rows.groupBy("is_return", "location_no").agg(F.sum("quantity").alias(name))

    left, right = per_flag("A", "sold"), per_flag("V", "returned").withColumnsRenamed(
        {"is_return": "flag_r", "location_no": "loc_r"})
    on = F.col("is_return").eqNullSafe(F.col("flag_r")) & (F.col("location_no") == F.col("loc_r"))
    return left.join(right, on).withColumnsRenamed({"is_return": "flag", "location_no": "loc_no"})


@query(
    "min_dt:s section:s loc_no:s qty:i",
    """SELECT min_dt, section, loc_no, coalesce(qty, 0) AS qty FROM
        (SELECT DISTINCT min_dt FROM fact_lines) JOIN (SELECT DISTINCT section FROM fact_lines) ON true
        JOIN (SELECT DISTINCT loc_no FROM fact_lines) ON true
        LEFT JOIN (SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines GROUP BY ALL)
        USING (min_dt, section, loc_no)""",
)
def dense_spine(s):
    """Every week, section and store that occurs, with a sparse measure attached."""
    lines = s.fact_lines
    spine = joins.dense_spine(*[lines.select(name).distinct() for name in ("min_dt", "section", "loc_no")])
    keys = ["min_dt", "section", "loc_no"]
    facts = lines.groupBy(*keys).agg(F.sum("q").alias("qty"))
    return joins.attach(spine, facts, keys, ["qty"])


@query(
    "min_dt:s loc_no:s items:i",
    """SELECT min_dt, loc_no, count(*) AS items FROM (SELECT DISTINCT min_dt, loc_no, item_code FROM fact_lines) GROUP BY ALL""",
)
def key_union(s):
    """Keys that occur in any of three folds, which together hold all lines, without a dense grid."""
    lines = s.fact_lines
    keys = joins.key_union(weekly.CELL, lines.where("a"), lines.where("r"), lines.where("n"))
    return keys.groupBy("min_dt", "loc_no").agg(F.count("*").alias("items"))


@query(
    "min_dt:s section:s loc_no:s sent:i received:i",
    """SELECT min_dt, section, loc_no, sent, received FROM
        (SELECT min_dt, section, loc_no, sum(q) AS sent FROM fact_lines WHERE o GROUP BY ALL) FULL JOIN
        (SELECT min_dt, section, loc_no, sum(q) AS received FROM fact_lines WHERE NOT o GROUP BY ALL)
        USING (min_dt, section, loc_no)""",
)
def full_outer_reconcile(s):
    """Open lines as one side and closed lines as the other, side by side."""
    keys = ["min_dt", "section", "loc_no"]
    sides = [s.fact_lines.where(test).groupBy(*keys).agg(F.sum("q").alias(name)) for test, name in (("o", "sent"), ("not o", "received"))]
    return joins.reconcile(*sides, keys)


@query(
    "o_orderkey:i hours_apart:i l_partkey:i l_suppkey:i shipped:s",
    """SELECT o_orderkey, hours AS hours_apart, pick.part AS l_partkey, pick.supp AS l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY hours NULLS LAST, pick.part, pick.supp, l_shipdate) AS n FROM (
            SELECT *, abs(date_diff('hour', o_orderdate, l_shipdate)) AS hours FROM (FROM lines_before UNION ALL FROM lines_after))) WHERE n = 1""",
    day_lines="SELECT store, l_shipdate, min({'part': l_partkey, 'supp': l_suppkey}) AS pick FROM line_store GROUP BY ALL",
    lines_before="""SELECT o_orderkey, o_orderdate, l_shipdate, pick FROM order_store o ASOF LEFT JOIN day_lines d
        ON o.store = d.store AND o.o_orderdate >= d.l_shipdate""",
    lines_after="""SELECT o_orderkey, o_orderdate, l_shipdate, pick FROM order_store o ASOF LEFT JOIN day_lines d
        ON o.store = d.store AND o.o_orderdate <= d.l_shipdate""",
)
def nearest_in_time(s):
    """For each order the line shipped from the same store nearest to the order date."""
    found = joins.nearest_in_time(
        s.order_store.select("o_orderkey", "store", "o_orderdate"), s.line_store, "store", "o_orderdate", "l_shipdate",
        ["l_partkey", "l_suppkey", "l_shipdate"], ["l_partkey", "l_suppkey"])
    return found.withColumn("shipped", F.col("l_shipdate").cast("date").cast("string"))


@query(
    "item_code:s report_item:s",
    f"""SELECT a.item_code, b.target AS report_item FROM
        (SELECT item_code, coalesce(nullif(report_item_code, ''), item_code) AS target FROM products WHERE product_type <> 'PRMO') a
        JOIN (SELECT item_code, coalesce(nullif(report_item_code, ''), item_code) AS target FROM products WHERE product_type <> 'PRMO') b
        ON a.target = b.item_code""",
)
def alias_resolve(s):
    kept = s.products.where(F.col("product_type") != "PRMO")
    pointers = kept.select("item_code", F.coalesce(F.nullif("report_item_code", F.lit("")), "item_code").alias("points_to"))
    return joins.resolve_alias(pointers)


@query(
    "min_dt:s section:s loc_no:s qty:i",
    """SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines WHERE min_dt >= DATE '1998-01-04'
        GROUP BY ALL""",
)
def append_new_only(s):
    """Facts whose key the target does not hold; the target has every week before 1998."""
    facts = _week_cells(s)
    stored = facts.where(F.col("min_dt") < F.lit(date(1998, 1, 4)))
    return tables.only_new(stored, facts, ["min_dt", "section", "loc_no"])


@query(
    "item_code:s item:s vendor:s rord_grp:s",
    """SELECT item_code, m.item, u.vendor, u.rord_grp FROM stored_master m JOIN item_master u USING (item_code)
        UNION ALL SELECT item_code, item_code, vendor, rord_grp FROM item_master
        WHERE item_code NOT IN (SELECT item_code FROM stored_master)""",
)
def upsert_master(s):
    grown = tables.insert_missing(s.stored_master, s.item_master, ["item_code"])
    return tables.update_changed(grown, s.item_master, "item_code", "vendor", ["vendor", "rord_grp"])


@query(
    "item_code:s vendor:s",
    """SELECT item_code, vendor FROM item_master JOIN part ON p_partkey = CAST(item_code AS BIGINT)
        WHERE p_size <> 50 AND p_type <> 'PROMO'""",
)
def delete_keys(s):
    """Rows deleted by key and by predicate."""
    kept = tables.delete_keys(s.item_master, s.base_inventory, ["item_code"])
    return tables.drop_where(kept, F.col("vendor") == "Inac")


@query(
    "yr:i lines:i qty:i val:d",
    """SELECT year(day) AS yr, count(*) AS lines, sum(q) AS qty, sum(sgn * reg) AS val FROM sales GROUP BY 1""",
)
def union_archive_tiers(s):
    """Year shards of the sales lines read as one table."""
    stacked = tables.union_tiers(*sales_by_year(s))
    return stacked.groupBy(F.year("business_date").alias("yr")).agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("qty"), F.sum("extended_amt").alias("val"))


@query(
    "item_code:s",
    f"""SELECT {code('l_partkey')} AS item_code FROM lineitem WHERE l_returnflag = 'R' UNION
        SELECT {code('l_partkey')} FROM lineitem WHERE l_returnflag <> 'R' UNION SELECT {code('p_partkey')} FROM part""",
)
def union_distinct_keys(s):
    """Items returned, items sold and items listed, each once."""
    keyed = s.lineitem.withColumn("item_code", padded("l_partkey", 20))
    return sets.union_distinct(keyed.where("l_returnflag = 'R'").select("item_code"), keyed.where("l_returnflag <> 'R'").select("item_code"),
                               s.products.select("item_code"))


@query(
    "side:s min_dt:s section:s loc_no:s qty:i",
    """SELECT 'new' AS side, * FROM (
            SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines WHERE min_dt >= DATE '1997-01-05' GROUP BY ALL
            EXCEPT SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines WHERE NOT (r AND o AND m) GROUP BY ALL)
        UNION ALL SELECT 'old' AS side, * FROM (
            SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines WHERE NOT (r AND o AND m) AND min_dt >= DATE '1997-01-05' GROUP BY ALL
            EXCEPT SELECT min_dt, section, loc_no, sum(q) AS qty FROM fact_lines GROUP BY ALL)""",
)
def except_diff(s):
    """Recomputed facts from 1997 on against stored facts that lack some lines."""
    new = _week_cells(s).where(F.col("min_dt") >= F.lit(date(1997, 1, 5)))
    old = s.fact_lines.where("not (r and o and m)").groupBy("min_dt", "section", "loc_no").agg(F.sum("q").alias("qty"))
    return sets.diff_both_ways(new, old)


@query(
    "l_orderkey:i l_linenumber:i l_shipdate:s l_partkey:i l_quantity:d",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_partkey, l_quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_quantity) AS n FROM lineitem)
        WHERE n = 1""",
)
def dedup_keep_first(s):
    rows = s.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity")
    return windows.keep_first(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


@query(
    "l_orderkey:i l_linenumber:i copies:i",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def repeated_keys(s):
    return sets.repeated_keys(s.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "flag:s loc_no:s item_lines:i flag_lines:i first_day:s lines:i",
    """SELECT flag, loc_no, item_lines, flag_lines, CAST(first_day AS VARCHAR) AS first_day, count(*) AS lines FROM (
        SELECT flag, loc_no, count(*) OVER (PARTITION BY item_code) AS item_lines,
            count(*) OVER (PARTITION BY flag) AS flag_lines, min(day) OVER (PARTITION BY flag) AS first_day FROM sales) GROUP BY ALL""",
)
def group_stats(s):
    """Counts over partitions, one of them by a flag with three values that is null on a third of all lines."""
    rows = s.sales_line.join(s.locations, "location_id").select("is_return", "location_no", "item_code", "business_date")
    counted = joins.with_group_stats(rows, ["item_code"], item_lines=F.count("*"))
    counted = joins.with_group_stats(counted, ["is_return"], flag_lines=F.count("*"), first_day=F.min("business_date"))
    return counted.groupBy(F.col("is_return").alias("flag"), F.col("location_no").alias("loc_no"), "item_lines",
                           "flag_lines", "first_day").agg(F.count("*").alias("lines"))


@query(
    "section:s yr:i wk:i qty:i ly_qty:i",
    f"""SELECT c.section, {yr('c.min_dt')} AS yr, {wk('c.min_dt')} AS wk, c.qty, p.qty AS ly_qty FROM
        (SELECT section, min_dt, sum(q) AS qty FROM fact_lines GROUP BY ALL) c LEFT JOIN
        (SELECT section, y, w, arg_min(qty, min_dt) AS qty FROM (
            SELECT section, min_dt, {yr('min_dt')} AS y, {wk('min_dt')} AS w, sum(q) AS qty FROM fact_lines GROUP BY ALL) GROUP BY ALL) p
        ON c.section = p.section AND p.y = {yr('c.min_dt')} - 1 AND p.w = {wk('c.min_dt')}""",
)
def prior_year(s):
    weeks = with_year_week(s.fact_lines.groupBy("section", "min_dt").agg(F.sum("q").alias("qty")))
    return joins.prior_year(weeks, ["section"], {"qty": "ly_qty"})


@query(
    "vendor_id:s product_type:s lines:i qty:i",
    """SELECT vendor_id, product_type, count(*) AS lines, sum(q) AS qty FROM line_store JOIN products ON p_partkey = l_partkey
        WHERE in_base OR vendor_id = 'IDCDCSPECU' OR product_type IN ('PRMO', 'HBF') GROUP BY ALL""",
)
def exclusion_list(s):
    """Lines of items that a list, a membership test or an attribute puts on the exclusion list."""
    flagged = weekly.excluded_flag(s.products.withColumns({"purchase_from_vendor_id": F.lit("")}), s.base_inventory, (),
                                   ("PRMO", "HBF"), F.col("vendor_id") == "IDCDCSPECU")
    totes = s.products.where(F.col("vendor_id") == "IDTXBKSTAP").select("item_code")
    test = s.products.join(s.base_inventory.withColumn("in_base", F.lit(True)), "item_code", "left")
    tote_rows = joins.present(test, totes, ["item_code"]).where(
        F.col("in_base") | F.col("product_type").isin("PRMO", "HBF"))
    listed = flagged.where("excluded").select("item_code", "vendor_id", "product_type").unionByName(
        tote_rows.select("item_code", "vendor_id", "product_type"))
    cells = s.shipment_detail.groupBy("item_code").agg(F.count("*").alias("lines"), F.sum("qty").alias("qty"))
    return cells.join(listed, "item_code").groupBy("vendor_id", "product_type").agg(
        F.sum("lines").alias("lines"), F.sum("qty").alias("qty"))


@query(
    "item_code:s item:s vendor:s rord_grp:s",
    """SELECT item_code, item, vendor, CASE WHEN vendor = 'TEXASBKMNB' THEN 'TRO' WHEN vendor LIKE 'BS%' THEN 'BS'
            WHEN vendor = 'CDC' THEN 'CDC' WHEN vendor = 'Inac' OR vendor = 'IDAURORA' OR vendor = 'IDTOYSMITH' THEN 'HRO' END AS rord_grp
        FROM classified""",
    kept_items="""SELECT *, coalesce(nullif(report_item_code, ''), item_code) AS target FROM products
        WHERE NOT ((in_base OR product_type = 'PRMO' OR bought_from = 'WHPBSUPPLY' OR (product_type = 'CALF' AND vendor_id = 'IDCDCSPECU'))
                   AND vendor_id <> 'IDTXBKSTAP' AND bought_from <> 'IDTXBKSTAP')""",
    classified="""SELECT a.item_code, b.target AS item,
        CASE WHEN p.mark = 'TTB' THEN CASE WHEN p.bought_from = 'TEXASBKMNB' THEN 'TEXASBKMNB' ELSE coalesce(ttb_vendor, 'TEXASBKMNA') END
             WHEN p.bought_from IN ('IDAURORA', 'IDTOYSMITH') THEN p.bought_from
             WHEN p.product_type IN ('HBF', 'TRF') THEN CASE WHEN p.vendor_id IN ('IDB&TDISTR', 'IDINGRAMDI') THEN 'BS-r' ELSE 'BS-i' END
             WHEN p.reorder_mark AND p.bought_from <> 'IDCDCSPECU' THEN 'Inac' ELSE 'CDC' END AS vendor
        FROM kept_items a JOIN kept_items b ON a.target = b.item_code JOIN products p ON p.item_code = b.target
        LEFT JOIN sections ON section = p.section_code""",
)
def item_classify(s):
    """Vendor and reorder group of every catalogue item."""
    return classified_catalogue(s)


@query("item_code:s", """SELECT item_code FROM products
        WHERE (in_base OR product_type = 'PRMO' OR bought_from = 'WHPBSUPPLY' OR (product_type = 'CALF' AND vendor_id = 'IDCDCSPECU'))
          AND vendor_id <> 'IDTXBKSTAP' AND bought_from <> 'IDTXBKSTAP'""")
def excluded_master_items(s):
    return excluded_items(s)
