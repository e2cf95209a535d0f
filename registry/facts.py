"""Weekly fact jobs over the whole history of the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import query
from registry.oracle_tables import M, code, compose, sunday, wk, yr
from registry.standins import Retail, all_weeks, online_weeks, order_weeks
from shelfweek.functions.dates import week_bounds
from shelfweek.functions.measures import MONEY
from shelfweek.operators.joins import look_up
from shelfweek.plans import base_inventory, frontline, frontline_items, item_master, new_goods, online_new, online_used
from shelfweek.plans import refresh, serial_items, weekly
from shelfweek.sources.tables import Sources, shared_folder

SHIPMENTS = f"""SELECT {sunday('o_orderdate')} AS min_dt, store AS loc_no, l_partkey, CAST(l_quantity AS INTEGER) AS q,
    CAST(l_extendedprice AS {M}) AS v FROM order_store JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'"""
RECEIVED = f"""SELECT {sunday('l_shipdate')} AS min_dt, store AS loc_no, l_partkey, CAST(l_quantity AS INTEGER) AS q
    FROM order_store JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'"""
SALES_SUMS = """sum(sgn * q) AS sold_qty, sum(sgn * cost) AS sold_cost, sum(sgn * reg) AS sold_val, sum(sgn * unit) AS list_val,
    sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * q ELSE 0 END) AS md_sold_qty,
    sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * cost ELSE 0 END) AS md_cost,
    sum(CASE WHEN below THEN sgn * reg ELSE 0 END) AS md_sold_val,
    sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * unit ELSE 0 END) AS md_list_val"""


def gone(measure: str) -> str:
    return f"sum(CASE WHEN NOT inbound AND kind IN (1, 2, 7) THEN {measure} ELSE 0 END)"


def moved(measure: str, inbound: bool) -> str:
    test = "inbound" if inbound else "NOT inbound AND kind = 3"
    return f"sum(CASE WHEN {test} THEN {measure} ELSE 0 END)"


def returned(measure: str) -> str:
    return f"sum(CASE WHEN NOT inbound AND kind = 6 THEN {measure} ELSE 0 END)"


def fold_tables(keys: str, goods: str, stores: str) -> dict[str, str]:
    """The four folds at the keys of one job, and the keys that had any of them."""
    moves = f"""{gone('q')} AS rfi_qty, {gone('q * t.cost')} AS rfi_cost, {gone('q * price')} AS rfi_list, {moved('q', True)} AS in_sts_qty,
        {moved('q', False)} AS out_sts_qty, {returned('q')} AS rtn_qty, {returned('q * t.cost')} AS rtn_cost, {returned('q * price')} AS rtn_list,
        count(DISTINCT CASE WHEN NOT inbound AND kind = 6 THEN t.l_partkey END) AS rtn_its"""
    refunds = ", sum(CASE WHEN flag = 'y' THEN q ELSE 0 END) AS rfnd_qty, sum(CASE WHEN flag = 'y' THEN reg ELSE 0 END) AS rfnd_val"
    plain = {
        "f_ship": f"""SELECT {keys}, count(DISTINCT l_partkey) AS ship_its, sum(q) AS ship_qty, sum(q * v) AS ship_cost, sum(q * price) AS ship_val
            FROM shipments JOIN {goods} ON p_partkey = l_partkey {stores} GROUP BY ALL""",
        "f_rcv": f"""SELECT {keys}, count(DISTINCT l_partkey) AS rcv_its, sum(q) AS rcv_qty, sum(q * cost) AS rcv_cost, sum(q * price) AS rcv_val
            FROM received JOIN {goods} ON p_partkey = l_partkey {stores} GROUP BY ALL""",
        "f_sale": f"""SELECT {keys}, count(DISTINCT l_partkey) AS sold_its, {SALES_SUMS}{refunds}
            FROM (SELECT * EXCLUDE (item_code) FROM sales) JOIN {goods} ON p_partkey = l_partkey {stores} WHERE ok GROUP BY ALL""",
        "f_move": f"""SELECT {keys}, {moves} FROM transfer_ends t JOIN (SELECT * EXCLUDE (item_code, cost) FROM {goods}) ON p_partkey = l_partkey {stores}
            GROUP BY ALL""",
    }
    return {"shipments": SHIPMENTS, "received": RECEIVED, **plain}


NEW_COLUMNS = [*new_goods.MEASURES]
FRONT_COLUMNS = [*frontline.MEASURES]


def typed(measures: dict[str, str]) -> str:
    return " ".join(f"{name}:{'d' if kind == MONEY else 'i'}" for name, kind in measures.items())


def joined_acts(keys: list[str], measures) -> str:
    using = ", ".join(keys)
    filled = ", ".join(f"coalesce({name}, 0) AS {name}" for name in measures)
    return (f"SELECT {using}, {filled} FROM f_ship FULL JOIN f_rcv USING ({using}) FULL JOIN f_sale USING ({using}) "
            f"FULL JOIN f_move USING ({using})")


NEW_FOLDS = fold_tables("min_dt, section, loc_no", "new_products", "JOIN stores USING (loc_no)")
NEW_FOLDS["acts"] = joined_acts(new_goods.KEYS, new_goods.MEASURES)
FRONT_KEYS = "min_dt, src, prog, section, loc_no"
FRONT_FOLDS = fold_tables(FRONT_KEYS, "front_products", "JOIN stores USING (loc_no)")
FRONT_FOLDS["acts"] = joined_acts(frontline.KEYS, frontline.MEASURES)
ACTIVE = " OR ".join(f"{name} <> 0" for name in new_goods.ACTIVE_ON)
CULL = {
    "open_weeks": f"""SELECT loc_no, CAST(unnest(generate_series(first_dt, last_dt, INTERVAL 7 DAY)) AS DATE) AS min_dt FROM (
        SELECT loc_no, min(min_dt) FILTER (WHERE {ACTIVE}) AS first_dt, max(min_dt) FILTER (WHERE {ACTIVE}) AS last_dt
        FROM acts GROUP BY 1 HAVING sum(ship_qty + abs(sold_qty) + rfi_qty) <> 0)""",
    "live_sections": "SELECT section FROM acts GROUP BY 1 HAVING sum(ship_qty + abs(sold_qty) + rfi_qty) <> 0",
}


def detail_sums(keys: str, measures, spine: str, using: str) -> str:
    sums = ", ".join(f"sum(coalesce({name}, 0)) AS {name}" for name in measures)
    return (f"SELECT {keys}, count(*) AS cells, {sums} FROM {spine} LEFT JOIN acts USING ({using}) GROUP BY ALL")


def summed(df, by, measures):
    return df.groupBy(*by).agg(F.count("*").alias("cells"), *[F.sum(name).alias(name) for name in measures])


@query(
    "min_dt:s section:s loc_no:s ship_its:i ship_qty:i ship_cost:d ship_val:d",
    "SELECT * FROM f_ship", **NEW_FOLDS,
)
def weekly_shipments(s):
    start, end = week_bounds(*order_weeks(s))
    fold = weekly.fold_shipments(s, weekly.new_goods_products(s), ["section"], start, end, weekly.store_list(s.locations))
    names = [name for name in fold.columns if name not in new_goods.KEYS]
    return fold.groupBy(*new_goods.KEYS).agg(*[F.sum(name).alias(name) for name in names])


@query(
    "min_dt:s section:s loc_no:s rcv_its:i rcv_qty:i rcv_cost:d rcv_val:d",
    "SELECT * FROM f_rcv", **NEW_FOLDS,
)
def weekly_receiving(s):
    start, end = week_bounds(*order_weeks(s))
    fold = weekly.fold_receiving(s, weekly.new_goods_products(s), ["section"], start, end, weekly.store_list(s.locations))
    names = [name for name in fold.columns if name not in new_goods.KEYS]
    return fold.groupBy(*new_goods.KEYS).agg(*[F.sum(name).alias(name) for name in names])


@query(
    "min_dt:s section:s loc_no:s " + typed(new_goods.MEASURES),
    "SELECT * FROM acts", **NEW_FOLDS,
)
def new_goods_activity(s):
    """All measures of the new goods at their sparse keys."""
    return new_goods.new_goods_activity(s, *week_bounds(*order_weeks(s)))


@query(
    "yr:i wk:i section:s cells:i " + typed(new_goods.MEASURES),
    f"""SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, section, sum(cells) AS cells, """
    + ", ".join(f"sum({name}) AS {name}" for name in NEW_COLUMNS) + " FROM ("
    + detail_sums("min_dt, section", NEW_COLUMNS, "open_weeks JOIN live_sections ON true", "min_dt, section, loc_no")
    + ") GROUP BY ALL",
    **NEW_FOLDS, **CULL,
)
def location_detail(s):
    """Dense culled detail of the new goods, summed over stores with its number of cells."""
    return summed(new_goods.weekly_new_goods(s, *order_weeks(s)), ["yr", "wk", "section"], new_goods.MEASURES)


@query(
    "loc_no:s first_week:s last_week:s cells:i sections:i",
    """SELECT loc_no, min(min_dt) AS first_week, max(min_dt) AS last_week, count(*) AS cells, count(DISTINCT section) AS sections
        FROM open_weeks JOIN live_sections ON true GROUP BY 1""",
    **NEW_FOLDS, **CULL,
)
def cull_inactive(s):
    """Which weeks and sections survive per store."""
    return new_goods.weekly_new_goods(s, *order_weeks(s)).groupBy("loc_no").agg(
        F.min("min_dt").alias("first_week"), F.max("min_dt").alias("last_week"), F.count("*").alias("cells"),
        F.count_distinct("section").alias("sections"))


@query(
    "yr:i wk:i src:s prog:s section:s cells:i " + typed(frontline.MEASURES),
    f"SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, src, prog, section, sum(cells) AS cells, "
    + ", ".join(f"sum({name}) AS {name}" for name in FRONT_COLUMNS) + " FROM ("
    + detail_sums("min_dt, src, prog, section", FRONT_COLUMNS,
                  "open_weeks JOIN live_sections ON true JOIN (VALUES ('BS'), ('Frln')) a(src) ON true "
                  "JOIN (VALUES ('Init'), ('Rord')) b(prog) ON true", FRONT_KEYS)
    + ") GROUP BY ALL",
    **FRONT_FOLDS, **CULL,
)
def frontline_src_prog(s):
    """Frontline facts with source and program, summed over stores."""
    return summed(frontline.weekly_frontline(s, *order_weeks(s)), ["yr", "wk", "src", "prog", "section"], frontline.MEASURES)


BASE = {
    "base_items": """SELECT item_code, product_type, p_partkey FROM products WHERE in_base""",
    "b_buy": """SELECT min_dt, item_code, loc_no, sum(q) AS buy_qty, sum(offer) AS buy_cost FROM buys JOIN stores USING (loc_no)
        JOIN base_items USING (product_type) WHERE q > 0 GROUP BY ALL""",
    "b_sale": """SELECT min_dt, item_code, loc_no, sum(sgn * q) AS sold_qty, sum(sgn * reg) AS sold_val,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * q ELSE 0 END) AS md_sold_qty,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * reg ELSE 0 END) AS md_sold_val
        FROM sales JOIN stores USING (loc_no) JOIN base_items USING (item_code) WHERE ok GROUP BY ALL""",
    "b_move": f"""SELECT min_dt, item_code, loc_no, {gone('q')} AS rfi_qty, {gone('q * cost')} AS rfi_cost, {moved('q', True)} AS in_sts_qty,
        {moved('q', False)} AS out_sts_qty, sum(CASE WHEN NOT inbound AND kind = 4 THEN q ELSE 0 END) AS bsm_qty,
        sum(CASE WHEN NOT inbound AND kind = 4 THEN q * cost ELSE 0 END) AS bsm_cost
        FROM plausible_ends JOIN stores USING (loc_no) JOIN base_items USING (item_code) GROUP BY ALL""",
    "b_acts": "SELECT min_dt, item_code, loc_no, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in base_inventory.MEASURES)
        + """ FROM b_buy FULL JOIN b_sale USING (min_dt, item_code, loc_no) FULL JOIN b_move USING (min_dt, item_code, loc_no)
        WHERE loc_no NOT IN ('00027','00028','00042','00060','00063','00079','00089','00092','00093','00101')""",
    "b_weeks": "SELECT loc_no, CAST(unnest(generate_series(min(min_dt), max(min_dt), INTERVAL 7 DAY)) AS DATE) AS min_dt FROM b_acts WHERE "
        + " OR ".join(f"{n} <> 0" for n in base_inventory.ACTIVE_ON) + " GROUP BY 1",
}


@query(
    "min_dt:s item_code:s loc_no:s buy_qty:i buy_cost:d", "SELECT * FROM b_buy", **BASE,
)
def weekly_buys(s):
    start, end = week_bounds(*order_weeks(s))
    return base_inventory.weekly_buys(s, base_inventory.base_items(s), start, end, weekly.store_list(s.locations))


@query(
    "yr:i item_code:s cells:i " + typed(base_inventory.MEASURES),
    f"SELECT {yr('min_dt')} AS yr, item_code, count(*) AS cells, "
    + ", ".join(f"sum(coalesce({n}, 0)) AS {n}" for n in base_inventory.MEASURES)
    + """ FROM b_weeks JOIN (SELECT item_code FROM base_items) ON true LEFT JOIN b_acts USING (min_dt, item_code, loc_no)
        WHERE loc_no NOT IN ('00020', '00106') GROUP BY ALL""",
    **BASE,
)
def base_inventory_facts(s):
    """Used base-inventory facts, summed over stores and weeks of a year."""
    return summed(base_inventory.weekly_base_inventory(s, *order_weeks(s)), ["yr", "item_code"], base_inventory.MEASURES)


SERIAL = {
    "s_made": f"""SELECT {sunday('stocked')} AS min_dt, subj, loc_no, count(DISTINCT serial) AS made_qty, sum(list_price) AS made_list
        FROM priced GROUP BY ALL""",
    "s_sale": """SELECT min_dt, subj, p.loc_no, sum(sgn * q) AS sold_qty, sum(sgn * reg) AS sold_val, sum(sgn * list_price) AS list_val,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * q ELSE 0 END) AS md_sold_qty,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * reg ELSE 0 END) AS md_sold_val,
        sum(CASE WHEN below AND flag IS NOT NULL THEN sgn * list_price ELSE 0 END) AS md_list_val, """ + ", ".join(
        f"count(*) FILTER (WHERE age >= {lo} AND age < {hi}) AS age_{hi:03d}"
        for lo, hi in ((-99999, 15), (15, 30), (30, 60), (60, 180), (180, 365))) +
    """ FROM (SELECT s.*, p.subj, p.loc_no AS held, p.list_price, date_diff('day', stocked, day) AS age FROM sales s
              JOIN priced p ON serial = l_partkey AND p.location_id = s.location_id
              JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P') p GROUP BY min_dt, subj, p.loc_no""",
    "s_move": f"""SELECT min_dt, subj, e.loc_no, {gone('q')} AS rfi_qty, {gone('q * cost')} AS rfi_cost, {moved('q', True)} AS in_sts_qty,
        {moved('q', False)} AS out_sts_qty, sum(CASE WHEN NOT inbound AND kind = 4 THEN q ELSE 0 END) AS bsm_qty,
        sum(CASE WHEN NOT inbound AND kind = 4 THEN q * cost ELSE 0 END) AS bsm_cost
        FROM plausible_ends e JOIN (SELECT serial, subj FROM serials) ON serial = l_partkey GROUP BY ALL""",
    "s_acts": "SELECT min_dt, subj, loc_no, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in serial_items.MEASURES)
        + """ FROM s_made FULL JOIN s_sale USING (min_dt, subj, loc_no) FULL JOIN s_move USING (min_dt, subj, loc_no) JOIN stores USING (loc_no)""",
    "s_weeks": "SELECT loc_no, CAST(unnest(generate_series(min(min_dt), max(min_dt), INTERVAL 7 DAY)) AS DATE) AS min_dt FROM s_acts WHERE "
        + " OR ".join(f"{n} <> 0" for n in serial_items.ACTIVE_ON) + " GROUP BY 1",
}


def serial_sources(s: Retail) -> Retail:
    s["sales_line"] = s.serial_sales_line
    return s


@query(
    "min_dt:s subj:s loc_no:s made_qty:i made_list:d", "SELECT * FROM s_made", **SERIAL,
)
def weekly_items_created(s):
    start, end = week_bounds(*order_weeks(s))
    return serial_items.weekly_items_created(serial_items.priced_inventory(s, start, end), start, end)


@query(
    "min_dt:s subj:s loc_no:s sold_qty:i sold_val:d list_val:d md_sold_qty:i md_sold_val:d md_list_val:d age_015:i age_030:i age_060:i "
    "age_180:i age_365:i", "SELECT * FROM s_sale", **SERIAL,
)
def weekly_serial_sales(s):
    s = serial_sources(s)
    start, end = week_bounds(*order_weeks(s))
    return serial_items.weekly_serial_sales(s, serial_items.priced_inventory(s, start, end), start, end)


@query(
    "yr:i wk:i subj:s cells:i " + typed(serial_items.MEASURES),
    f"SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, subj, count(*) AS cells, "
    + ", ".join(f"sum(coalesce({n}, 0)) AS {n}" for n in serial_items.MEASURES)
    + """ FROM s_weeks JOIN (SELECT DISTINCT p_brand AS subj FROM part) ON true LEFT JOIN s_acts USING (min_dt, subj, loc_no) GROUP BY ALL""",
    **SERIAL,
)
def serial_facts(s):
    """Used serialised-item facts, summed over stores."""
    return summed(serial_items.weekly_serial_items(serial_sources(s), *order_weeks(s)), ["yr", "wk", "subj"],
                  serial_items.MEASURES)


ITEM_KEYS = "min_dt, ean, item_code, src, prog, loc_no"
ITEM_FOLDS = fold_tables(ITEM_KEYS, "front_products", "")
WEB = f"""SELECT * FROM (
    SELECT {sunday('ts')} AS min_dt, home AS loc_no, CAST(k AS BIGINT) AS key, 's' AS dir, qty, amount, CAST(amount * qty AS {M}) AS ext, fee,
        CAST(0 AS {M}) AS refund FROM event_rows WHERE event_type = 'click' AND value >= 2
    UNION ALL SELECT {sunday('ts + INTERVAL 3 DAY')}, home, CAST(k AS BIGINT), 'r', qty, amount, CAST(amount * qty AS {M}), fee, refund
        FROM event_rows WHERE event_type = 'click' AND value >= 2 AND refund > 0)"""
ITEM_FOLDS["web_lines"] = WEB
ITEM_FOLDS["f_web"] = f"""SELECT {ITEM_KEYS}, sum(CASE WHEN dir = 's' THEN qty ELSE 0 END) AS onl_sold_qty,
    sum(CASE WHEN dir = 's' THEN ext ELSE -refund END) AS onl_sold_val, sum(CASE WHEN dir = 's' THEN fee ELSE 0 END) AS onl_sold_fee,
    sum(CASE WHEN dir = 's' AND amount < price THEN qty ELSE 0 END) AS md_onl_sold_qty,
    sum(CASE WHEN dir = 'r' THEN -refund WHEN amount < price THEN ext ELSE 0 END) AS md_onl_sold_val,
    sum(CASE WHEN dir = 's' AND amount < price THEN fee ELSE 0 END) AS md_onl_sold_fee,
    sum(CASE WHEN dir = 'r' THEN qty ELSE 0 END) AS onl_rfnd_qty, sum(refund) AS onl_rfnd_val
    FROM web_lines JOIN front_products ON p_partkey = key GROUP BY ALL"""
STORE_NAMES = {"st_sold_qty": "sold_qty", "st_sold_val": "sold_val", "md_st_sold_qty": "md_sold_qty",
               "md_st_sold_val": "md_sold_val", "st_rfnd_qty": "rfnd_qty", "st_rfnd_val": "rfnd_val"}
ITEM_FOLDS["i_acts"] = (
    f"SELECT * FROM (SELECT {ITEM_KEYS}, "
    + ", ".join(f"coalesce({STORE_NAMES.get(n, n)}, 0) AS {n}" for n in frontline_items.MEASURES)
    + "".join(f"{' FULL JOIN' if i else ' FROM'} {name}{f' USING ({ITEM_KEYS})' if i else ''}"
              for i, name in enumerate(("f_ship", "f_rcv", "f_sale", "f_move", "f_web")))
    + ") WHERE (" + " OR ".join(f"{n} <> 0" for n in frontline_items.ROW_COUNTS_ON) + ")"
    + f" AND loc_no IN (SELECT {code('n_nationkey', 5)} FROM nation)")
VOLUME = ("ship_qty + rcv_qty + abs(st_sold_qty) + abs(onl_sold_qty) + abs(st_rfnd_qty) + abs(onl_rfnd_qty) + rfi_qty + in_sts_qty "
          "+ out_sts_qty + rtn_qty")
ITEM_FOLDS["i_live"] = f"""SELECT * FROM i_acts
    WHERE loc_no IN (SELECT loc_no FROM i_acts GROUP BY 1 HAVING sum({VOLUME}) <> 0)
      AND item_code IN (SELECT item_code FROM i_acts GROUP BY 1 HAVING sum({VOLUME}) <> 0)"""


@query(
    "yr:i wk:i src:s prog:s cells:i titles:i " + typed(frontline_items.MEASURES),
    f"SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, src, prog, count(*) AS cells, count(DISTINCT ean) AS titles, "
    + ", ".join(f"sum({n}) AS {n}" for n in frontline_items.MEASURES) + " FROM i_live GROUP BY ALL",
    **ITEM_FOLDS,
)
def item_detail_sparse(s):
    """Frontline item facts over store and online history, summed over stores and items."""
    facts = frontline_items.weekly_frontline_items(s, *all_weeks(s))
    keys = ["yr", "wk", "src", "prog"]
    # Apart, because a distinct count beside sums takes every sum through the shuffle of the distinct values.
    sums = facts.groupBy(*keys).agg(F.count("*").alias("cells"), *[F.sum(n).alias(n) for n in frontline_items.MEASURES])
    titles = facts.select(*keys, "ean").distinct().groupBy(*keys).agg(F.count("ean").alias("titles"))
    return look_up(sums, titles, keys, null_safe=True)


@query(
    "item_code:s st_sold_qty:i st_sold_val:d onl_sold_qty:i onl_sold_val:d onl_sold_fee:d md_onl_sold_qty:i md_onl_sold_val:d "
    "onl_rfnd_qty:i onl_rfnd_val:d",
    """SELECT item_code, sum(st_sold_qty) AS st_sold_qty, sum(st_sold_val) AS st_sold_val, sum(onl_sold_qty) AS onl_sold_qty,
        sum(onl_sold_val) AS onl_sold_val, sum(onl_sold_fee) AS onl_sold_fee, sum(md_onl_sold_qty) AS md_onl_sold_qty,
        sum(md_onl_sold_val) AS md_onl_sold_val, sum(onl_rfnd_qty) AS onl_rfnd_qty, sum(onl_rfnd_val) AS onl_rfnd_val
        FROM i_acts GROUP BY 1""",
    **ITEM_FOLDS,
)
def combined_store_online(s):
    """Store and online sales of an item side by side; neither side multiplies the other."""
    acts = frontline_items.frontline_item_activity(s, *week_bounds(*all_weeks(s)))
    places = s.locations.select(F.col("location_no").alias("loc_no"))
    names = ["st_sold_qty", "st_sold_val", "onl_sold_qty", "onl_sold_val", "onl_sold_fee", "md_onl_sold_qty",
             "md_onl_sold_val", "onl_rfnd_qty", "onl_rfnd_val"]
    return acts.join(places, "loc_no", "left_semi").groupBy("item_code").agg(*[F.sum(n).alias(n) for n in names])


ONLINE_COLUMNS = ("used_new:s src:s yr:i wk:i min_dt:s loc_no:s rord_grp:s vendor:s cap:s secn:s site:s sold_ords:i sold_its:i sold_qty:i "
                  "sold_cost:d sold_val:d sold_list:d sold_fee:d rfnd_ords:i rfnd_its:i rfnd_amt:d")


ONLINE_NEW = {
    "online_new_rows": f"""SELECT 'New' AS used_new, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, * FROM (
        SELECT CASE WHEN rord_grp = 'BS' THEN 'BS' ELSE 'DIPS' END AS src, min_dt, loc_no, rord_grp,
        left(CASE WHEN vendor = 'CDC' THEN 'CDC' || CASE WHEN right(product_type, 1) = 'F' THEN '-f' ELSE '-n' END ELSE vendor END, 12) AS vendor,
        cap, secn, site, sum(CASE WHEN dir = 's' THEN orders ELSE 0 END) AS sold_ords, count(DISTINCT CASE WHEN dir = 's' THEN item_code END) AS sold_its,
        sum(qty) AS sold_qty, sum(CASE WHEN dir = 's' THEN lines * cost ELSE 0 END) AS sold_cost, sum(amount) AS sold_val,
        sum(CASE WHEN dir = 's' THEN lines * price ELSE 0 END) AS sold_list, sum(fee) AS sold_fee,
        sum(CASE WHEN dir = 'r' THEN orders ELSE 0 END) AS rfnd_ords, count(DISTINCT CASE WHEN dir = 'r' THEN item_code END) AS rfnd_its,
        sum(refund) AS rfnd_amt FROM new_cells JOIN stores_150 USING (loc_no) GROUP BY ALL)""",
    "new_cells": """SELECT min_dt, loc_no, site, dir, item_code, vendor, rord_grp, product_type, cap, secn, cost, price, count(DISTINCT order_no) AS orders,
        count(*) AS lines, sum(qty) AS qty, sum(amount) AS amount, sum(fee) AS fee, sum(refund) AS refund
        FROM online_rows JOIN (SELECT * EXCLUDE (vendor_id) FROM products) ON p_partkey = CAST(k AS BIGINT) JOIN item_master USING (item_code)
        LEFT JOIN sections ON section = section_code WHERE is_new GROUP BY ALL""",
    "stores_150": "SELECT loc_no FROM stores",
}


@query(ONLINE_COLUMNS, "SELECT * FROM online_new_rows", **ONLINE_NEW)
def online_rollup_new(s):
    return online_new.weekly_online_new(s, *online_weeks(s))


ONLINE_USED = {
    "online_used_rows": f"""SELECT 'Used' AS used_new, left(vendor, 4) AS src, 'USED' AS rord_grp, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, * FROM (
        SELECT min_dt, loc_no, vendor, cap, secn, site, sum(CASE WHEN dir = 's' THEN orders ELSE 0 END) AS sold_ords,
        sum(CASE WHEN dir = 's' THEN items ELSE 0 END) AS sold_its, sum(qty) AS sold_qty,
        sum(coalesce(CAST(qty * a.cost AS {M}), CAST(amount * length(c.product_type) * 10 * 0.01 AS {M}))) AS sold_cost,
        sum(amount) AS sold_val, sum(listed) AS sold_list, sum(fee) AS sold_fee, sum(CASE WHEN dir = 'r' THEN orders ELSE 0 END) AS rfnd_ords,
        sum(CASE WHEN dir = 'r' THEN items ELSE 0 END) AS rfnd_its, sum(refund) AS rfnd_amt
        FROM (SELECT *, CAST(date_trunc('month', d + to_months(CAST(round(day(d) / 28.0) AS INTEGER))) AS DATE) AS month FROM (
              SELECT *, make_date(CAST({yr('min_dt')} AS BIGINT), 1, 1) + CAST(7 * {wk('min_dt')} AS INTEGER) AS d FROM used_groups)) c
        LEFT JOIN (SELECT home AS loc_no, product_type, CAST(date_trunc('month', CAST(ts AS DATE) + 20) AS DATE) AS month,
                CAST(max(p_size) AS {M}) AS cost FROM event_rows JOIN serials ON serial = CAST(k AS INTEGER) GROUP BY ALL) a USING (loc_no, product_type, month)
        LEFT JOIN sections ON section = subj GROUP BY ALL)""",
    "used_groups": f"""SELECT min_dt, o.loc_no, 'SIPS' AS vendor, product_type, subj, dir, site, count(DISTINCT order_no) AS orders, count(DISTINCT k) AS items,
            sum(qty) AS qty, coalesce(sum(used_amount), 0) AS amount, sum(qty * list_price) AS listed, sum(fee) AS fee, sum(refund) AS refund
            FROM online_rows o JOIN priced p ON CAST(k AS INTEGER) = serial WHERE NOT is_new GROUP BY ALL
        UNION ALL SELECT {sunday('ts')}, home, 'BI', NULL, NULL, 's', 'i', count(DISTINCT order_no), count(DISTINCT k), sum(qty), sum(amount),
            sum(amount), sum(fee), 0 FROM used_market GROUP BY ALL
        UNION ALL SELECT {sunday('ts + INTERVAL 5 DAY')}, home, 'BI', NULL, NULL, 'r', 'i', count(DISTINCT order_no), count(DISTINCT k), 0, 0, 0, 0,
            sum(refund) FROM used_market WHERE refund > 0 GROUP BY ALL""",
    "used_market": "SELECT * FROM event_rows WHERE event_type = 'view' AND value >= 5 AND left(k, 1) IN ('4', '5')",
}


@query(ONLINE_COLUMNS, "SELECT * FROM online_used_rows", **ONLINE_USED)
def online_rollup_used(s):
    return online_used.weekly_online_used(s, *online_weeks(s))


MASTER = {
    "refreshed_master": """SELECT item_code, coalesce(m.item, u.item) AS item, coalesce(u.vendor, m.vendor) AS vendor,
        CASE WHEN u.vendor IS NULL OR u.vendor = m.vendor THEN coalesce(m.rord_grp, u.rord_grp) ELSE u.rord_grp END AS rord_grp
        FROM (SELECT * FROM stored_master) m FULL JOIN (SELECT item_code, item, vendor, CASE WHEN vendor = 'TEXASBKMNB' THEN 'TRO' WHEN vendor LIKE 'BS%' THEN 'BS'
            WHEN vendor = 'CDC' THEN 'CDC' WHEN vendor IN ('Inac', 'IDAURORA', 'IDTOYSMITH') THEN 'HRO' END AS rord_grp FROM classified) u USING (item_code)
        WHERE item_code NOT IN (SELECT item_code FROM products_skip WHERE skipped)""",
    "products_skip": """SELECT *, ((in_base OR product_type = 'PRMO' OR bought_from = 'WHPBSUPPLY' OR (product_type = 'CALF' AND vendor_id = 'IDCDCSPECU'))
                   AND vendor_id <> 'IDTXBKSTAP' AND bought_from <> 'IDTXBKSTAP') AS skipped, coalesce(nullif(report_item_code, ''), item_code) AS target
        FROM products""",
    "classified": """SELECT a.item_code, b.target AS item,
        CASE WHEN p.mark = 'TTB' THEN CASE WHEN p.bought_from = 'TEXASBKMNB' THEN 'TEXASBKMNB' ELSE coalesce(ttb_vendor, 'TEXASBKMNA') END
             WHEN p.bought_from IN ('IDAURORA', 'IDTOYSMITH') THEN p.bought_from
             WHEN p.product_type IN ('HBF', 'TRF') THEN CASE WHEN p.vendor_id IN ('IDB&TDISTR', 'IDINGRAMDI') THEN 'BS-r' ELSE 'BS-i' END
             WHEN p.reorder_mark AND p.bought_from <> 'IDCDCSPECU' THEN 'Inac' ELSE 'CDC' END AS vendor
        FROM products_skip a JOIN products_skip b ON a.target = b.item_code JOIN products p ON p.item_code = b.target
        LEFT JOIN sections ON section = p.section_code WHERE NOT a.skipped AND NOT b.skipped""",
}


@query("item_code:s item:s vendor:s rord_grp:s", "SELECT * FROM refreshed_master", **MASTER)
def item_master_refresh(s):
    """The stored master after insert, update and delete."""
    s["item_master"] = s.stored_master
    return item_master.refresh_item_master(s)


def loaded(step: str, source: str, tables: dict[str, str], times: int = 1, beside: str | None = None) -> str:
    """The line of one step: rows left in its table, rows it wrote and those of them without a week, in a first run and again.

    The statements of different steps use the same names, so each count has its own. ``beside`` is what the other step of
    the same table loads.
    """
    both = f"(SELECT count(*) FROM {beside})" if beside else "0"
    undated = "0" if step == "item_master" else "count(*) FILTER (WHERE min_dt IS NULL)"
    counts = f"SELECT {times} * count(*) + {both} AS n, {times} * count(*) AS l, {times} * {undated} AS u FROM {source}"
    return (f"SELECT '{step}' AS step, 'done' AS status, n AS rows, 0 AS keys_repeated, l AS loaded, u AS undated, 'done' AS status_again, 0 AS loaded_again "
            f"FROM ({compose('n:i l:i u:i', counts, tables)})")


ONLINE_LOADED = {**ONLINE_NEW, **ONLINE_USED, **MASTER, "item_master": "SELECT * FROM refreshed_master"}
REFRESHED = [
    loaded("item_master", "refreshed_master", MASTER),
    loaded("new_goods", "open_weeks JOIN live_sections ON true", {**NEW_FOLDS, **CULL}),
    loaded("base_inventory", "b_weeks JOIN base_items ON true WHERE loc_no NOT IN ('00020', '00106')", BASE),
    loaded("serial_items", "s_weeks JOIN (SELECT DISTINCT p_brand FROM part) ON true", SERIAL),
    loaded("frontline", "open_weeks JOIN live_sections ON true", {**FRONT_FOLDS, **CULL}, 4),  # two sources and two programs a section
    loaded("frontline_items", "i_live", ITEM_FOLDS),
    loaded("online_new", "online_new_rows", ONLINE_LOADED, beside="online_used_rows"),
    loaded("online_used", "online_used_rows", ONLINE_LOADED, beside="online_new_rows"),
]


@query("step:s status:s rows:i keys_repeated:i loaded:i undated:i status_again:s loaded_again:i", " UNION ALL ".join(REFRESHED))
def weekly_refresh(s):
    """All load steps into an empty folder, and all of them again, with the rows and repeated keys each left in its table.

    The rows that a step wrote, and those of them without a week, were counted while it wrote them.
    """
    plain = s.sales_line
    s["sales_line"] = plain.unionByName(s.serial_sales_line.select(*plain.columns))  # one table of lines for all steps
    spark = s.part.sparkSession
    target = f"{shared_folder(spark)}/shelfweek-refresh/{uuid.uuid4().hex}"
    src = Sources({name: s[name] for name in REFRESH_TABLES})
    src["item_master"] = s.stored_master
    first, again = (refresh.weekly_refresh(spark, src, target, *all_weeks(s), at_once=3) for _ in range(2))
    rows = None
    for step, table, keys in (("item_master", "item_master", ["item_code"]), *((step, table, keys) for step, table, _, keys in refresh.FACTS)):
        counted = spark.read.parquet(f"{target}/{table}").groupBy(*keys).agg(F.count("*").alias("n")).agg(
            F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("keys_repeated"))
        line = counted.select(
            F.lit(step).alias("step"), F.lit(first[step]).alias("status"), "rows", "keys_repeated", F.lit(first.counts[step].rows).alias("loaded"),
            F.lit(first.counts[step].undated).alias("undated"), F.lit(again[step]).alias("status_again"), F.lit(again.counts[step].rows).alias("loaded_again"))
        rows = line if rows is None else rows.unionByName(line)
    return rows


REFRESH_TABLES = (
    "products", "product_types", "vendors", "base_inventory", "locations", "section_map", "shipment_header", "shipment_detail",
    "receiving_header", "receiving_detail", "sales_line", "sales_header", "transfer_header", "transfer_detail", "buys",
    "serial_inventory", "serial_master", "subjects", "price_changes", "orders_marketplace", "orders_web", "marketplace_detail",
    "facilities", "fulfil_header", "fulfil_detail", "avg_cost", "cost_factors",
)
