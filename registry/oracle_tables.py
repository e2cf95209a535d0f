"""The retail tables of ``standins.py`` stated in SQL, and the composition of a query with the ones it names."""

from __future__ import annotations

import re

M = "DECIMAL(19,4)"


def money(x: str) -> str:
    return f"CAST({x} AS {M})"


def code(x: str, width: int = 20) -> str:
    return f"lpad(CAST({x} AS VARCHAR), CAST(greatest({width}, length(CAST({x} AS VARCHAR))) AS INTEGER), '0')"


def sunday(x: str) -> str:
    return f"(CAST({x} AS DATE) - CAST(dayofweek(CAST({x} AS DATE)) AS INTEGER))"


def week_no(x: str) -> str:
    d = f"CAST({x} AS DATE)"
    return f"((dayofyear({d}) - 1 + dayofweek(CAST(date_trunc('year', {d}) AS DATE))) // 7 + 1)"


def yr(x: str) -> str:
    w, y = week_no(x), f"year(CAST({x} AS DATE))"
    return f"(CASE WHEN {y} >= 2017 AND {w} = 53 THEN {y} + 1 WHEN {y} < 2017 AND {w} = 1 THEN {y} - 1 ELSE {y} END)"


def wk(x: str) -> str:
    w, y = week_no(x), f"year(CAST({x} AS DATE))"
    return (f"(CASE WHEN {y} >= 2017 AND {w} = 53 THEN 1 WHEN {y} >= 2017 THEN {w} "
            f"WHEN {w} = 1 THEN 52 ELSE {w} - 1 END)")


def case(column: str, values: dict, other: str | None = None) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in values.items())
    return f"CASE {column} {whens}" + (f" ELSE {other}" if other else "") + " END"


TYPES = {"ECONOMY": "HBF", "LARGE": "TRF", "MEDIUM": "NBAF", "PROMO": "PRMO", "SMALL": "CALF", "STANDARD": "BDGF"}
SECN = {"Brand#10": "Brand#1", "Brand#20": "Brand#2"}
COMPANY = {"A": "HPB", "N": "TTB", "R": "SUP"}
ORDER_TYPE = {1: "HPB Titles", 2: "TTB WHOLESALE", 3: "TTB Initial", 4: "HPB REORDERS", 5: "SUPPLIES", 6: "WEBORDER",
              7: "TTB Reorders"}
PO = "'P' || " + code("{k}", 6)


def po(k: str) -> str:
    return f"('P' || {code(k, 6)})"


def fact_sum(test: str, value: str, kind: str = "BIGINT") -> str:
    return f"CAST(coalesce(sum(CASE WHEN {test} THEN {value} ELSE 0 END), 0) AS {kind})"


GOODS = {
    "ship_qty": ("a", "q"), "ship_cost": ("a", "v"), "ship_val": ("a AND m", "v"), "rcv_qty": ("n", "q"),
    "rcv_cost": ("n", "v"), "rcv_val": ("n AND m", "v"), "sold_qty": ("o", "q"), "sold_cost": ("o AND m", "v"),
    "sold_val": ("o", "v"), "md_sold_qty": ("o AND m", "q"), "md_cost": ("o AND m AND a", "v"),
    "md_sold_val": ("o AND m AND n", "v"), "rfi_qty": ("r", "q"), "rfi_cost": ("r", "v"),
    "in_sts_qty": ("ln = 3", "q"), "out_sts_qty": ("ln = 4", "q"),
}


def goods(names=None, **extra) -> str:
    picked = {n: GOODS[n] for n in (names or GOODS)} | extra
    return ", ".join(f"{fact_sum(t, v, M if v == 'v' else 'BIGINT')} AS {n}" for n, (t, v) in picked.items())


USED = ("rfi_qty", "rfi_cost", "in_sts_qty", "out_sts_qty", "sold_qty", "sold_val", "md_sold_qty", "md_sold_val")
LABELS = f"{yr('min_dt')} AS yr, {wk('min_dt')} AS wk, *"

TABLES = {
    "order_store": f"""SELECT o.*, left(o_orderpriority, 1) AS priority, {code('c_nationkey', 5)} AS store,
        {code('n_regionkey', 5)} AS region_store, c_mktsegment AS segment
        FROM orders o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "line_store": f"""SELECT l.*, s_nationkey, {code('s_nationkey', 5)} AS store, CAST(l_quantity AS INTEGER) AS q
        FROM lineitem l JOIN supplier ON s_suppkey = l_suppkey""",
    "report_keys": """SELECT *, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS report_key FROM part""",
    "products": f"""SELECT {code('p_partkey')} AS item_code,
        CASE WHEN report_key = p_partkey THEN '' ELSE {code('report_key')} END AS report_item_code,
        p_brand AS section_code, {case('p_type', TYPES)} AS product_type,
        {case("split_part(p_name, ' ', 2)", {'ring': 'IDINGRAMDI', 'bolt': 'IDB&TDISTR', 'gear': 'IDCDCSPECU', 'anvil': 'IDTXBKSTAP'}, "'IDOTHER'")} AS vendor_id,
        {case("split_part(p_name, ' ', 1)", {'small': 'IDAURORA', 'red': 'TEXASBKMNB', 'blue': 'IDCDCSPECU', 'hot': 'WHPBSUPPLY'}, "'IDTOYSMITH'")} AS bought_from,
        CASE WHEN split_part(p_name, ' ', 1) IN ('red', 'new') THEN 'TTB' ELSE '' END AS mark,
        p_size > 25 OR p_retailprice > 950 AS reorder_mark,
        (CASE WHEN p_retailprice > 950 THEN 'Y' ELSE 'N' END) || (CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END) AS marks,
        CASE WHEN p_size > 40 THEN '' ELSE '978' || {code('p_partkey', 10)} END AS isbn,
        '555' || {code('p_partkey', 12)} AS upc, p_name AS title, {money('p_retailprice')} AS price,
        {money('p_size')} AS cost, p_size = 50 AS in_base, p_partkey FROM report_keys""",
    # Products of the weekly facts: base inventory and skipped types are out, unless they are tote bags.
    "new_products": """SELECT *, section_code AS section FROM products
        WHERE NOT ((in_base OR product_type IN ('HPBP','PRMO','SUP','HBF','PBF','TRF'))
                   AND vendor_id <> 'IDTXBKSTAP' AND bought_from <> 'IDTXBKSTAP')""",
    "front_products": """SELECT *, section_code AS section,
        CASE WHEN product_type IN ('HBF','PBF','TRF') THEN 'BS' ELSE 'Frln' END AS src,
        CASE WHEN vendor_id IN ('IDB&TDISTR','IDINGRAMDI') THEN 'Rord' ELSE 'Init' END AS prog,
        coalesce(nullif(isbn, ''), nullif(left(upc, 13), '')) AS ean FROM products
        WHERE NOT ((in_base OR product_type IN ('HPBP','PRMO','SUP'))
                   AND vendor_id <> 'IDTXBKSTAP' AND bought_from <> 'IDTXBKSTAP')
          AND product_type IN ('BDGF','CALF','HBF','LPF','NBAF','NBJF','PBF','TOYF','TRF','VGF')""",
    "stores": f"""SELECT DISTINCT {code('n_nationkey', 5)} AS loc_no FROM nation
        WHERE {code('n_nationkey', 5)} BETWEEN '00001' AND '00150'""",
    "sections": f"""SELECT DISTINCT p_brand AS section, CASE WHEN p_brand < 'Brand#2' THEN 'A' ELSE 'B' END AS cap,
        {case('p_brand', SECN, 'p_brand')} AS secn,
        CASE WHEN p_brand < 'Brand#2' THEN 'TEXASBKNON' END AS ttb_vendor FROM part""",
    "item_master": f"""SELECT {code('p_partkey')} AS item_code,
        {case('p_type', {'ECONOMY': 'BS-i', 'LARGE': 'BS-r', 'MEDIUM': 'CDC', 'PROMO': 'Inac', 'SMALL': 'TEXASBKMNA', 'STANDARD': 'IDAURORA'})} AS vendor,
        {case('p_type', {'ECONOMY': 'BS', 'LARGE': 'BS', 'MEDIUM': 'CDC', 'PROMO': 'HRO', 'SMALL': 'TRO', 'STANDARD': 'HRO'})} AS rord_grp
        FROM part""",
    "stored_master": f"SELECT {code('p_partkey')} AS item_code, {code('p_partkey')} AS item, 'CDC' AS vendor, 'CDC' AS rord_grp FROM part WHERE p_size <= 25",
    "schemes": "SELECT p_brand AS scheme_id, count(*) AS scheme_qty FROM part GROUP BY 1",
    "sales": f"""SELECT CAST(s_nationkey AS VARCHAR) AS location_id, store AS loc_no, {code('l_partkey')} AS item_code, l_partkey,
        CASE l_returnflag WHEN 'R' THEN 'y' WHEN 'N' THEN 'n' END AS flag, CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END AS sgn,
        q, {money('l_extendedprice')} AS unit, {money('l_extendedprice')} - {money('l_discount')} AS reg,
        l_discount > 0 AS below, l_linestatus = 'O' AS ok, CAST(l_shipdate AS DATE) AS day, {sunday('l_shipdate')} AS min_dt,
        l_orderkey, l_linenumber FROM line_store""",
    "transfers": f"""SELECT o_orderkey, store AS from_loc, region_store AS to_loc, {sunday('o_orderdate')} AS min_dt,
        CASE WHEN o_orderstatus = 'P' THEN CASE WHEN priority <= '2' THEN 6 WHEN priority <= '4' THEN 7 ELSE 8 END
             ELSE CAST(priority AS INTEGER) END AS kind,
        NOT (priority = '5' AND o_orderstatus = 'O') AS closed FROM order_store""",
    "transfer_lines": f"""SELECT t.*, {code('l_partkey')} AS item_code, l_partkey, CAST(l_quantity AS INTEGER) AS q,
        CAST({money('l_discount')} * 1000 AS {M}) AS cost FROM transfers t JOIN lineitem ON l_orderkey = o_orderkey
        WHERE closed AND kind BETWEEN 1 AND 7 AND l_linestatus = 'O'""",
    "transfer_ends": """SELECT min_dt, from_loc AS loc_no, item_code, l_partkey, kind, q, cost, false AS inbound FROM transfer_lines
        UNION ALL SELECT min_dt, to_loc, item_code, l_partkey, kind, q, cost, true FROM transfer_lines WHERE kind = 3""",
    "plausible_ends": """SELECT * FROM transfer_ends
        WHERE NOT (cost > 75 AND CAST(cost AS DOUBLE) / q < 50) AND q < 1000 AND cost < 500""",
    "buys": f"""SELECT {sunday('o_orderdate')} AS min_dt, store AS loc_no,
        {case('priority', {'1': 'HBF', '2': 'TRF', '3': 'NBAF', '4': 'CALF', '5': 'BDGF'})} AS product_type,
        day(o_orderdate) AS q, {money('o_totalprice')} AS offer FROM order_store
        WHERE o_orderstatus <> 'P' AND {money('o_totalprice')} < 600000""",
    "serials": f"""SELECT CAST(p_partkey AS INTEGER) AS serial, {code('p_size // 2', 5)} AS loc_no,
        CAST(p_size // 2 AS VARCHAR) AS location_id, p_brand AS subj, p_type <> 'PROMO' AS known,
        CASE WHEN p_type = 'ECONOMY' THEN 'NOST' ELSE {case('p_type', TYPES)} END AS product_type, p_size,
        CAST({money('p_retailprice')} * p_size AS {M}) AS price, stocked
        FROM part JOIN (SELECT l_partkey, min(l_shipdate) AS stocked FROM lineitem GROUP BY 1) f ON l_partkey = p_partkey""",
    "price_log": f"""SELECT serial, {money('l_quantity')} AS old_price, CAST({money('l_discount')} * 100 AS {M}) AS new_price,
        l_shipdate AS changed, price, product_type, loc_no FROM lineitem JOIN serials ON serial = l_partkey""",
    "price_fixes": """SELECT serial, arg_max(old_price, (changed, old_price)) AS fixed FROM price_log
        WHERE price >= 500
          AND least(coalesce(CAST(old_price AS DOUBLE) / nullif(CAST(new_price AS DOUBLE), 0), 1e9),
                    coalesce(CAST(old_price AS DOUBLE) / nullif(CAST(price AS DOUBLE), 0), 1e9))
              < CASE WHEN product_type = 'NOST' THEN 0.001 ELSE 0.02 END
        GROUP BY serial""",
    "priced": """SELECT s.*, coalesce(fixed, price) AS list_price FROM serials s LEFT JOIN price_fixes USING (serial)
        WHERE known AND (price < 5000 OR fixed IS NOT NULL)""",
    "event_rows": f"""SELECT *, json_extract_string(props, '$.k') AS k,
        CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS order_no,
        CAST(floor(value / 100) AS INTEGER) + 1 AS qty, {money('value')} AS amount,
        CASE WHEN value > 100 THEN {money('value')} ELSE CAST(0 AS {M}) END AS refund, CAST(user_id AS {M}) AS fee,
        {code('user_id', 5)} AS home FROM events""",
    # Online events of both sites; a web order is dated again when it is refunded.
    "market_lines": f"""SELECT e.*, fulfil, CASE WHEN value > 5 AND value <= 200 AND left(k, 1) <> '9' THEN amount END AS fulfil_price,
        CASE WHEN value > 5 AND value <= 200 AND left(k, 1) <> '9' THEN lpad(k, 5, '0') ELSE home END AS loc_no
        FROM (SELECT *, 1 AS fulfil FROM event_rows WHERE event_type IN ('purchase', 'signup')) e WHERE value >= 1""",
    "online_rows": f"""SELECT {sunday('ts')} AS min_dt, loc_no, event_type = 'purchase' AS is_new, k, order_no, 's' AS dir, 'i' AS site,
            qty, amount, fulfil_price AS used_amount, fee, CAST(0 AS {M}) AS refund FROM market_lines
        UNION ALL SELECT {sunday("ts + INTERVAL 7 DAY")}, loc_no, event_type = 'purchase', k, order_no, 'r', 'i', 0, 0, 0, 0, refund
            FROM market_lines WHERE refund > 0
        UNION ALL SELECT {sunday('ts')}, home, event_type = 'click', k, order_no, 's', 'h', qty, CAST(amount * qty AS {M}),
            CAST(amount * qty AS {M}), fee, 0 FROM event_rows WHERE event_type IN ('click', 'error') AND value >= 2
        UNION ALL SELECT {sunday("ts + INTERVAL 3 DAY")}, home, event_type = 'click', k, order_no, 'r', 'h', 0, 0, 0, 0, refund
            FROM event_rows WHERE event_type IN ('click', 'error') AND value >= 2 AND refund > 0""",
    "wh_lines": f"""SELECT o_orderkey, o_orderdate, {sunday('o_orderdate')} AS min_dt, store AS ship_to,
        {case('segment', {'HOUSEHOLD': 'HPB', 'MACHINERY': 'HPB', 'FURNITURE': 'RETAIL'}, 'segment')} AS head_customer,
        l_partkey, CAST(l_partkey AS VARCHAR) AS item, {case('l_linenumber', ORDER_TYPE)} AS order_type,
        {case('l_returnflag', COMPANY)} AS company, CASE WHEN l_linestatus = 'O' THEN 'HPB' ELSE 'RETAIL' END AS customer,
        p_brand AS section, CAST(l_quantity AS INTEGER) AS q, l_linenumber * 130 AS status1, l_shipdate
        FROM order_store JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""",
    "wh_stock": f"""SELECT l_partkey, CAST(l_partkey AS VARCHAR) AS item, {code('l_partkey')} AS item_code,
        sum(CASE WHEN l_returnflag <> 'R' THEN q ELSE -q END) - sum(CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END) AS free,
        count(*) AS in_transit, min(l_shipdate) AS first_dt, count(DISTINCT l_suppkey) AS lines,
        max(first_of_lot) AS last_dt
        FROM (SELECT *, min(l_shipdate) OVER (PARTITION BY l_partkey, l_suppkey) AS first_of_lot FROM line_store
              JOIN (SELECT s_suppkey AS k, s_acctbal FROM supplier) b ON k = l_suppkey
              WHERE s_acctbal > 2000 AND s_nationkey < 20) GROUP BY l_partkey""",
    "po_lines": f"""SELECT {po('l_orderkey')} AS po_id, l_orderkey, l_partkey, CAST(l_partkey AS VARCHAR) AS item,
        {case('l_returnflag', COMPANY)} AS company, 'Sch' || CAST(l_linenumber AS VARCHAR) AS scheme_id,
        CAST(l_quantity AS INTEGER) AS q, l_shipdate, l_linestatus, l_linenumber, o_orderdate, o_orderpriority, o_orderstatus,
        p_brand AS section, p_name, l_tax FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "receipt_lines": """SELECT *, po_id || '.01' AS receipt_id,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3 DAY END AS close_date FROM po_lines
        WHERE o_orderpriority <> '1-URGENT' AND l_linenumber <= 5""",
    "ledger": f"""SELECT {code('l_partkey')} AS item_code, store AS loc, l_shipdate AS date,
        CASE l_linestatus || l_returnflag WHEN 'OA' THEN 'CDC' WHEN 'ON' THEN 'Sale' WHEN 'OR' THEN 'Rtrn'
             WHEN 'FA' THEN 'Drps' WHEN 'FN' THEN 'iSale' ELSE 'Move' END AS xacn,
        CASE WHEN l_returnflag = 'N' THEN -q ELSE q END AS qty FROM line_store""",
    "ledger_items": f"SELECT {code('p_partkey')} AS item_code, {code('report_key')} AS rpt_it FROM report_keys WHERE p_type <> 'PROMO'",
    "reorder_items": f"SELECT {code('p_partkey')} AS item_code, {code('report_key')} AS rpt_it FROM report_keys WHERE p_size > 25",
    "suggestions": f"""SELECT CASE WHEN l_linestatus = 'O' THEN 51 ELSE 36 END AS set_id, {code('l_partkey')} AS rpt_it, store AS loc,
        CASE WHEN l_tax > 0.01 THEN q ELSE 0 END AS order_qty FROM line_store""",
    "fact_lines": f"""SELECT {sunday('l_shipdate')} AS min_dt, store AS loc_no, item_code, section_code AS section, product_type, isbn, upc,
        title, q, {money('l_extendedprice')} AS v, l_returnflag = 'A' AS a, l_returnflag = 'N' AS n, l_returnflag = 'R' AS r,
        l_linestatus = 'O' AS o, l_discount > 0.05 AS m, l_linenumber AS ln FROM line_store JOIN products ON p_partkey = l_partkey""",
    "fact_new_goods": f"SELECT {LABELS} FROM (SELECT min_dt, section, loc_no, {goods()} FROM fact_lines GROUP BY ALL)",
    "fact_frontline": f"""SELECT {LABELS} FROM (SELECT min_dt, CASE WHEN product_type IN ('HBF', 'TRF') THEN 'BS' ELSE 'Frln' END AS src,
        section, loc_no, {goods(rtn_qty=('r AND m', 'q'), rtn_cost=('r AND m', 'v'))} FROM fact_lines GROUP BY ALL)""",
    "fact_base_inventory": f"""SELECT {LABELS} FROM (SELECT min_dt, item_code, product_type, loc_no,
        {goods(USED, buy_qty=('n', 'q'), buy_cost=('n', 'v'), bsm_qty=('ln = 5', 'q'), bsm_cost=('ln = 5', 'v'))}
        FROM fact_lines GROUP BY ALL)""",
    "fact_serial_items": f"""SELECT {LABELS} FROM (SELECT min_dt, section AS subj, loc_no,
        {goods(USED, made_qty=('n AND m', 'q'), made_list=('n AND m', 'v'), bsm_qty=('ln = 6', 'q'))}
        FROM fact_lines GROUP BY ALL)""",
    "fact_online": f"""SELECT {LABELS} FROM (SELECT min_dt, CASE WHEN product_type = 'CALF' THEN 'Used' ELSE 'New' END AS used_new,
        CASE WHEN product_type = 'CALF' THEN 'SIPS' WHEN product_type IN ('HBF', 'TRF') THEN 'BS' ELSE 'DIPS' END AS src, loc_no,
        CASE WHEN section < 'Brand#2' THEN 'A' ELSE 'B' END AS cap, {case('section', SECN, 'section')} AS secn,
        CASE WHEN o THEN 'h' ELSE 'i' END AS site, {fact_sum('n', 'q')} AS sold_qty, {fact_sum('n AND m', 'v', M)} AS sold_cost,
        {fact_sum('n', 'v', M)} AS sold_val, {fact_sum('n', 'q', M)} AS sold_fee, {fact_sum('r', 'ln')} AS rfnd_ords,
        {fact_sum('r AND m', 'v', M)} AS rfnd_amt FROM fact_lines GROUP BY ALL)""",
    "fact_items": f"""SELECT {LABELS} FROM (SELECT min_dt, coalesce(nullif(isbn, ''), left(upc, 13)) AS ean, item_code, title,
        CASE WHEN product_type IN ('HBF', 'TRF', 'NBAF') THEN 'BS' ELSE 'Frln' END AS src, loc_no,
        {fact_sum('a', 'q')} AS ship_qty, {fact_sum('n', 'q')} AS rcv_qty, {fact_sum('o', 'q')} AS st_sold_qty,
        {fact_sum('o AND m', 'q')} AS md_st_sold_qty, {fact_sum('r', 'q')} AS st_rfnd_qty FROM fact_lines GROUP BY ALL)""",
}

KINDS = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def compose(columns: str, body: str, extra: dict[str, str] | None = None) -> str:
    """A full statement: the named tables the body needs, the body, and the typed output columns.

    ``columns`` lists ``name:kind`` pairs.
    """
    tables = {**TABLES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if name in tables and name not in needed:
                visit(tables[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = ", ".join(f"{name} AS MATERIALIZED ({tables[name]})" for name in needed)
    picked = ", ".join(
        f"CAST({name} AS {KINDS[kind]}) AS {name}" for name, kind in (c.split(":") for c in columns.split())
    )
    return (f"WITH {ctes} " if ctes else "") + f"SELECT {picked} FROM ({body}) AS body"
