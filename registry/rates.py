"""Rates of sale: per section and channel, per report item, and the outputs built on them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from registry.base import query
from registry.oracle_tables import code, sunday, wk, yr
from registry.reports import placed, read_back, report_path
from registry.standins import SUBJECT_LABEL, facts
from shelfweek.operators.joins import reconcile
from shelfweek.plans import merged_rates as mr
from shelfweek.plans import report_jobs
from shelfweek.plans import section_rates as sr
from shelfweek.sources.tables import staged

AS_OF = date(2001, 11, 11)
LAST = AS_OF - timedelta(weeks=1)
MONTHS, YEARS = 9, 6
R = "DECIMAL(19,6)"
D5 = "DECIMAL(19,5)"
WEEKS_OF_REPORT = f"""SELECT min_dt, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk FROM (
    SELECT CAST(unnest(generate_series(DATE '1998-01-04', DATE '{LAST}', INTERVAL 7 DAY)) AS DATE) AS min_dt)
    WHERE {yr('min_dt')} BETWEEN 1999 AND 2001"""

SERIES = {
    "r_weeks": WEEKS_OF_REPORT,
    # One label stands at a subject only.
    "labels": f"SELECT section, cap, secn FROM sections UNION ALL SELECT NULL, '{SUBJECT_LABEL[0]}', '{SUBJECT_LABEL[1]}'",
    "c_store": "SELECT section, min_dt, sum(ship_qty) AS ship_qty, sum(sold_qty) AS st_sold_qty FROM fact_new_goods GROUP BY ALL",
    "c_online": "SELECT secn AS section, min_dt, sum(sold_qty) AS onl_sold_qty FROM fact_online WHERE used_new = 'New' GROUP BY ALL",
    "c_wholesale": """SELECT section, min_dt, count(DISTINCT item) AS wh_sold_its, sum(q) AS wh_sold_qty FROM wh_lines
        WHERE order_type IN ('TTB WHOLESALE', 'WEBORDER') GROUP BY ALL""",
    "channel_rows": """SELECT *, st_sold_qty + onl_sold_qty + wh_sold_qty AS sold_qty FROM (
        SELECT yr, wk, min_dt, cap, secn, sum(coalesce(ship_qty, 0)) AS ship_qty, sum(coalesce(st_sold_qty, 0)) AS st_sold_qty,
            sum(coalesce(onl_sold_qty, 0)) AS onl_sold_qty, count(onl_sold_qty) AS onl_rows, sum(coalesce(wh_sold_qty, 0)) AS wh_sold_qty,
            count(wh_sold_qty) AS wh_rows
        FROM r_weeks JOIN labels ON true LEFT JOIN c_store USING (section, min_dt) LEFT JOIN c_online USING (section, min_dt)
        LEFT JOIN c_wholesale USING (section, min_dt) GROUP BY yr, wk, min_dt, cap, secn)""",
}
MARKS = {"": "sold_qty", "s": "st_sold_qty", "o": "onl_sold_qty", "w": "wh_sold_qty"}


def frame(value: str, first: str, last: str, n: int) -> str:
    return (f"CAST(CAST(sum({value}) OVER (PARTITION BY secn ORDER BY min_dt ROWS BETWEEN {first} AND {last}) AS DOUBLE) / {n}.0 "
            f"AS {R})")


SERIES["rated"] = "SELECT *, " + ", ".join(
    f"{frame(q, '3 PRECEDING', 'CURRENT ROW', 4)} AS {m}ros, {frame(q, '1 FOLLOWING', '4 FOLLOWING', 4)} AS next_{m}ros"
    for m, q in MARKS.items()) + " FROM channel_rows"
SERIES["moved"] = "SELECT *, " + ", ".join(
    ", ".join([f"{m}ros - lag({m}ros, 1) OVER w AS d1_{m}ros", f"lag({m}ros, 1) OVER w - lag({m}ros, 2) OVER w AS d2_{m}ros",
               f"lag({m}ros, 2) OVER w - lag({m}ros, 3) OVER w AS d3_{m}ros",
               *[f"lead(next_{m}ros, {4 * n}) OVER w AS f{n}_next_{m}ros" for n in range(1, 5)]])
    for m in MARKS) + " FROM rated WHERE yr >= 2000 WINDOW w AS (PARTITION BY secn ORDER BY min_dt)"
EXPECTED = ", ".join(
    [f"a.{m}ros, b.{m}ros AS ly_{m}ros" for m in MARKS]
    + [f"CAST(b.{'next_' + m + 'ros' if n == 1 else f'f{n - 1}_next_{m}ros'} * 4 AS {R}) AS exp_{m}{n}mo" for m in MARKS for n in range(1, 6)]
    + [f"CAST(CAST(a.{x} AS DOUBLE) / nullif(CAST(b.{x} AS DOUBLE), 0) AS {R}) AS {name}" for name, x in
       (("mo_reb", "ros"), ("wk_reb", "sold_qty"), ("mo_sreb", "sros"), ("wk_sreb", "st_sold_qty"))]
    + [f"a.d{n}_{m}ros" for m in MARKS for n in (1, 2)])
# Two weeks share the label (2000, 52) or (1999, 52) in no case that the last week meets; the earlier one would stand for it.
SERIES["expected"] = f"""SELECT a.yr, a.wk, a.min_dt, a.cap, a.secn, {EXPECTED} FROM moved a LEFT JOIN moved b
    ON b.secn = a.secn AND b.yr = a.yr - 1 AND b.wk = a.wk WHERE a.min_dt = DATE '{LAST}'"""


def series(s):
    return sr.channel_series(s, facts(s), AS_OF, date(1995, 1, 1))


def doubles(*names: str) -> str:
    return " ".join(f"{name}:d" for name in names)


@query(
    "yr:i wk:i min_dt:s cap:s secn:s ship_qty:i st_sold_qty:i onl_sold_qty:i onl_rows:i wh_sold_qty:i wh_rows:i sold_qty:i",
    "SELECT * FROM channel_rows", **SERIES,
)
def combined_channels(s):
    """Store, online and wholesale quantities per section label and week on the dense spine."""
    return series(s)


@query(
    "yr:i wk:i min_dt:s cap:s secn:s " + doubles(*[n for m in MARKS for n in (f"{m}ros", f"next_{m}ros")]),
    "SELECT * FROM rated", **SERIES,
)
def trailing_forward_rates(s):
    return sr.rates(series(s))


@query(
    "min_dt:s secn:s " + doubles(*[f"d{n}_{m}ros" for m in MARKS for n in (1, 2, 3)]),
    "SELECT * FROM moved", **SERIES,
)
def rate_momentum(s):
    return sr.rate_momentum(sr.rates(series(s)), 2000)


@query(
    "min_dt:s secn:s " + doubles(*[f"f{n}_next_{m}ros" for m in MARKS for n in range(1, 5)]),
    "SELECT * FROM moved", **SERIES,
)
def future_rates(s):
    return sr.rate_momentum(sr.rates(series(s)), 2000)


@query(
    "yr:i wk:i min_dt:s cap:s secn:s " + doubles(
        *[n for m in MARKS for n in (f"{m}ros", f"ly_{m}ros")], *[f"exp_{m}{n}mo" for m in MARKS for n in range(1, 6)],
        "mo_reb", "wk_reb", "mo_sreb", "wk_sreb", *[f"d{n}_{m}ros" for m in MARKS for n in (1, 2)]),
    "SELECT * FROM expected", **SERIES,
)
def expected_sales_yoy(s):
    return sr.expected_sales(sr.rate_momentum(sr.rates(series(s)), 2000), LAST)


RATE_REPORT = (
    "yr:i wk:i min_dt:s cap:s secn:s " + doubles("ly_sros", "sros", "ly_oros", "oros", "ly_wros", "wros", "s_next_3mo", "o_next_3mo",
                                                "w_next_3mo"),
    "SELECT *, " + ", ".join(f"CAST(CAST(exp_{m}1mo + exp_{m}2mo + exp_{m}3mo AS DOUBLE) / 12.0 AS {R}) AS {m}_next_3mo" for m in "sow")
    + " FROM expected",
)


@query(*RATE_REPORT, **SERIES)
def section_rate_output(s):
    """The rate report of the last week."""
    return sr.rates_output(sr.expected_sales(sr.rate_momentum(sr.rates(staged(series(s), "channel-series")), 2000), LAST))


@query("line_no:i " + RATE_REPORT[0], f"SELECT *, {placed('section_rates')} FROM ({RATE_REPORT[1]})", **SERIES)
def section_rate_file(s):
    """The rate report of the last week as a file, read back line by line."""
    path = report_path(s.part.sparkSession)
    expected = sr.expected_sales(sr.rate_momentum(sr.rates(staged(series(s), "channel-series")), 2000), LAST)
    return read_back(s, path, report_jobs.write_section_rates(expected, path), "section_rates")


SHIPS = {
    "t_items": """SELECT secn, min_dt, item, sum(q) AS q, sum(CASE WHEN order_type IN ('TTB Reorders', 'TTB Initial') THEN q ELSE 0 END) AS tro,
        max(order_type IN ('TTB Reorders', 'TTB Initial')) AS is_tro, max(order_type NOT IN ('TTB Reorders', 'TTB Initial')) AS is_wh
        FROM wh_lines JOIN sections USING (section) WHERE company = 'TTB' AND order_type IN ('TTB WHOLESALE', 'WEBORDER', 'TTB Reorders', 'TTB Initial')
        GROUP BY ALL""",
    "t_sums": """SELECT secn, min_dt, sum(q) AS ship_qty, count(*) AS ship_its, sum(tro) AS tro_ship_qty, count(*) FILTER (WHERE is_tro) AS tro_ship_its,
        sum(q - tro) AS wh_ship_qty, count(*) FILTER (WHERE is_wh) AS wh_ship_its FROM t_items GROUP BY ALL""",
    "t_dense": f"""SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, min_dt, secn, {', '.join(f'coalesce({n}, 0) AS {n}' for n in (
        'ship_qty', 'ship_its', 'tro_ship_qty', 'tro_ship_its', 'wh_ship_qty', 'wh_ship_its'))},
        date_diff('day', DATE '{AS_OF}', min_dt) // 7 AS weeks_off
        FROM (SELECT DISTINCT secn FROM sections) JOIN (SELECT CAST(unnest(generate_series(DATE '{AS_OF - timedelta(weeks=68)}', DATE '{LAST}',
              INTERVAL 7 DAY)) AS DATE) AS min_dt) ON true LEFT JOIN t_sums USING (secn, min_dt)""",
}
FRAMES = {"ly_1m": (55, 52, 4), "next_ly_1m": (51, 48, 4), "cr_1m": (3, 0, 4), "ly_4m": (67, 52, 16), "next_ly_4m": (51, 36, 16),
          "cr_4m": (15, 0, 16)}


@query(
    "yr:i wk:i min_dt:s secn:s ship_qty:i ship_its:i tro_ship_qty:i tro_ship_its:i wh_ship_qty:i wh_ship_its:i weeks_off:i",
    "SELECT * FROM t_dense", **SHIPS,
)
def ships_by_program(s):
    return sr.ships_by_program(s.wh_shipment_tiers, s.section_map, AS_OF, s.part.sparkSession)


TITLE_REPORT = (
    "yr:i min_dt:s secn:s " + doubles(*[f"{n}_{m}" for m in ("its", "qty") for n in FRAMES]),
    "SELECT * FROM (SELECT *, " + ", ".join(
        f"{frame('ship_' + m, f'{a} PRECEDING', f'{b} PRECEDING' if b else 'CURRENT ROW', n)} AS {name}_{m}"
        for m in ("its", "qty") for name, (a, b, n) in FRAMES.items()) + " FROM t_dense) WHERE weeks_off = -1",
)


@query(*TITLE_REPORT, **SHIPS)
def before_after_frames(s):
    return sr.before_after(sr.ships_by_program(s.wh_shipment_tiers, s.section_map, AS_OF, s.part.sparkSession))


# --- report items ---------------------------------------------------------------------------------

SINCE = mr.months_before(AS_OF, MONTHS)
CUTOFF = mr.months_before(AS_OF, 12 * YEARS)
TS = f"TIMESTAMP '{AS_OF} 00:00:00'"
ITEMS = {
    "w_lines": """SELECT *, lpad(item, 20, '0') AS item_code FROM wh_lines WHERE order_type IN ('TTB WHOLESALE', 'WEBORDER') AND company = 'TTB'""",
    "w_kept": f"""SELECT * FROM w_lines WHERE item NOT IN (SELECT item FROM w_lines GROUP BY 1 HAVING min(o_orderdate) < DATE '{CUTOFF}')""",
    "stocked": "SELECT item, item_code, free FROM wh_stock WHERE free > 0",
    "wholesale": f"""SELECT coalesce(rpt_it, item_code) AS rpt_it, CASE WHEN max(free) > 0 THEN 'active' ELSE 'inac' END AS active,
        min(o_orderdate) AS min_ship_dt, sum(CASE WHEN o_orderdate >= DATE '{SINCE}' THEN q ELSE 0 END) AS cr_sold_qty, sum(q) AS at_sold_qty,
        count(DISTINCT CASE WHEN o_orderdate >= DATE '{SINCE}' THEN head_customer END) AS cr_custs, count(DISTINCT head_customer) AS at_custs,
        CAST(CAST(sum(CASE WHEN o_orderdate >= DATE '{SINCE}' THEN q ELSE 0 END) AS DOUBLE) / 30.3 / {MONTHS}.0 AS {R}) AS cr_wh_ros,
        coalesce(nullif(date_diff('hour', min(o_orderdate), max(o_orderdate)), 0), 672) AS hours,
        CAST(CAST(sum(q) * 24 AS DOUBLE) / CAST(hours AS DOUBLE) AS {R}) AS at_wh_ros, CAST(CAST(hours AS DOUBLE) / 24.0 AS {D5}) AS active_days,
        CAST(CAST(date_diff('hour', max(o_orderdate), {TS}) AS DOUBLE) / 24.0 AS {D5}) AS days_diff
        FROM (SELECT item_code, item, o_orderdate, q, head_customer FROM w_kept) LEFT JOIN ledger_items USING (item_code)
        LEFT JOIN (SELECT item, free FROM stocked) USING (item) GROUP BY 1 HAVING sum(q) > 0""",
    "stale": f"""SELECT rpt_it FROM ledger JOIN ledger_items USING (item_code) GROUP BY 1 HAVING max(date) < DATE '{CUTOFF}'""",
    "base_rows": f"""SELECT {code('l_partkey')} AS item_code, store AS loc, count(*) AS lgi, sum(q) AS sold_qty, max(l_shipdate) AS max_dt
        FROM line_store GROUP BY ALL""",
    "alltime": f"""SELECT rpt_it, count(*) FILTER (WHERE cur) AS cr_locs, count(*) AS at_locs, sum(lgi) AS lgi, sum(sold_qty) AS at_sold_qty,
        CAST(sum(ros) AS {R}) AS at_ros, max(avg_ros) AS avg_loc_ros FROM (
        SELECT rpt_it, loc, sum(lgi) AS lgi, sum(sold_qty) AS sold_qty, max(lgi > 1 AND max_dt > DATE '{SINCE}') AS cur, max(avg_ros) AS avg_ros,
            sum(CASE WHEN lgi > 3 THEN CAST((avg_ros + lgi * 0.125) / 2 AS {R}) ELSE CAST(lgi * 0.125 AS {R}) END) AS ros
        FROM base_rows JOIN ledger_items USING (item_code)
        JOIN (SELECT item_code, count(*) * 0.25 AS avg_ros FROM base_rows GROUP BY 1) USING (item_code)
        WHERE item_code NOT IN (SELECT rpt_it FROM stale) GROUP BY ALL) GROUP BY 1""",
    "ledger_rows": f"""SELECT *, xacn IN ('CDC', 'Drps') AS sent, xacn IN ('Sale', 'iSale', 'hSale', 'Rtrn') AS sold, date > DATE '{SINCE}' AS cur FROM ledger""",
    "current_rates": f"""SELECT rpt_it, CASE WHEN max(free) > 0 THEN 'active' ELSE 'inac' END AS active, min(date) AS min_ship_dt,
        CAST(CAST(date_diff('hour', min(date), max(date)) AS DOUBLE) / 24.0 AS {D5}) AS active_days,
        CAST(CAST(date_diff('hour', max(date), {TS}) AS DOUBLE) / 24.0 AS {D5}) AS days_diff,
        sum(CASE WHEN sent AND cur THEN qty ELSE 0 END) AS cr_ship_qty, sum(CASE WHEN sent THEN qty ELSE 0 END) AS at_ship_qty,
        count(DISTINCT CASE WHEN cur THEN loc END) AS cr_locs, sum(CASE WHEN sold AND cur THEN -qty ELSE 0 END) AS cr_sold_qty,
        CAST(CAST(sum(CASE WHEN sold AND cur THEN -qty ELSE 0 END) AS DOUBLE) / 30.3 / {MONTHS}.0 AS {R}) AS cr_ros,
        sum(CASE WHEN sold THEN -qty ELSE 0 END) AS at_sold_qty,
        CAST(CAST(sum(CASE WHEN sold THEN -qty ELSE 0 END) AS DOUBLE) / nullif(CAST(date_diff('day', min(date), max(date)) AS DOUBLE), 0) AS {R}) AS at_ros
        FROM ledger_rows JOIN ledger_items USING (item_code) LEFT JOIN stocked USING (item_code) WHERE rpt_it NOT IN (SELECT rpt_it FROM stale) GROUP BY 1""",
    "universe": "SELECT rpt_it FROM wholesale UNION SELECT rpt_it FROM alltime UNION SELECT rpt_it FROM current_rates",
    "placed_items": """SELECT i.rord_grp, cap, cap AS goal_grp, secn, section, scheme_qty, rpt_it, CASE WHEN coalesce(held, 0) > 0 THEN 'active' ELSE 'inac' END AS active
        FROM universe JOIN item_master i ON i.item_code = rpt_it JOIN products p ON p.item_code = rpt_it JOIN sections ON section = section_code
        JOIN schemes ON scheme_id = section LEFT JOIN (SELECT rpt_it, sum(free) AS held FROM stocked JOIN ledger_items USING (item_code) GROUP BY 1) USING (rpt_it)""",
    "merged_items": f"""SELECT rord_grp, cap, goal_grp, secn, rpt_it, s.active, coalesce(c.min_ship_dt, w.min_ship_dt) AS min_ship_dt,
        greatest(coalesce(c.active_days, 0), coalesce(w.active_days, 0)) AS active_days, greatest(coalesce(c.days_diff, 0), coalesce(w.days_diff, 0)) AS days_diff,
        coalesce(lgi, 0) AS lgi, coalesce(cr_ros, 0) + coalesce(cr_wh_ros, 0) AS cr_ros, coalesce(a.at_ros, 0) + coalesce(at_wh_ros, 0) AS at_zid_ros,
        coalesce(c.at_ros, 0) + coalesce(at_wh_ros, 0) AS at_ros, coalesce(cr_wh_ros, 0) AS cr_wh_ros, coalesce(at_wh_ros, 0) AS at_wh_ros,
        coalesce(at_ship_qty, 0) AS at_rtl_ship_qty, coalesce(c.at_sold_qty, 0) AS at_rtl_sold_qty,
        coalesce(c.cr_sold_qty, 0) + coalesce(w.cr_sold_qty, 0) AS cr_sold_qty, coalesce(c.at_sold_qty, 0) + coalesce(w.at_sold_qty, 0) AS at_sold_qty,
        coalesce(w.cr_sold_qty, 0) AS cr_wh_sold_qty, coalesce(w.at_sold_qty, 0) AS at_wh_sold_qty, coalesce(a.cr_locs, 0) AS cr_locs,
        coalesce(at_locs, 0) AS at_locs, coalesce(cr_custs, 0) AS cr_wh_custs, coalesce(at_custs, 0) AS at_wh_custs
        FROM placed_items s LEFT JOIN alltime a USING (rpt_it) LEFT JOIN current_rates c USING (rpt_it) LEFT JOIN wholesale w USING (rpt_it)""",
}


def stale(s):
    return mr.stale_items(cells(s), s.ledger_items, CUTOFF)


def cells(s):
    return mr.ledger_cells(s.ledger, AS_OF, MONTHS)


def free_stock(s):
    return mr.available_stock(s.wh_inventory, s.wh_location)


@query(
    "item:s inv_qty:i first_date:s last_date:s lines:i",
    """SELECT item, free AS inv_qty, CAST(CAST(first_dt AS DATE) AS VARCHAR) AS first_date, CAST(CAST(last_dt AS DATE) AS VARCHAR) AS last_date, lines
        FROM wh_stock WHERE free > 0""",
)
def available_stock(s):
    return free_stock(s)


@query(
    "rpt_it:s active:s min_ship_dt:s cr_sold_qty:i at_sold_qty:i cr_custs:i at_custs:i cr_wh_ros:d at_wh_ros:d active_days:d days_diff:d",
    "SELECT * REPLACE (CAST(min_ship_dt AS DATE) AS min_ship_dt) FROM wholesale", **ITEMS,
)
def wholesale_rates(s):
    return mr.wholesale_rates(mr.wholesale_lines(*s.wh_shipment_tiers), s.ledger_items, free_stock(s), AS_OF, MONTHS, YEARS)


@query(
    "rpt_it:s cr_locs:i at_locs:i lgi:i at_sold_qty:i at_ros:d avg_loc_ros:d", "SELECT * FROM alltime", **ITEMS,
)
def alltime_retail_rates(s):
    return mr.alltime_retail_rates(s.order_base, s.order_equivs, s.ledger_items, stale(s), AS_OF, MONTHS)


@query(
    "rpt_it:s active:s min_ship_dt:s active_days:d days_diff:d cr_ship_qty:i at_ship_qty:i cr_locs:i cr_sold_qty:i cr_ros:d at_sold_qty:i at_ros:d",
    "SELECT * REPLACE (CAST(min_ship_dt AS DATE) AS min_ship_dt) FROM current_rates", **ITEMS,
)
def current_retail_rates(s):
    return mr.current_retail_rates(cells(s), s.ledger_items, s.item_master, free_stock(s), stale(s), AS_OF, MONTHS)


RATE_COLUMNS = ("rord_grp:s cap:s goal_grp:s secn:s rpt_it:s active:s min_ship_dt:s active_days:d days_diff:d lgi:i cr_ros:d at_zid_ros:d at_ros:d "
                "cr_wh_ros:d at_wh_ros:d at_rtl_ship_qty:i at_rtl_sold_qty:i cr_sold_qty:i at_sold_qty:i cr_wh_sold_qty:i at_wh_sold_qty:i cr_locs:i "
                "at_locs:i cr_wh_custs:i at_wh_custs:i")


@query(RATE_COLUMNS, "SELECT * REPLACE (CAST(min_ship_dt AS DATE) AS min_ship_dt) FROM merged_items", **ITEMS)
def merged_item_rates(s):
    return mr.merged_rates(s, AS_OF, MONTHS, YEARS)


def sql_if(test: str, column: str) -> str:
    return f"sum(CASE WHEN {test} THEN {column} ELSE 0 END)"


ACTIVE, IDLE = "active = 'active'", "active = 'inac'"
PARTS = {
    "items": "count(rpt_it)", "ac_items": f"count(*) FILTER (WHERE {ACTIVE})", "ia_cr_items": f"count(*) FILTER (WHERE {IDLE} AND cr_sold_qty > 0)",
    "lgi": "sum(lgi)", "cr_sold_qty": "sum(cr_sold_qty)", "at_sold_qty": "sum(at_sold_qty)",
    **{f"ac_{n}": sql_if(ACTIVE, n) for n in ("cr_sold_qty", "cr_wh_sold_qty", "at_sold_qty", "at_wh_sold_qty")},
    **{f"ia_{n}": sql_if(IDLE, n) for n in ("cr_sold_qty", "cr_wh_sold_qty", "at_sold_qty", "at_wh_sold_qty")},
}
RATE_PARTS = {
    **{n: f"sum({n})" for n in ("cr_ros", "cr_wh_ros", "at_ros", "at_zid_ros")},
    **{f"ac_{n}": sql_if(ACTIVE, n) for n in ("cr_ros", "cr_wh_ros", "at_ros", "at_zid_ros", "at_wh_ros")},
    **{f"ia_{n}": sql_if(f"{IDLE} AND cr_sold_qty > 0", n) for n in ("cr_ros", "cr_wh_ros")},
    **{f"ia_{n}": sql_if(f"{IDLE} AND at_sold_qty > 0", n) for n in ("at_ros", "at_wh_ros")},
}


PROGRAM_REPORT = (
    "rord_grp:s cap:s goal_grp:s secn:s default_scheme:s scheme_qty:i " + " ".join(f"{n}:i" for n in PARTS) + " " + doubles(*RATE_PARTS),
    "SELECT g.*, section AS default_scheme, scheme_qty FROM (SELECT rord_grp, cap, goal_grp, secn, "
    + ", ".join(f"{sql} AS {name}" for name, sql in {**PARTS, **RATE_PARTS}.items())
    + " FROM merged_items WHERE rord_grp = 'TRO' GROUP BY ALL) g JOIN (SELECT section FROM sections) ON section = secn LEFT JOIN schemes ON scheme_id = section",
)


@query(*PROGRAM_REPORT, **ITEMS)
def program_section_rates(s):
    return sr.program_section_rates(mr.merged_rates(s, AS_OF, MONTHS, YEARS), s.section_map, s.scheme_header)


RECEIPT_REPORT = (
    "company:s secn:s rord_grp:s receipt_id:s receipt_dt:s vendor:s item:s title:s cost:d price:d qty:i",
    """SELECT company, secn, rord_grp, receipt_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS receipt_dt, o_orderpriority AS vendor, item, p_name AS title,
        cost, price, sum(q) AS qty FROM (SELECT *, lpad(item, 20, '0') AS item_code FROM receipt_lines WHERE close_date IS NULL AND l_linestatus = 'O'
            AND company IN ('HPB', 'TTB') AND o_orderdate >= DATE '2000-01-01') JOIN sections USING (section)
        JOIN (SELECT item_code, rord_grp FROM item_master WHERE rord_grp IN ('CDC', 'TRO')) USING (item_code)
        JOIN (SELECT item_code, cost, price FROM products) USING (item_code) GROUP BY ALL""",
)


@query(*RECEIPT_REPORT)
def open_receipts(s):
    return sr.open_receipts(s)


# --- the section report as one job ----------------------------------------------------------------

def section_report(s, part: str):
    return sr.section_rates(s, facts(s), AS_OF)[part]


@query(*RATE_REPORT, **SERIES)
def section_report_rates(s):
    return section_report(s, "rates")


@query(TITLE_REPORT[0], TITLE_REPORT[1] + " AND secn <> '0'", **SHIPS)
def section_report_titles(s):
    return section_report(s, "title_counts")


@query(*PROGRAM_REPORT, **ITEMS)
def section_report_programs(s):
    return section_report(s, "program_rates")


@query(*RECEIPT_REPORT)
def section_report_receipts(s):
    return section_report(s, "open_receipts")


@query(
    "end_dt:s last_dt:s last_yr:i last_wk:i base_dt:s base_wk:i target_yr:i target_wk:i weeks:i lines:i",
    f"""SELECT DATE '{AS_OF}' AS end_dt, min_dt AS last_dt, {yr('min_dt')} AS last_yr, {wk('min_dt')} AS last_wk, base_dt, {wk('base_dt')} AS base_wk,
        {yr('target_dt')} AS target_yr, {wk('target_dt')} AS target_wk, weeks, lines FROM
        (SELECT max({sunday('l_shipdate')}) AS min_dt, count(DISTINCT {sunday('l_shipdate')}) AS weeks, count(*) AS lines FROM lineitem),
        (SELECT DATE '{AS_OF - timedelta(weeks=16)}' AS base_dt, DATE '{AS_OF + timedelta(weeks=16)}' AS target_dt)""",
)
def date_fence(s):
    """The report's dates beside the weeks and lines the tables hold up to its last week."""
    fence = sr.date_fence(s.part.sparkSession, AS_OF)
    held = s.fact_lines.groupBy("min_dt").agg(F.count("*").alias("n")).agg(
        F.max("min_dt").alias("last_dt"), F.count("*").alias("weeks"), F.sum("n").alias("lines"))
    return reconcile(fence, held, ["last_dt"])
