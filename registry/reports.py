"""Reports on stored facts, and warehouse shipments by work program."""

from __future__ import annotations

import uuid
from datetime import date

from registry.base import query
from registry.oracle_tables import M, sunday, wk, yr
from registry.standins import facts
from shelfweek.functions.measures import MONEY
from shelfweek.plans import chain_report, program_rollup, report_files, report_jobs, title_report
from shelfweek.sources import tables

SINCE = 1996
REPORT = chain_report.MEASURES
STORE = chain_report.STORE_MEASURES
ONLINE = chain_report.ONLINE_MEASURES


def kinds(measures) -> str:
    return " ".join(f"{name}:{'d' if kind == MONEY else 'i'}" for name, kind in measures.items())


def fact_part(name: str, source: str, join: str, cap: str, secn: str) -> str:
    used_new, src, origin = chain_report.LAYOUT[name]
    cells = ", ".join(f"{origin[m]} AS {m}" if m in origin else f"0 AS {m}" for m in STORE if m != "moved_qty")
    return (f"SELECT yr, wk, min_dt, '{used_new}' AS used_new, '{src}' AS src, loc_no, {cap} AS cap, {secn} AS secn, {cells}, "
            f"abs(in_sts_qty) + abs(out_sts_qty) AS moved_qty FROM {source} {join} WHERE yr >= {SINCE}")


def homed(online: str, by: str) -> str:
    """Online rows under the cap of the store rows of their label: their own if it is there, else the first."""
    if "cap" not in by:
        return online
    return f"""SELECT o.* REPLACE (CASE WHEN caps IS NULL OR list_contains(caps, coalesce(o.cap, '~')) THEN o.cap ELSE nullif(list_min(caps), '~') END AS cap)
        FROM ({online}) o LEFT JOIN (SELECT used_new, src, yr, wk, min_dt, secn, list(coalesce(cap, '~')) AS caps FROM r_store GROUP BY ALL) s
        ON s.used_new = o.used_new AND s.src = o.src AND s.yr = o.yr AND s.wk = o.wk AND s.min_dt IS NOT DISTINCT FROM o.min_dt
        AND s.secn IS NOT DISTINCT FROM o.secn"""


def report_tables(by: str, stores: str = "") -> dict[str, str]:
    """Stacked store facts, dated online facts and their merge at the grain ``by``."""
    counted = stores and ", count(DISTINCT loc_no) AS stores"
    sums = ", ".join(f"trunc(sum({m}) / 2.0)" + f" AS {m}" if m == "moved_qty" else f"sum({m}) AS {m}" for m in STORE)
    value = "sold_val + sold_fee - rfnd_amt"
    filled = ", ".join(f"coalesce({m}, 0) AS {m}" if m not in ("sold_qty", "sold_cost", "sold_val") else
                       f"coalesce({m}, 0) + coalesce(onl_{m}, 0) AS {m}" for m in REPORT)
    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in ("used_new", "src", "yr", "wk", "min_dt", *by.split(", ")))
    keys = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in ("used_new", "src", "yr", "wk", "min_dt", *by.split(", ")))
    onlined = ", ".join(f"sum({m}) AS {m}" for m in ("onl_sold_qty", "onl_sold_cost", "onl_sold_val", "onl_sold_fee", "rfnd_ords", "rfnd_amt", "web_sold_qty", "web_sold_val"))
    return {
        "all_facts": " UNION ALL ".join([
            fact_part("base_inventory", "fact_base_inventory", "", "''", "product_type"),
            fact_part("serial_items", "fact_serial_items", "JOIN sections ON section = subj", "cap", "secn"),
            fact_part("new_goods", "fact_new_goods", "JOIN sections USING (section)", "cap", "secn"),
            fact_part("frontline", "(SELECT * EXCLUDE (src) FROM fact_frontline WHERE src = 'BS')", "JOIN sections USING (section)", "cap", "secn"),
        ]),
        "r_store": f"SELECT used_new, src, yr, wk, min_dt, {by}, {sums}{counted} FROM all_facts GROUP BY used_new, src, yr, wk, min_dt, {by}",
        "r_weeks": "SELECT yr, wk, min(min_dt) AS min_dt FROM r_store GROUP BY ALL",
        "r_online": f"""SELECT used_new, src, o.yr, o.wk, w.min_dt, {by}, sum(sold_qty) AS onl_sold_qty, sum(sold_cost) AS onl_sold_cost,
            sum({value}) AS onl_sold_val, sum(sold_fee) AS onl_sold_fee, sum(rfnd_ords) AS rfnd_ords, sum(rfnd_amt) AS rfnd_amt,
            sum(CASE WHEN site = 'h' THEN sold_qty ELSE 0 END) AS web_sold_qty, sum(CASE WHEN site = 'h' THEN {value} ELSE 0 END) AS web_sold_val
            {counted} FROM (SELECT * EXCLUDE (min_dt) FROM fact_online) o LEFT JOIN r_weeks w ON w.yr = o.yr AND w.wk = o.wk
            GROUP BY used_new, src, o.yr, o.wk, w.min_dt, {by}""",
        "r_homed": f"SELECT used_new, src, yr, wk, min_dt, {by}, {onlined}{stores and ', max(stores) AS stores'} FROM ({homed('SELECT * FROM r_online', by)}) GROUP BY ALL",
        "merged": f"""SELECT *, CASE WHEN wk > 26 THEN yr ELSE yr - 1 END AS fy, CASE WHEN wk > 26 THEN wk - 26 ELSE wk + 26 END AS fw,
            lpad(CAST(CASE WHEN wk > 26 THEN wk - 26 ELSE wk + 26 END AS VARCHAR), 2, '0') || '-' || lpad(CAST(wk AS VARCHAR), 2, '0') AS fw_wk,
            CASE WHEN used_new = 'Used' THEN 'USED' WHEN src = 'BS' THEN 'BS' ELSE 'CDC' END AS program
            FROM (SELECT {keys}, {filled}{stores and ', coalesce(a.stores, b.stores) AS stores'} FROM r_store a FULL JOIN r_homed b ON {match})
            WHERE abs(ship_qty) + abs(rcv_qty) + abs(sold_qty) + abs(rfi_qty) + abs(moved_qty) + abs(rtn_qty) > 0""",
        "latest": "SELECT max(min_dt) AS last_dt FROM merged",
        "indexed": """SELECT m.*, CASE WHEN age < 4 OR age BETWEEN 52 AND 55 THEN 4 - age % 52 ELSE 0 END AS cur_4_wks
            FROM (SELECT *, CAST(date_diff('day', min_dt, last_dt) // 7 AS INTEGER) AS age FROM merged JOIN latest ON true) m""",
    }


CHAIN = report_tables("cap, secn", "stores")
BY_STORE = report_tables("loc_no")
NAMED = "used_new:s src:s yr:i wk:i min_dt:s fy:i fw:i fw_wk:s "
SUMMED = {m: k for m, k in REPORT.items() if not m.startswith("bsm_")}


@query(
    NAMED + "program:s " + kinds(SUMMED),
    "SELECT used_new, src, yr, wk, min_dt, fy, fw, fw_wk, program, " + ", ".join(f"sum({m}) AS {m}" for m in SUMMED)
    + " FROM merged GROUP BY ALL", **CHAIN,
)
def chain_by_source(s):
    return chain_report.chain_report(facts(s), SINCE)[0]


@query(
    NAMED + "program:s cap:s secn:s stores:i cur_4_wks:i " + kinds(REPORT), "SELECT * FROM indexed", **CHAIN,
)
def chain_by_section(s):
    return chain_report.chain_report(facts(s), SINCE)[1]


@query(
    NAMED + "loc_no:s region_name:s district_name:s media_market:s reopen_wk:i reopen_dt:s cur_4_wks:i " + kinds(REPORT),
    """SELECT i.*, r_name AS region_name, r_name AS district_name, n_name AS media_market, w AS reopen_wk, reopen_dt
        FROM indexed i JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 5, '0') = loc_no JOIN region ON r_regionkey = n_regionkey
        JOIN (VALUES ('AFRICA', 20), ('AMERICA', 19), ('ASIA', 23), ('EUROPE', 21)) d(name, w) ON name = r_name
        JOIN (SELECT wk AS k, min(min_dt) AS reopen_dt FROM merged WHERE yr = 1999 GROUP BY 1) ON k = w
        WHERE yr >= 1998 AND loc_no NOT IN ('00011', '00020')""",
    **BY_STORE,
)
def store_report(s):
    """The report per store, with the test regions as districts."""
    weeks = {"AFRICA": 20, "AMERICA": 19, "ASIA": 23, "EUROPE": 21}
    return chain_report.store_report(facts(s), SINCE, 1998, 1999, weeks)


@query(
    "min_dt:s cur_4_wks:i",
    f"""SELECT min_dt, 4 - age % 52 AS cur_4_wks FROM (SELECT min_dt, CAST(date_diff('day', min_dt, max(min_dt) OVER ()) // 7 AS INTEGER) AS age
        FROM (SELECT DISTINCT {sunday('l_shipdate')} AS min_dt FROM lineitem)) WHERE age < 4 OR age BETWEEN 52 AND 55""",
)
def current_four_weeks(s):
    return chain_report.current_weeks(s.fact_lines.select("min_dt"))


@query(
    "loc_no:s district_name:s reopen_wk:i reopen_dt:s",
    """SELECT loc_no, r_name AS district_name, w AS reopen_wk, reopen_dt FROM (SELECT DISTINCT loc_no FROM fact_lines)
        JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 5, '0') = loc_no JOIN region ON r_regionkey = n_regionkey
        JOIN (VALUES ('AFRICA', 20), ('AMERICA', 19), ('ASIA', 23), ('EUROPE', 21), ('MIDDLE EAST', 18)) d(name, w) ON name = r_name
        JOIN (SELECT wk, min(min_dt) AS reopen_dt FROM fact_new_goods WHERE yr = 1997 GROUP BY 1) ON wk = w WHERE loc_no NOT IN ('00011', '00020')""",
)
def reopen_week_lookup(s):
    weeks = {"AFRICA": 20, "AMERICA": 19, "ASIA": 23, "EUROPE": 21, "MIDDLE EAST": 18}
    stores = chain_report.reopen_weeks(s.store_dim, s.fact_new_goods, 1997, weeks)
    return stores.join(s.fact_lines.select("loc_no").distinct(), "loc_no", "left_semi")


@query(
    "secn:s yr:i wk:i min_dt:s fy:i fw_wk:s rcv_qty:i sold_qty:i md_sold_qty:i rfi_qty:i rcv_cost:d sold_cost:d sold_val:d "
    "md_sold_val:d rfi_cost:d",
    "SELECT secn, yr, wk, min_dt, fy, fw_wk, " + ", ".join(
        f"sum({m}) AS {m}" for m in ("rcv_qty", "sold_qty", "md_sold_qty", "rfi_qty", "rcv_cost", "sold_cost", "sold_val", "md_sold_val",
                                     "rfi_cost")) + " FROM merged GROUP BY ALL", **CHAIN,
)
def section_rollup(s):
    """Goods of all sources by section and week."""
    return chain_report.section_rollup(chain_report.merged_report(facts(s), ["cap", "secn"], SINCE, False))


@query(
    "yr:i wk:i used_new:s src:s secn:s onl_sold_qty:i",
    "SELECT yr, wk, used_new, src, secn, onl_sold_qty FROM r_online WHERE min_dt IS NULL", **CHAIN,
)
def undated_online(s):
    """Online rows from before the report's first year find no week of the store facts."""
    return chain_report.undated_online(facts(s), SINCE)


# --- titles ---------------------------------------------------------------------------------------

TITLES = {"weeks": """SELECT loc_no, min_dt, yr, wk, ean, max(title) AS title, sum(st_sold_qty) AS cur_sold_qty, sum(md_st_sold_qty) AS cur_md_qty,
    sum(st_rfnd_qty) AS cur_rtn_qty FROM fact_items WHERE src = 'BS' GROUP BY ALL"""}


@query(
    "loc_no:s min_dt:s yr:i wk:i ean:s title:s cur_sold_qty:i cur_md_qty:i cur_rtn_qty:i tot_sold_qty:i tot_md_qty:i tot_rtn_qty:i "
    "last_sold_wk:s",
    """SELECT * FROM (SELECT *, sum(cur_sold_qty) OVER w AS tot_sold_qty, sum(cur_md_qty) OVER w AS tot_md_qty, sum(cur_rtn_qty) OVER w AS tot_rtn_qty,
        max(CASE WHEN cur_sold_qty + cur_rtn_qty > 0 THEN min_dt END) OVER w AS last_sold_wk FROM weeks
        WINDOW w AS (PARTITION BY loc_no, ean ORDER BY min_dt ROWS UNBOUNDED PRECEDING))
        WHERE min_dt >= DATE '1998-05-03' AND cur_sold_qty + cur_rtn_qty > 0""", **TITLES,
)
def title_running_totals(s):
    return title_report.title_running_totals(s.fact_items, s.products, date(1998, 5, 3))


@query(
    "loc_no:s ean:s title:s cur_sold_qty:i cur_md_qty:i tot_sold_qty:i tot_md_qty:i last_sold_wk:s",
    """SELECT loc_no, ean, title, sum(CASE WHEN min_dt = DATE '2000-10-01' THEN st_sold_qty ELSE 0 END) AS cur_sold_qty,
        sum(CASE WHEN min_dt = DATE '2000-10-01' THEN md_st_sold_qty ELSE 0 END) AS cur_md_qty, sum(st_sold_qty) AS tot_sold_qty,
        sum(md_st_sold_qty) AS tot_md_qty, max(CASE WHEN st_sold_qty + st_rfnd_qty > 0 THEN min_dt END) AS last_sold_wk
        FROM fact_items WHERE src = 'BS' AND min_dt <= DATE '2000-10-01' GROUP BY ALL HAVING sum(st_sold_qty) > 0""",
)
def title_week_vs_total(s):
    return title_report.title_week_vs_total(s.fact_items, s.products, date(2000, 10, 1))


@query("ean:s items:i", "SELECT ean, count(DISTINCT item_code) AS items FROM fact_items GROUP BY 1")
def items_per_ean(s):
    return title_report.items_per_ean(s.fact_items)


LY = ("titles", "items", "ship_qty", "rcv_qty", "sold_qty", "md_qty", "rtn_qty")


@query(
    "loc_no:s min_dt:s yr:i wk:i " + " ".join(f"{n}:i ly_{n}:i" for n in LY),
    "SELECT c.*, " + ", ".join(f"coalesce(p.v.{n}, 0) AS ly_{n}" for n in LY)
    + """ FROM totals c LEFT JOIN (SELECT loc_no, yr, wk, arg_min(t, min_dt) AS v FROM (SELECT t, t.loc_no, t.yr, t.wk, t.min_dt FROM totals t)
            GROUP BY ALL) p ON p.loc_no = c.loc_no AND p.yr = c.yr - 1 AND p.wk = c.wk WHERE c.min_dt >= DATE '1997-06-01'""",
    totals="""SELECT loc_no, min_dt, yr, wk, count(ean) AS titles, sum(items) AS items, sum(ship_qty) AS ship_qty, sum(rcv_qty) AS rcv_qty,
        sum(sold_qty) AS sold_qty, sum(md_qty) AS md_qty, sum(rtn_qty) AS rtn_qty FROM (
        SELECT loc_no, min_dt, yr, wk, ean, count(DISTINCT item_code) AS items, sum(ship_qty) AS ship_qty, sum(rcv_qty) AS rcv_qty,
            sum(st_sold_qty) AS sold_qty, sum(md_st_sold_qty) AS md_qty, sum(st_rfnd_qty) AS rtn_qty FROM fact_items GROUP BY ALL) GROUP BY ALL""",
)
def store_weeks_vs_ly(s):
    return title_report.store_weeks_vs_ly(s.fact_items, date(1997, 6, 1))


# --- report files and tables ----------------------------------------------------------------------

def report_path(spark) -> str:
    return f"{tables.shared_folder(spark)}/shelfweek-reports/{uuid.uuid4().hex}"


def placed(report: str) -> str:
    """The place of a row in the order of a report; both engines put nulls first in ascending and last in descending order."""
    order = ", ".join(f"{n[1:]} DESC NULLS LAST" if n.startswith("-") else f"{n} NULLS FIRST" for n in report_files.ORDERS[report])
    return f"row_number() OVER (ORDER BY {order}) AS line_no"


def read_back(s, path: str, schemas: dict, report: str):
    return report_files.read_report(s.part.sparkSession, f"{path}/{report}", schemas[report])


@query(
    "line_no:i " + NAMED + "program:s sold_qty:i sold_val:d",
    f"SELECT *, {placed('chain_by_source')} FROM (SELECT used_new, src, yr, wk, min_dt, fy, fw, fw_wk, program, sum(sold_qty) AS sold_qty, "
    "sum(sold_val) AS sold_val FROM merged GROUP BY ALL)", **CHAIN,
)
def chain_report_file(s):
    """The report by source as a file, read back line by line."""
    path = report_path(s.part.sparkSession)
    return read_back(s, path, report_jobs.write_chain_reports(facts(s), path, SINCE), "chain_by_source")


@query(
    "line_no:i loc_no:s min_dt:s cur_sold_qty:i title:s",
    f"""SELECT *, {placed('titles')} FROM weeks WHERE min_dt >= DATE '1998-05-03' AND cur_sold_qty + cur_rtn_qty > 0""", **TITLES,
)
def title_report_file(s):
    """The title report as a file; the columns shown are those of its order, so titles that tie look alike."""
    path = report_path(s.part.sparkSession)
    return read_back(s, path, report_jobs.write_title_report(s.fact_items, s.products, path, date(1998, 5, 3)), "titles")


@query(
    NAMED + "cap:s secn:s sold_qty:i sold_val:d cur_4_wks:i",
    "SELECT used_new, src, yr, wk, min_dt, fy, fw, fw_wk, cap, secn, sold_qty, sold_val, cur_4_wks FROM indexed", **CHAIN,
)
def section_report_table(s):
    """The report by section as a table: rebuilt, then refilled with the columns its readers name."""
    rows = chain_report.chain_report(facts(s), SINCE)[1]
    spark = rows.sparkSession
    path = report_path(spark)
    tables.rebuild(rows, path)
    tables.reload(spark.read.parquet(path), path, [*chain_report.TIME, "used_new", "src", "fy", "fw", "fw_wk", "cap", "secn", "sold_qty", "sold_val", "cur_4_wks"])
    return spark.read.parquet(path)


# --- work programs --------------------------------------------------------------------------------

PROGRAMS = {
    "program_lines": f"""SELECT l.*, p_type, p_size, CASE WHEN p_type = 'PROMO' THEN 'Puzzles' ELSE p_brand END AS category,
        CASE WHEN p_size > 45 THEN 'NBAF' ELSE CASE p_type WHEN 'ECONOMY' THEN 'HBF' WHEN 'LARGE' THEN 'TRF' WHEN 'MEDIUM' THEN 'NBAF'
             WHEN 'PROMO' THEN 'PRMO' WHEN 'SMALL' THEN 'CALF' ELSE 'BDGF' END END AS kind,
        CASE WHEN p_type = 'PROMO' OR p_brand = 'Brand#24' THEN NULL WHEN p_brand < 'Brand#2' THEN 'A' WHEN p_brand = 'Brand#25' THEN 'SNL' ELSE 'B' END AS cap0,
        CAST(p_size AS {M}) AS cost FROM wh_lines l JOIN part ON p_partkey = l_partkey""",
    "program_rows": """SELECT *, coalesce(cap0, 'NON') AS cap, CASE WHEN cap0 IN ('A', 'B', 'SNL') THEN category ELSE 'NON' END AS goal_grp,
        CASE WHEN order_type = 'HPB Titles' AND customer = 'HPB' AND NOT (category = 'Puzzles' OR kind IN ('PRMO', 'HBF', 'TRF') OR coalesce(cap0, '') = 'SNL')
                THEN 'Push'
             WHEN order_type = 'HPB Titles' AND customer = 'HPB' THEN 'Snl&MiscPush'
             WHEN order_type = 'TTB Initial' AND company = 'TTB' AND customer = 'HPB' THEN 'Init&Shorts'
             WHEN order_type IN ('TTB WHOLESALE', 'WEBORDER', 'TTB Reorders') THEN CASE customer WHEN 'HPB' THEN 'Pull-TTB' ELSE 'Whsl-Rtl' END
             WHEN order_type = 'HPB REORDERS' AND company = 'HPB' AND customer = 'HPB' THEN 'Pull-HPB'
             WHEN (order_type = 'SUPPLIES' OR company = 'SUP') AND customer = 'HPB' THEN 'Supplies'
             ELSE order_type || kind END AS program FROM program_lines""",
}
HISTORY = (date(1995, 1, 1), date(2001, 11, 11))


@query(
    "yr:i wk:i program:s ship_qty:i",
    f"""SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, program, sum(q) AS ship_qty FROM program_rows GROUP BY ALL""", **PROGRAMS,
)
def work_program_rollup(s):
    return program_rollup.program_rollup(s, HISTORY[1], 400)


@query(
    "min_dt:s yr:i wk:i cap:s goal_grp:s program:s ship_qty:i ship_cost:d",
    f"""SELECT min_dt, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, cap, goal_grp, program, sum(q) AS ship_qty, sum(q * cost) AS ship_cost
        FROM program_rows GROUP BY ALL""", **PROGRAMS,
)
def work_program_detail(s):
    return program_rollup.program_detail(s, HISTORY[1], 400)


@query(
    "line_no:i yr:i wk:i program:s ship_qty:i",
    f"""SELECT *, {placed('program_rollup')} FROM (SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, program, sum(q) AS ship_qty
        FROM program_rows GROUP BY ALL)""", **PROGRAMS,
)
def program_rollup_file(s):
    """The program rollup as a file, read back line by line."""
    path = report_path(s.part.sparkSession)
    return read_back(s, path, report_jobs.write_program_reports(s, path, HISTORY[1], 400), "program_rollup")


@query(
    "line_no:i yr:i wk:i cap:s goal_grp:s",
    f"""SELECT *, {placed('program_detail')} FROM (SELECT {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, cap, goal_grp FROM program_rows
        GROUP BY min_dt, yr, wk, cap, goal_grp, program)""", **PROGRAMS,
)
def program_detail_file(s):
    """The program detail as a file, the latest week first; the columns shown are those of its order."""
    path = report_path(s.part.sparkSession)
    return read_back(s, path, report_jobs.write_program_reports(s, path, HISTORY[1], 400), "program_detail")


@query(
    "min_dt:s yr:i wk:i program:s customer:s ship_to:s shipments:i items:i ship_qty:i ship_cost:d",
    f"""SELECT min_dt, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, program, head_customer AS customer, ship_to, count(DISTINCT o_orderkey) AS shipments,
        count(DISTINCT item) AS items, sum(q) AS ship_qty, sum(q * cost) AS ship_cost FROM program_rows WHERE head_customer <> 'HPB' GROUP BY ALL""",
    **PROGRAMS,
)
def wholesale_by_customer(s):
    return program_rollup.wholesale_by_customer(s, *HISTORY)


@query(
    "min_dt:s yr:i wk:i cap:s goal_grp:s customers:i ship_qty:i goal_wk:i",
    f"""SELECT *, CASE WHEN cap IN ('NON', 'SNL') OR cap = CASE WHEN wk % 2 = 1 THEN 'A' ELSE 'B' END THEN wk WHEN wk = 1 THEN 52 ELSE wk - 1 END AS goal_wk
        FROM (SELECT min_dt, {yr('min_dt')} AS yr, {wk('min_dt')} AS wk, cap, goal_grp, count(DISTINCT customer) AS customers, sum(q) AS ship_qty
        FROM program_rows WHERE order_type = 'HPB Titles' AND company = 'HPB' AND category <> 'Puzzles' AND kind NOT IN ('PRMO', 'HBF', 'TRF')
        GROUP BY ALL)""", **PROGRAMS,
)
def goal_week_base(s):
    return program_rollup.goal_base(s, *HISTORY)
