from datetime import date, timedelta

from shop import AS_OF, DURING, SUNDAY, d, item, shop
from pyspark.sql import functions as F

from shelfweek.functions.dates import week_bounds
from shelfweek.operators import joins
from shelfweek.plans import base_inventory, chain_report, frontline_items, item_master, new_goods, online_new, refresh, weekly
from shelfweek.sources.tables import Sources


def cell(df, **keys):
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    found = df.collect()
    assert len(found) == 1, found
    return found[0]


def test_new_goods_measures_and_cull(spark):
    facts = new_goods.weekly_new_goods(shop(spark), AS_OF)
    r = cell(facts, loc_no="00001", section="FIC")
    assert (r.yr, r.wk, r.min_dt) == (2024, 2, SUNDAY.date())
    # two lines of one item from the warehouse; other origins, the next week and promotional items do not count
    assert (r.ship_its, r.ship_qty, r.ship_cost, r.ship_val) == (1, 7, d(21), d(70))
    assert (r.rcv_its, r.rcv_qty, r.rcv_cost, r.rcv_val) == (1, 4, d(16), d(40))
    # sale 2, return 1, unknown flag counts as sale; cost once per line
    assert (r.sold_its, r.sold_qty, r.sold_cost, r.sold_val, r.list_val) == (1, 2, d(4), d(19), d(10))
    # marked down: the return is negative, the unknown flag counts in the amount only
    assert (r.md_sold_qty, r.md_cost, r.md_sold_val, r.md_list_val) == (-1, d(-4), d(-1), d(-10))
    # removed are kinds 1, 2 and 7
    assert (r.rfi_qty, r.rfi_cost, r.rfi_list, r.in_sts_qty, r.out_sts_qty) == (10, d(20), d(100), 0, 3)
    # bestsellers and idle sections are culled, and so is the store that only received transfers
    assert {(x.loc_no, x.section) for x in facts.collect()} == {("00001", "FIC")}


def test_dense_rows_where_a_live_store_had_nothing(spark):
    headers = [(1, "00944", "00001", DURING), (2, "00944", "00002", DURING)]
    lines = [(1, item(1), 5, d(3)), (2, item(4), 1, d(3))]
    facts = new_goods.weekly_new_goods(shop(spark, shipment_header=headers, shipment_detail=lines), AS_OF)
    assert {(x.loc_no, x.section) for x in facts.collect()} == {
        ("00001", "FIC"), ("00001", "IDLE"), ("00002", "FIC"), ("00002", "IDLE")}
    assert cell(facts, loc_no="00001", section="IDLE").ship_qty == 0


def test_inbound_transfers_count_at_the_receiving_store(spark):
    src = shop(spark)
    cells = weekly.transfer_cells(weekly.transfer_lines(src, *week_bounds(AS_OF)), weekly.store_list(src.locations))
    r = cell(cells, loc_no="00002", item_code=item(1))
    assert (r.in_sts_qty, r.out_sts_qty, r.tsh_qty) == (103, 0, 0)
    balance = {x.loc_no: x.net_sts_qty for x in weekly.transfer_balance(cells, ["loc_no"]).collect()}
    assert balance == {"00001": -3, "00002": 103}


def test_transfers_in_and_out_are_equal_without_a_store_filter(spark):
    cells = weekly.transfer_cells(weekly.transfer_lines(shop(spark), *week_bounds(AS_OF)))
    sums = cells.agg(F.sum("in_sts_qty"), F.sum("out_sts_qty")).first()
    assert sums[0] == sums[1] == 103


def test_store_and_online_sales_of_an_item_do_not_multiply(spark):
    facts = frontline_items.weekly_frontline_items(shop(spark), AS_OF)
    r = cell(facts, item_code=item(2))
    # one web order sold and refunded in the same week beside one store sale
    assert (r.st_sold_qty, r.st_sold_val, r.md_st_sold_qty) == (3, d(45), 3)
    assert (r.onl_sold_qty, r.onl_sold_val, r.onl_sold_fee) == (1, d(0), d(3))
    assert (r.md_onl_sold_qty, r.md_onl_sold_fee, r.onl_rfnd_qty, r.onl_rfnd_val) == (1, d(3), 1, d(18))
    assert (r.src, r.prog, r.ean) == ("BS", "Rord", "978B")


def test_online_orders_by_fulfilment_store(spark):
    facts = online_new.weekly_online_new(shop(spark), AS_OF)
    market = facts.where("site = 'i'")
    moved, own = cell(market, loc_no="00002"), cell(market, loc_no="00001")
    assert (moved.sold_ords, moved.sold_its, moved.sold_qty, moved.sold_cost) == (1, 1, 1, d(4))
    # the other system's fulfilment does not count; the refund is an order of its own
    assert (own.sold_ords, own.sold_qty, own.rfnd_ords, own.rfnd_its, own.rfnd_amt) == (1, 2, 1, 1, d(5))
    assert own.vendor == "CDC-f" and own.secn == "FIC"


def test_item_master_rules(spark):
    src = shop(spark, item_master=[(item(1), item(1), "BS-i", "BS"), (item(5), item(5), "CDC", "CDC")])
    got = {r.item_code: (r.item, r.vendor, r.rord_grp) for r in item_master.refresh_item_master(src).collect()}
    assert got[item(1)] == (item(1), "CDC", "CDC")            # updated
    assert got[item(2)] == (item(2), "BS-r", "BS")            # added
    assert got[item(3)] == (item(1), "CDC", "CDC")            # listed under its report item
    assert item(5) not in got and item(6) not in got          # promotional and base inventory
    assert item(7) in got                                     # tote bags are never excluded


def test_refresh_stops_at_the_first_failure(spark, tmp_path):
    status = refresh.weekly_refresh(spark, shop(spark), str(tmp_path), AS_OF)
    assert list(status) == ["item_master", *[name for name, *_ in refresh.FACTS]]
    assert status["item_master"] == status["new_goods"] == "done"
    assert status["base_inventory"].startswith("failed")      # the shop has no buys
    assert {status[name] for name, *_ in refresh.FACTS[2:]} == {"skipped"}
    assert spark.read.parquet(str(tmp_path / "new_goods")).count() == 1


def test_program_labels_ignore_case(spark):
    df = spark.createDataFrame([("USED", "BI"), ("Used", "SIPS"), ("New", "BS"), ("New", "DIPS")], "u string, s string")
    assert [r[0] for r in df.select(chain_report.program(F.col("u"), F.col("s"))).collect()] == ["USED", "USED", "BS", "CDC"]


def spans_of(spark, rows):
    return spark.createDataFrame(rows, "loc_no string, first date, last date")


def test_dense_detail_equals_the_plain_grid(spark, rows):
    week = [date(2024, 1, 7) + timedelta(weeks=i) for i in range(4)]
    acts = spark.createDataFrame(
        [(week[0], "a", "1", 5), (week[2], "a", "1", None), (week[3], "a", "1", 9), (week[1], "b", "2", 7), (None, "a", "1", 4), (week[1], None, "1", 3)],
        "min_dt date, section string, loc_no string, qty bigint")
    spans = spans_of(spark, [("1", week[0], week[2]), ("2", week[1], week[1]), (None, week[0], week[0])])
    sections = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "section string")
    weeks = spans.select("loc_no", F.explode(F.sequence("first", "last", F.expr("interval 7 days"))).alias("min_dt"))
    keys = ["min_dt", "section", "loc_no"]
    want = weeks.crossJoin(sections).join(acts, keys, "left").fillna(0, subset=["qty"])
    got = weekly.location_detail(acts, spans, [sections], keys, ["qty"])
    assert rows(got, *keys, "qty") == rows(want, *keys, "qty") and got.count() == 20


def test_dense_detail_of_more_items_than_a_small_side_may_have(spark):
    acts = spark.createDataFrame([(SUNDAY.date(), "7", "00001", 2)], "min_dt date, item_code string, loc_no string, qty bigint")
    items = spark.range(joins.GRID_ROWS + 1).select(F.col("id").cast("string").alias("item_code"))
    detail = weekly.location_detail(acts, spans_of(spark, [("00001", SUNDAY.date(), SUNDAY.date())]), [items], ["min_dt", "item_code", "loc_no"], ["qty"])
    assert detail.agg(F.count("*"), F.sum("qty")).first()[:] == (joins.GRID_ROWS + 1, 2)


def test_buys_of_a_type_with_many_items_are_spread_over_tasks(spark):
    src = Sources(buys=spark.createDataFrame(
        [("00001", "HBF ", "A", 2, d(4), d(9), DURING), ("00001", "HBF", "A", 3, d(5), d(9), DURING), ("00001", "X", "V", 1, d(1), d(1), DURING)],
        "location_no string, buy_type string, status string, quantity int, line_offer decimal(19,4), total_offer decimal(19,4), end_date timestamp"))
    items = spark.range(400).select(F.col("id").cast("string").alias("item_code"), F.lit("HBF").alias("product_type"), F.lit(True).alias("takes_buys"))
    bought = base_inventory.weekly_buys(src, items, *week_bounds(AS_OF))
    assert bought.agg(F.count("*"), F.min("buy_qty"), F.max("buy_cost")).first()[:] == (400, 5, d(9))
    assert bought.select(F.spark_partition_id()).distinct().count() > 1


def test_item_facts_are_not_shuffled_to_drop_silent_items(spark, capsys):
    """silent stores and items are few and their lists are stored, so the wide facts stay where they are."""
    facts = frontline_items.weekly_frontline_items(shop(spark), AS_OF)
    facts.explain("simple")
    assert "hashpartitioning" not in capsys.readouterr().out
    columns = ", ".join(["min_dt date", "loc_no string", "item_code string", "v int"])
    acts = spark.createDataFrame([(None, "a", "x", 1), (None, "a", "y", 0), (None, "b", "z", None), (None, None, "z", 1)], columns)
    for column in ("loc_no", "item_code"):
        active, silent = ({r[0] for r in f(acts, column, F.col("v")).collect()} for f in (weekly.active_only, weekly.silent_only))
        assert not active & silent and (active | silent) - {None} == {r[0] for r in acts.select(column).collect()} - {None}


def test_transfers_are_shuffled_once_and_summed_by_kind(spark, capsys):
    """lines and cells share one shuffle of narrow rows; a cell with several moves is summed by kind."""
    when = F.lit(DURING).cast("date")
    schema = "min_dt date, location_no string, to_location_no string, transfer_type int, item_code string, qty bigint, cost decimal(38,4)"
    moves = [("1", "2", 3, "x", 5, d(1)), ("1", "3", 3, "x", 2, d(2)), ("1", "2", 6, "x", 7, d(3)), ("3", "2", 3, "x", 1, d(4)), ("2", "1", 1, None, 4, None)]
    lines = spark.createDataFrame([(DURING.date(), *m) for m in moves], schema).withColumn("min_dt", when)
    found = {(r.loc_no, r.item_code): r for r in weekly.transfer_cells(lines).collect()}
    first, second, third = found["1", "x"], found["2", "x"], found["3", "x"]
    assert (first.out_sts_qty, first.out_sts_cost, first.rtn_qty, first.rtn_cost, first.in_sts_qty) == (7, d(3), 7, d(3), 0)
    assert (second.in_sts_qty, second.in_sts_cost, second.out_sts_qty) == (6, d(5), 0)
    assert (third.in_sts_qty, third.out_sts_qty, third.out_sts_cost) == (2, 1, d(4))
    assert (found["2", None].tsh_qty, found["2", None].tsh_cost) == (4, 0)
    weekly.transfer_cells(weekly.transfer_lines(shop(spark), *week_bounds(AS_OF))).explain("simple")
    exchanges = [row for row in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in row and "item_code" in row.split("hashpartitioning")[1].split(")")[0]]
    assert len(exchanges) == 1


def test_the_buys_of_a_type_are_not_stored_once_an_item(spark, monkeypatch):
    """items of a type share its buys until their weeks are laid out; an item of several types takes the buys of all."""
    goods = [(item(n), "", "FIC", kind, "V", "P", "", "N", "N", "", "", "", d(5), d(2))
             for n, kind in [*((k, "BOOK ") for k in range(100, 400)), (400, "BOOK"), (400, "TOY"), (401, "NONE"), (5766, "BOOK")]]
    src = shop(spark, products=goods, base_inventory=[(item(n),) for n in (*range(100, 402), 5766)])
    week = timedelta(weeks=1)
    src["buys"] = spark.createDataFrame(
        [("00001", "BOOK", "A", 2, d(4), d(9), DURING), ("00001", "BOOK ", "A", 3, d(5), d(9), DURING - 2 * week), ("00002", "TOY", "A", 7, d(1), d(9), DURING),
         ("00001", "TOY", "A", 1, d(2), d(9), DURING), ("00002", "OTHER", "A", 9, d(1), d(9), DURING - week), ("00001", "BOOK", "V", 9, d(1), d(1), DURING)],
        "location_no string, buy_type string, status string, quantity int, line_offer decimal(19,4), total_offer decimal(19,4), end_date timestamp")
    src["sales_line"] = src.sales_line.limit(0).unionByName(spark.createDataFrame(
        [("1", item(100), 1, "S", "n", "A", 2, d(10), d(10), d(20), (DURING - week).date())], src.sales_line.schema))
    kept = []
    monkeypatch.setattr(base_inventory, "staged", lambda df, label: kept.append((label, df.localCheckpoint())) or kept[-1][1])
    facts = base_inventory.weekly_base_inventory(src, AS_OF, 3)
    assert [r.item_code for r in dict(kept)["base-inventory"].collect()] == [item(100)]  # the one row of its own
    found = {}
    for r in facts.collect():
        found.setdefault((r.item_code, r.loc_no, (SUNDAY.date() - r.min_dt).days // 7), []).append((r.buy_qty, r.buy_cost, r.sold_qty))
    for n in range(100, 400):
        assert [found[item(n), "00001", w] for w in (2, 1, 0)] == [[(3, d(5), 0)], [(0, 0, 2 if n == 100 else 0)], [(2, d(4), 0)]]
    assert found[item(400), "00001", 0] == [(3, d(6), 0)] * 2 and found[item(400), "00001", 2] == [(3, d(5), 0)] * 2
    assert found[item(400), "00002", 0] == [(7, d(1), 0)] * 2 and (item(400), "00002", 1) not in found
    assert found[item(401), "00001", 0] == found[item(5766), "00001", 0] == [(0, 0, 0)]


def test_folds_meet_their_products_where_their_cells_are_made(spark, capsys):
    """lines are shuffled to item and slice of weeks once; the cells, their products and all folds of an item meet there."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables are that are too large for it
    try:
        acts = frontline_items.frontline_item_activity(shop(spark), *week_bounds(AS_OF))
        acts.explain("simple")
        assert {(r.item_code, r.ship_qty, r.st_sold_qty, r.onl_sold_qty, r.rfi_qty) for r in acts.collect()} == {
            (item(1), 7, 2, 0, 10), (item(1), 0, 0, 0, 0), (item(2), 0, 3, 1, 0)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = [line.split("hashpartitioning(")[1].split(")")[0] for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in line]
    by_week = [keys for keys in found if "min_dt" in keys]
    assert len(by_week) == 1 and "item_price" in by_week[0]  # web lines by price paid; no cell is shuffled by its week


def test_money_is_summed_exactly_in_its_smallest_unit(spark):
    """sums of whole units equal sums of decimals, whatever the width of the columns; keys without activity go."""
    fold = spark.createDataFrame(
        [("a", 1, d("0.0001"), d("3")), ("a", None, d("-922337203685477.5807"), None), ("a", 2, d("922337203685477.5807"), d("4.5")),
         ("b", 3, None, d("-0.125")), ("c", 0, d("7"), d("1")), (None, 1, d("99999999999.9999"), d("1"))],
        "k string, n int, m decimal(38,4), w decimal(38,10)")
    more = spark.createDataFrame([("b", d("2.5"))], "k string, v decimal(19,4)")
    measures = {"n": "bigint", "m": "decimal(19,4)", "v": "decimal(19,4)", "w": "decimal(19,4)"}
    got = weekly.activity(["k"], measures, fold, more, counts_on=["n"])
    assert {r.k: r[1:] for r in got.collect()} == {
        "a": (3, d("0.0001"), 0, d("7.5")), "b": (3, 0, d("2.5"), d("-0.125")), None: (1, d("99999999999.9999"), 0, d(1))}
    assert [f.dataType.simpleString() for f in got.schema][1:] == [*measures.values()]
