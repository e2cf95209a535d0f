"""Weekly folds: lines to week x store x item measures, their union into one activity frame, the dense detail.

Every fold reduces its lines to one row per week, store and item before it meets the product table. The sums
combine before the shuffle, and an item or store with a large share of the lines arrives at the product join
as at most one row per week and store. Each fold row counts one item, so item counts add up without a
distinct count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek import fixed_values as fv
from shelfweek.functions.dates import with_week, with_year_week, within
from shelfweek.functions.measures import (
    MONEY, any_nonzero, is_return, marked_down, money, net, net_marked_down, plausible_cost, total, total_if, zero,
)
from shelfweek.functions.text import list_test
from shelfweek.operators.joins import dense_spine, look_up, present
from shelfweek.sources.tables import Sources, staged

CELL = ["min_dt", "loc_no", "item_code"]
# A fold deals its cells by item and slice of weeks, in which they meet their product: an item with a large share of the
# lines is spread over so many tasks, and each product is copied as often. All folds of an item may meet in one task, which
# therefore gets a quarter of what a task of another shuffle gets.
SLICE, SLICES, FINER = "_slice", 4, 4
UNITS = 10_000  # of the smallest unit of money in one


# --- dimensions -----------------------------------------------------------------------------------

def store_list(locations: DataFrame, skipped: Iterable[str] = ()) -> DataFrame:
    stores = locations.where(F.col("location_no").between(*fv.STORE_RANGE))
    return stores.where(~F.col("location_no").isin(*skipped)).select(F.col("location_no").alias("loc_no")).distinct()


def excluded_flag(
    products: DataFrame, base_inventory: DataFrame, item_codes: Iterable[str], types: Iterable[str],
    extra: Column | None = None,
) -> DataFrame:
    """Products with ``excluded``: listed items, base inventory or listed types, tote bags apart."""
    base = base_inventory.select("item_code", F.lit(True).alias("in_base")).distinct()
    flagged = products.join(base, "item_code", "left")
    test = F.col("item_code").isin(*item_codes) | F.col("in_base") | list_test(F.trim("product_type"), types)
    if extra is not None:
        test = zero_false(test) | zero_false(extra)
    totes = (F.trim("purchase_from_vendor_id") != fv.TOTE_VENDOR) & (F.trim("vendor_id") != fv.TOTE_VENDOR)
    return flagged.withColumn("excluded", zero_false(zero_false(test) & totes)).drop("in_base")


def zero_false(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def new_goods_products(src: Sources) -> DataFrame:
    codes = fv.USED_ITEMS_OUTSIDE_BASE + fv.SUPPLY_ITEMS
    flagged = excluded_flag(src.products, src.base_inventory, codes, fv.NEW_GOODS_SKIPPED_TYPES)
    return with_section(flagged.where(~F.col("excluded")))


def with_section(products: DataFrame) -> DataFrame:
    return products.withColumn("section", F.trim("section_code"))


def source_program(products: DataFrame) -> DataFrame:
    """Bestseller or other frontline source, and initial or reorder program by vendor."""
    return products.withColumns(
        {
            "src": F.when(list_test(F.col("product_type"), fv.BESTSELLER_TYPES), "BS").otherwise("Frln"),
            "prog": F.when(list_test(F.col("vendor_id"), fv.REORDER_DISTRIBUTORS), "Rord").otherwise("Init"),
        }
    )


def frontline_products(src: Sources) -> DataFrame:
    codes = fv.USED_ITEMS_OUTSIDE_BASE + fv.SUPPLY_ITEMS
    flagged = excluded_flag(src.products, src.base_inventory, codes, fv.FRONTLINE_SKIPPED_TYPES)
    kept = flagged.where(~F.col("excluded") & list_test(F.col("product_type"), fv.FRONTLINE_TYPES))
    return source_program(with_section(kept))


# --- folds ----------------------------------------------------------------------------------------

def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt by item and slice of their week, as ``at_goods`` needs them."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn(SLICE, F.pmod(F.xxhash64("min_dt"), F.lit(SLICES)).cast("int")).repartition(FINER * width, "item_code", SLICE)


def _cells(lines: DataFrame, *sums: Column) -> DataFrame:
    """Lines summed per week, store and item where they meet their product, so that they are shuffled once."""
    return dealt(lines).groupBy(*CELL, SLICE).agg(*sums)


def at_goods(cells: DataFrame, goods: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Dealt cells beside the columns of their product."""
    names = [name for name in dict.fromkeys(["item_code", *columns]) if name != SLICE]
    copies = goods.select(*names, F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias(SLICE))
    return cells.join(copies, ["item_code", SLICE])


def _valued(cells: DataFrame, goods: DataFrame, categories: list[str]) -> DataFrame:
    return at_goods(cells, goods, ["price", "cost", *categories])


def _keys(categories: list[str]) -> list[str]:
    return list(dict.fromkeys(["min_dt", "loc_no", *categories]))


def fold_shipments(src: Sources, goods: DataFrame, categories: list[str], start: date, end: date,
                   stores: DataFrame | None = None) -> DataFrame:
    """Warehouse shipments to stores, valued at line cost and list price."""
    headers = src.shipment_header.where(
        (F.col("from_location_no") == fv.WAREHOUSE_ORIGIN) & within(F.col("date_transferred"), start, end)
    )
    headers = with_week(headers, "date_transferred").select(
        "transfer_id", "min_dt", F.col("to_location_no").alias("loc_no")
    )
    if stores is not None:
        headers = present(headers, stores, ["loc_no"])
    lines = src.shipment_detail.select("transfer_id", "item_code", "qty", "cost_each").join(headers, "transfer_id").drop("transfer_id")
    cells = _cells(lines, total(F.col("qty")).alias("ship_qty"), total(F.col("qty") * F.col("cost_each")).alias("ship_cost"))
    return _valued(cells, goods, categories).select(
        *_keys(categories),
        F.lit(1).alias("ship_its"),
        "ship_qty",
        money(F.col("ship_cost")).alias("ship_cost"),
        money(zero(F.col("ship_qty") * F.col("price"))).alias("ship_val"),
    )


def fold_receiving(src: Sources, goods: DataFrame, categories: list[str], start: date, end: date,
                   stores: DataFrame | None = None) -> DataFrame:
    """Goods booked in by stores, valued at master cost and list price."""
    headers = src.receiving_header.where(F.col("shipment_type").isin("R", "W")).select(
        "batch_id", F.col("location_no").alias("loc_no")
    )
    if stores is not None:
        headers = present(headers, stores, ["loc_no"])
    lines = src.receiving_detail.where(within(F.col("process_date"), start, end))
    lines = with_week(lines, "process_date").select("batch_id", "item_code", "qty", "min_dt")
    cells = _cells(lines.join(headers, "batch_id").drop("batch_id"), total(F.col("qty")).alias("rcv_qty"))
    return _valued(cells, goods, categories).select(
        *_keys(categories),
        F.lit(1).alias("rcv_its"),
        "rcv_qty",
        money(zero(F.col("rcv_qty") * F.col("cost"))).alias("rcv_cost"),
        money(zero(F.col("rcv_qty") * F.col("price"))).alias("rcv_val"),
    )


def sales_cells(src: Sources, start: date, end: date, stores: DataFrame | None = None,
                known_flag_only: bool = False, items: DataFrame | None = None, by_slice: bool = False) -> DataFrame:
    """Store sales per week, store and item: net, marked-down and refunded measures.

    ``sold_lines`` and its kin are signed line counts: cost is taken once per line, not per unit.
    ``known_flag_only`` drops lines with an unknown return flag from the marked-down amount as well.
    With ``items``, only their lines are summed; with ``by_slice``, the cells lie where ``at_goods`` needs them.
    """
    flag, register, unit = F.col("is_return"), F.col("register_price"), F.col("unit_price")
    quantity, amount = F.col("quantity"), F.col("extended_amt")
    below = marked_down(register, unit)
    if known_flag_only:
        below = below & zero_false(F.lower("is_return").isin("y", "n"))
    one = F.lit(1)
    lines = src.sales_line.where((F.col("status") == "A") & within(F.col("business_date"), start, end))
    if items is not None:
        lines = present(lines, items, ["item_code"])
    lines = with_week(lines, "business_date")
    cells = (
        (dealt(lines) if by_slice else lines)
        .groupBy("min_dt", "location_id", "item_code", *([SLICE] if by_slice else []))
        .agg(
            total(net(flag, quantity)).alias("sold_qty"),
            total(net(flag, one)).alias("sold_lines"),
            total(amount).alias("sold_val"),
            total(net(flag, unit)).alias("list_val"),
            total(net_marked_down(flag, register, unit, quantity)).alias("md_sold_qty"),
            total(net_marked_down(flag, register, unit, one)).alias("md_lines"),
            total_if(below, amount).alias("md_sold_val"),
            total(net_marked_down(flag, register, unit, unit)).alias("md_list_val"),
            total_if(is_return(flag), quantity).alias("rfnd_qty"),
            total_if(is_return(flag), -amount).alias("rfnd_val"),
        )
    )
    places = src.locations.select("location_id", F.col("location_no").alias("loc_no"))
    placed = cells.join(F.broadcast(places), "location_id").drop("location_id")  # one row a store
    return placed if stores is None else present(placed, stores, ["loc_no"])


def fold_sales(src: Sources, goods: DataFrame, categories: list[str], start: date, end: date,
               stores: DataFrame | None = None) -> DataFrame:
    """Store sales valued with master cost."""
    return _valued(sales_cells(src, start, end, stores, by_slice=True), goods, categories).select(
        *_keys(categories),
        F.lit(1).alias("sold_its"),
        "sold_qty",
        money(zero(F.col("sold_lines") * F.col("cost"))).alias("sold_cost"),
        *[money(F.col(name)).alias(name) for name in ("sold_val", "list_val")],
        "md_sold_qty",
        money(zero(F.col("md_lines") * F.col("cost"))).alias("md_cost"),
        *[money(F.col(name)).alias(name) for name in ("md_sold_val", "md_list_val")],
        "rfnd_qty",
        money(F.col("rfnd_val")).alias("rfnd_val"),
    )


def transfer_lines(src: Sources, start: date, end: date, item: str = "dips_item_code",
                   plausible_only: bool = False, items: DataFrame | None = None, by_slice: bool = False) -> DataFrame:
    """Closed transfer lines per week, store pair, kind and item, with quantity and extended cost; with ``items``, only theirs.

    With ``by_slice``, they and the cells made of them lie where ``at_goods`` needs them.
    """
    headers = src.transfer_header.where(
        (F.col("status_code") == fv.TRANSFER_CLOSED)
        & F.col("transfer_type").isin(*fv.TRANSFER_KINDS)
        & within(F.col("update_time"), start, end)
    )
    headers = with_week(headers, "update_time").select(
        "transfer_bin_no", "transfer_type", "min_dt", "location_no", "to_location_no"
    )
    details = src.transfer_detail.where(F.col("status_code") == fv.TRANSFER_LINE_OK)
    if plausible_only:
        details = details.where(plausible_cost(F.col("dips_cost"), F.col("quantity")))
    details = details.select("transfer_bin_no", F.col(item).alias("item_code"), "quantity", "dips_cost")
    if items is not None:
        details = present(details, items, ["item_code"])
    lines = details.join(headers, "transfer_bin_no")
    return (
        (dealt(lines) if by_slice else lines.repartition("min_dt", "item_code"))  # serves this grouping and the one of ``transfer_cells``
        .groupBy("min_dt", "location_no", "to_location_no", "transfer_type", "item_code", *([SLICE] if by_slice else []))
        .agg(total(F.col("quantity")).alias("qty"), total(F.col("dips_cost") * F.col("quantity")).alias("cost"))
    )


def transfer_cells(lines: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Outbound quantity and cost per kind, and inbound store-to-store goods, per week, store and item.

    A line is an outbound row at its sender and, if store to store, an inbound row at its receiver. Both kinds
    of row go through one grouping, which stands for the full outer join of senders and receivers. A store
    filter tests the row's own store, so inbound goods are kept by the receiving store.
    """
    ends = F.array_compact(
        F.array(
            F.struct(F.col("location_no").alias("loc_no"), F.lit(False).alias("inbound")),
            F.when(
                F.col("transfer_type") == fv.STORE_TO_STORE,
                F.struct(F.col("to_location_no").alias("loc_no"), F.lit(True).alias("inbound")),
            ),
        )
    )
    rows = lines.withColumn("end", F.explode(ends)).select("*", "end.loc_no", "end.inbound")
    if stores is not None:
        rows = present(rows, stores, ["loc_no"])
    cell = [*CELL, *([SLICE] if SLICE in lines.columns else [])]
    # A cell has few moves, most cells one: they are gathered and picked by kind, which takes rows of two measures through
    # the grouping in place of rows of sixteen.
    moves = rows.groupBy(*cell).agg(F.collect_list(F.struct("inbound", "transfer_type", "qty", "cost")).alias("_moves"))
    only = F.col("_moves")[0]

    def picked(test: Callable[[Column], Column], measure: str, name: str) -> Column:
        kind = rows.schema[measure].dataType
        none = F.lit(0).cast(kind)
        summed = F.aggregate(F.filter("_moves", test), none, lambda so_far, move: (so_far + zero(move[measure])).cast(kind))
        return F.when(F.size("_moves") > 1, summed).otherwise(F.when(test(only), zero(only[measure])).otherwise(none)).alias(name)

    def sent(code: int) -> Callable[[Column], Column]:
        return lambda move: ~move["inbound"] & (move["transfer_type"] == code)

    sums = []
    for code, kind in fv.TRANSFER_KINDS.items():
        name = "out_sts" if kind == "sts" else kind
        sums += [picked(sent(code), m, f"{name}_{m}") for m in ("qty", "cost")]
    sums += [picked(lambda move: move["inbound"], m, f"in_sts_{m}") for m in ("qty", "cost")]
    return moves.select(*cell, *sums)


def removed(measure: str) -> Column:
    """Goods removed from inventory: trashed, damaged and donated."""
    return sum((F.col(f"{kind}_{measure}") for kind in ("dmg", "dnt")), F.col(f"tsh_{measure}"))


def fold_transfers(src: Sources, goods: DataFrame, categories: list[str], start: date, end: date,
                   stores: DataFrame | None = None) -> DataFrame:
    """Transfers with list values, reduced to removals, store-to-store moves and vendor returns."""
    cells = transfer_cells(transfer_lines(src, start, end, by_slice=True), stores)
    return _valued(cells, goods, categories).select(
        *_keys(categories),
        removed("qty").alias("rfi_qty"),
        money(removed("cost")).alias("rfi_cost"),
        money(zero(removed("qty") * F.col("price"))).alias("rfi_list"),
        "in_sts_qty",
        "out_sts_qty",
        (F.col("rtn_qty") != 0).cast("int").alias("rtn_its"),
        "rtn_qty",
        money(F.col("rtn_cost")).alias("rtn_cost"),
        money(zero(F.col("rtn_qty") * F.col("price"))).alias("rtn_list"),
    )


def transfer_balance(cells: DataFrame, by: list[str]) -> DataFrame:
    """Inbound, outbound and net store-to-store goods per group."""
    sums = [total(F.col(f"{way}_sts_{m}")).alias(f"{way}_sts_{m}") for way in ("in", "out") for m in ("qty", "cost")]
    return cells.groupBy(*by).agg(*sums).withColumns(
        {f"net_sts_{m}": F.col(f"in_sts_{m}") - F.col(f"out_sts_{m}") for m in ("qty", "cost")}
    )


# --- assembly -------------------------------------------------------------------------------------

def activity(keys: list[str], measures: dict[str, str], *folds: DataFrame, counts_on: Iterable[str] = ()) -> DataFrame:
    """Stack the folds and sum every measure per key in one grouping; ``measures`` maps names to types.

    With ``counts_on``, only keys stay at which one of these sums is not zero. Money is summed as whole numbers of its smallest
    unit, which takes less time and memory than wide decimals; a sum beyond 922 trillion fails. The sums become money in an
    array: as columns, their code would be one method too long to be compiled to machine code.
    """
    stacked = folds[0]
    for fold in folds[1:]:
        stacked = stacked.unionByName(fold, allowMissingColumns=True)
    in_units = [name for name, kind in measures.items() if kind == MONEY and _exact(stacked.schema[name].dataType)]
    rows = stacked.withColumns({name: (F.col(name) * UNITS).cast("bigint") for name in in_units})
    sums = rows.groupBy(*keys).agg(*[total(F.col(name)).alias(name) for name in measures])
    if counts_on:
        sums = sums.where(any_nonzero(*counts_on))
    amounts = F.transform(F.array(*in_units), lambda units: F.when(units == 0, money(F.lit(0))).otherwise(
        money(units.cast("decimal(19,0)") * F.lit(Decimal(1) / UNITS))))
    found = {name: F.col("_money")[i] for i, name in enumerate(in_units)}
    return sums.withColumn("_money", amounts).select(
        *keys, *[found.get(name, F.col(name)).cast(kind).alias(name) for name, kind in measures.items()])


def _exact(kind: T.DataType) -> bool:
    """Whether amounts of the type are whole numbers of the smallest unit."""
    return isinstance(kind, T.DecimalType) and kind.scale <= 4


def store_spans(acts: DataFrame, active_on: list[str], volume: Column | None = None) -> DataFrame:
    """The first and last week of activity of each store; with ``volume``, only stores whose sum is not zero."""
    active = F.when(any_nonzero(*active_on), F.col("min_dt"))
    bounds = acts.groupBy("loc_no").agg(
        F.min(active).alias("first"), F.max(active).alias("last"),
        F.sum(volume if volume is not None else F.lit(1)).alias("volume"),
    )
    return bounds.where((F.col("volume") != 0) & F.col("first").isNotNull()).select("loc_no", "first", "last")


def active_only(acts: DataFrame, column: str, volume: Column) -> DataFrame:
    """Values of a key whose volume over the whole run is not zero."""
    sums = acts.groupBy(column).agg(F.sum(volume).alias("volume"))
    return sums.where(F.col("volume") != 0).select(column)


def silent_only(acts: DataFrame, column: str, volume: Column) -> DataFrame:
    """The values that ``active_only`` leaves out, but for null."""
    sums = acts.groupBy(column).agg(F.sum(volume).alias("volume"))
    return sums.where(~zero_false(F.col("volume") != 0) & F.col(column).isNotNull()).select(column)


def location_detail(acts: DataFrame, spans: DataFrame, categories: list[DataFrame], keys: list[str],
                    measures: Iterable[str], shared: DataFrame | None = None) -> DataFrame:
    """Dense detail: every store week with every category row, zero where nothing happened.

    The grid is shuffled as one row per store and category row, beside the weeks in which something happened; the other
    weeks are filled in by the task that holds the row. ``acts`` has one row per key, so a row brings a history at most.
    Both sides are dealt by number, because the rows of a partition grow after it is read, which adaptive execution cannot see.
    ``shared`` holds measures that many category rows have in common, one row per week, store and value of the further
    columns of the categories. It is small and is broadcast to the weeks, so these measures travel once, not once a row.
    """
    names = list(measures)
    series = [key for key in keys if key != "min_dt"]
    own = [name for name in names if shared is None or name not in shared.columns]
    width = int(acts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    facts = acts.select("min_dt", *series, F.struct(*own).alias("_row")).where(F.col("min_dt").isNotNull())
    facts = facts.repartition(width, *series).groupBy(*series).agg(F.collect_list(F.struct("min_dt", "_row")).alias("_seen"))
    # The stores are few; the first category may have any number of rows.
    grid = dense_spine(*categories, spans).repartition(width, *series).join(facts, series, "left")
    kind = facts.schema["_seen"].dataType
    nothing = F.lit(None).cast(kind.elementType["_row"].dataType)
    seen = F.filter(F.coalesce("_seen", F.array().cast(kind)), lambda s: s["min_dt"].between(F.col("first"), F.col("last")))
    silent = F.array_except(F.sequence("first", "last", F.expr("interval 7 days")), F.transform(seen, lambda s: s["min_dt"]))
    idle = F.transform(silent, lambda week: F.struct(week.alias("min_dt"), nothing.alias("_row")))
    further = [name for name in (shared.columns if shared is not None else []) if name not in keys and name not in names]
    detail = grid.select(*series, *further, F.explode(F.concat(seen, idle)).alias("_cell"))
    detail = detail.select(*series, *further, "_cell.min_dt", *[F.col(f"_cell._row.{name}").alias(name) for name in own])
    if shared is not None:
        on = [name for name in shared.columns if name not in names]
        detail = look_up(detail, F.broadcast(shared), on)
    return with_year_week(detail.fillna(0, subset=names)).select("yr", "wk", *keys, *names)


def culled_detail(acts: DataFrame, keys: list[str], measures: Iterable[str], extra: list[DataFrame],
                  active_on: list[str], label: str) -> DataFrame:
    """Dense detail by section without silent stores, silent sections and weeks outside a store's activity.

    Silence is judged on the sparse activity first, so that the grid is built for surviving rows only.
    """
    acts = staged(acts.where(F.col("section").isNotNull()), label)
    volume = F.col("ship_qty") + F.abs("sold_qty") + F.col("rfi_qty")
    spans = store_spans(acts, active_on, volume)
    sections = active_only(acts, "section", volume)
    return location_detail(acts, spans, [sections, *extra], keys, measures)
