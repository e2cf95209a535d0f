"""A sample of the registered queries beside their SQL; ``python -m registry.check`` runs them all."""

from datetime import date
from pathlib import Path

import pytest

import __spark_entry__ as contract
from registry import ORACLE, QUERIES, inbound
from registry.check import compare, connect
from registry.standins import Retail

DATA = Path("/root/testdata/sf0.001")
SAMPLE = ["weekly_sales", "location_detail", "item_detail_sparse", "online_rollup_used", "chain_by_section", "title_running_totals",
          "nearest_in_time", "expected_sales_yoy", "section_report_titles", "merged_item_rates", "inbound_detail_lines", "serial_facts", "item_master_refresh"]


def test_every_statement_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not DATA.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    line, good = compare(spark, connect(str(DATA)), str(DATA), name, contract.queries()[name], contract.oracle_sql()[name])
    assert good, line


@pytest.mark.skipif(not DATA.exists(), reason="test tables not present")
def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.skipif(not DATA.exists(), reason="test tables not present")
def test_plans_have_no_nested_loop_and_push_filters(spark, capsys):
    contract.queries()["weekly_shipments"](spark, str(DATA)).explain("formatted")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan or "PushedFilters: [IsNotNull(" in plan


def test_warehouse_details_are_derived_once_and_stored_by_tier(spark, tmp_path):
    """The readers of a tier scan it; before, each of them joined the whole tables again."""
    days = [date(1996, 5, 1), date(1998, 5, 1), date(2001, 5, 1), None]
    orders = spark.createDataFrame([(i, "F", "2-HIGH", day) for i, day in enumerate(days)],
                                   "o_orderkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate date")
    lines = spark.createDataFrame([(i, 1, 1 + i % 2, 5.0, "N", "O", date(2001, 6, 1), 1 + i) for i in (0, 1, 1, 2, 3, 9)],
                                  "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, l_linestatus string, "
                                  "l_shipdate date, l_linenumber int")
    part = spark.createDataFrame([(1, "red ring", "Brand#1")], "p_partkey bigint, p_name string, p_brand string")
    for name, df in (("orders", orders), ("lineitem", lines), ("part", part)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    plain, stored = Retail(spark, str(tmp_path)), inbound.warehouse(Retail(spark, str(tmp_path)), rated=False)
    for name, sizes in (("wh_receipt_tiers", [1, 2, 1]), ("wh_po_tiers", [1, 3])):
        for (_, want), (_, got), size in zip(plain[name], stored[name], sizes, strict=True):
            picked = want.select(*got.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, picked.collect())) and got.count() == size
            assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
