"""The reports as jobs: each computes its report and writes it as files in the order its readers expect.

Every job returns the schemas of the files it wrote, by report name, with which ``report_files.read_report`` reads them back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfweek.plans import chain_report, inbound, program_rollup, section_rates, title_report
from shelfweek.plans.report_files import write_report
from shelfweek.sources.tables import Sources, staging


def _written(path: str, **reports: DataFrame) -> dict[str, T.StructType]:
    for name, df in reports.items():
        write_report(df, f"{path}/{name}", name)
    return {name: df.schema for name, df in reports.items()}


def write_chain_reports(facts: Sources, path: str, since_year: int = 2016) -> dict[str, T.StructType]:
    with staging(facts.new_goods.sparkSession):
        by_source, by_section = chain_report.chain_report(facts, since_year)
        return _written(path, chain_by_source=by_source, chain_by_section=by_section)


def write_title_report(item_facts: DataFrame, products: DataFrame, path: str, since: date) -> dict[str, T.StructType]:
    with staging(item_facts.sparkSession):
        return _written(path, titles=title_report.title_running_totals(item_facts, products, since))


def write_program_reports(src: Sources, path: str, as_of: date, weeks: int = 26) -> dict[str, T.StructType]:
    with staging(src.wh_shipment_header.sparkSession):
        return _written(path, program_detail=program_rollup.program_detail(src, as_of, weeks), program_rollup=program_rollup.program_rollup(src, as_of, weeks))


def write_inbound_reports(src: Sources, path: str, as_of: date, set_id: int | None = None, oos_set_id: int = 36,
                          rule: inbound.OrderNumbers = inbound.SIX_CHARACTERS) -> dict[str, T.StructType]:
    with staging(src.products.sparkSession):
        detail, overview = inbound.inbound(src, as_of, set_id, oos_set_id, rule)
        return _written(path, inbound_detail=detail, inbound_overview=overview)


def write_section_rates(expected: DataFrame, path: str) -> dict[str, T.StructType]:
    """``expected`` has the compared rates of the last week (``section_rates.expected_sales``)."""
    return _written(path, section_rates=section_rates.rates_output(expected))
