"""Measure expressions shared by the weekly folds."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfweek.functions.text import fold_case

MONEY = "decimal(19,4)"
RATE = "decimal(19,6)"
# Implausible transfer lines (high cost with a low unit cost, or very large lines).
COST_SUSPECT_ABOVE, UNIT_COST_FLOOR, QUANTITY_BELOW, COST_BELOW = 75, 50, 1000, 500
# Day limits of the sales age buckets.
AGE_LIMITS = (0, 15, 30, 60, 180, 365)


def zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def total(value: Column) -> Column:
    """Sum with an empty sum counted as zero."""
    return zero(F.sum(value))


def total_if(condition: Column, value: Column) -> Column:
    return total(F.when(condition, value))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def is_return(flag: Column) -> Column:
    """True for a return line; an unknown flag counts as a sale."""
    return F.coalesce(fold_case(flag) == "y", F.lit(False))


def net(flag: Column, value: Column) -> Column:
    """The value, negated on return lines."""
    return F.when(is_return(flag), -value).otherwise(value)


def marked_down(register: Column, unit: Column) -> Column:
    return F.coalesce(register < unit, F.lit(False))


def net_marked_down(flag: Column, register: Column, unit: Column, value: Column) -> Column:
    """Signed value of a line sold under its unit price; lines with an unknown return flag give nothing."""
    known = F.coalesce(fold_case(flag).isin("y", "n"), F.lit(False))
    return F.when(marked_down(register, unit) & known, net(flag, value)).otherwise(F.lit(0).cast("int"))


def any_nonzero(*names: str) -> Column:
    return reduce(or_, [F.col(name) != 0 for name in names])


def rate(amount: Column, per: Column) -> Column:
    """Ratio at a fixed scale; null when the denominator is null or zero."""
    return F.try_divide(amount.cast("double"), F.nullif(per.cast("double"), F.lit(0.0))).cast(RATE)


def plausible_cost(cost: Column, quantity: Column) -> Column:
    unit = F.try_divide(cost.cast("double"), quantity.cast("double"))
    return (
        ~((cost > COST_SUSPECT_ABOVE) & (unit < UNIT_COST_FLOOR))
        & (quantity < QUANTITY_BELOW)
        & (cost < COST_BELOW)
    )


def age_bucket_sums(stocked: Column, sold: Column) -> dict[str, Column]:
    """Counts of sold lines by days in stock; ages from the last limit on belong to no bucket."""
    age = F.datediff(sold, stocked)
    sums = {}
    for low, high in zip(AGE_LIMITS, AGE_LIMITS[1:]):
        test = (age < high) if low == 0 else (age >= low) & (age < high)
        sums[f"age_{high:03d}"] = F.count_if(test)
    return sums
