"""Aggregate expressions shared by the KPI tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is added up as whole ten-thousandths in a long: exact up to four decimals, so a
# total does not depend on the order in which shuffled rows arrive, and it stays in codegen.
MONEY_UNITS = 10_000


def _units(amount: Column) -> Column:
    return F.rint(amount * MONEY_UNITS).cast("bigint")


def money_sum(amount: Column) -> Column:
    """Exact total, null when every amount is null."""
    return F.sum(_units(amount)) / F.lit(float(MONEY_UNITS))


def money_sum_or_zero(amount: Column) -> Column:
    return F.coalesce(money_sum(amount), F.lit(0.0))


def money_avg(amount: Column) -> Column:
    return F.try_divide(money_sum(amount), F.count(amount))


def avg_where(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def share_where(condition: Column) -> Column:
    """Share of rows that satisfy ``condition``; an unknown condition counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def order_measures(*names: str, one_row_per_order: bool = False) -> list[Column]:
    """Named measures over order-grain rows.

    ``one_row_per_order`` replaces the distinct count by a plain count. That saves a shuffle
    of all order ids and gives the same number when the input is known to hold each order once.
    """
    order_id = F.col("order_id")
    paid = F.col("total_payment")
    known = {
        "orders": F.count(order_id) if one_row_per_order else F.count_distinct(order_id),
        "revenue": money_sum_or_zero(paid),
        "avg_order_value": money_avg(paid),
        "late_rate": F.avg("is_late"),
        "avg_review_score": F.avg("review_score"),
        "avg_delivery_days": F.avg("delivery_days"),
    }
    return [known[name].alias(name) for name in names]
