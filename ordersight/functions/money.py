"""Exact money arithmetic on DECIMAL(18,2)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordersight.schema import MONEY

ColumnOrNumber = Column | int | float | str | Decimal


def rate(value: ColumnOrNumber, precision: int = 6, scale: int = 4) -> Column:
    """A rate as an exact small decimal (a float literal would become DOUBLE
    and a Python Decimal literal DECIMAL(38,18); both spoil exactness)."""
    if isinstance(value, Column):
        return value.cast(f"decimal({precision},{scale})")
    return F.lit(str(value)).cast(f"decimal({precision},{scale})")


def money(col: Column) -> Column:
    return col.cast(MONEY)


def round_money(col: Column) -> Column:
    """HALF_UP to cents, then DECIMAL(18,2)."""
    return F.round(col, 2).cast(MONEY)


def cents(col: Column) -> Column:
    """Money as integer cents (BIGINT); exact for DECIMAL(18,2)."""
    return (col.cast(MONEY) * F.lit(100)).cast("bigint")


def from_cents(col: Column) -> Column:
    """Integer cents to DECIMAL(18,2): an exact multiply, no division."""
    return (col.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def price_components(
    quantity: Column,
    unit_price: Column,
    discount_rate: ColumnOrNumber,
    tax_rate: ColumnOrNumber = "0.08",
) -> dict[str, Column]:
    """Order amounts from quantity, unit price and rates.

    total = round(quantity * unit_price, 2); discount = round(total * discount_rate, 2);
    tax = round(total * tax_rate, 2) on the pre-discount total;
    final = total - discount + tax. All DECIMAL(18,2), rounding HALF_UP.
    """
    total = round_money(quantity.cast("decimal(20,0)") * unit_price.cast(MONEY))
    discount = round_money(total * rate(discount_rate))
    tax = round_money(total * rate(tax_rate))
    final = money(total - discount + tax)
    return {
        "total_amount": total,
        "discount_amount": discount,
        "tax_amount": tax,
        "final_amount": final,
    }
