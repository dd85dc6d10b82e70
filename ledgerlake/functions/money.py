"""Sales money arithmetic in exact decimals.

Two net-amount definitions exist and are kept apart on purpose:

* DataFrame form (P14-P16): gross is rounded to cents, the discount amount
  is rounded to cents, and net = gross - discount.
* SQL form (P25): one rounding at the end of
  ``quantity * unit_price * (1 - discount_pct / 100)``.

They can differ by one cent (gross 0.10 at 5 %: 0.09 vs 0.10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
UNIT_MONEY = "decimal(12,2)"
# Wider than the reference's decimal(10,2) so large orders cannot overflow
# (an ANSI overflow would fail the whole job).
SQL_NET = "decimal(14,2)"


def gross_amount(quantity: Column, unit_price: Column) -> Column:
    """Int * decimal(12,2) is decimal(23,2), stored as decimal(14,2)."""
    return (quantity * unit_price).cast(MONEY)


def discount_amount(gross: Column, discount_pct: Column) -> Column:
    """Rounded to cents before the subtraction."""
    return (gross * (discount_pct / F.lit(100))).cast(MONEY)


def net_amount(gross: Column, discount: Column) -> Column:
    """P16."""
    return (gross - discount).cast(MONEY)


def unit_profit(unit_price: Column, cost_price: Column) -> Column:
    """P18."""
    return (unit_price - cost_price).cast(UNIT_MONEY)


def sql_net_amount_expr(q: str = "o.quantity", price: str = "p.unit_price",
                        disc: str = "o.discount_pct") -> str:
    """P25 as SQL text: one rounding at the end."""
    return f"CAST({q} * {price} * (1 - {disc}/100) AS {SQL_NET.upper()})"
