"""Money arithmetic on decimals, so sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(15,2)"
AMOUNT = "decimal(18,4)"


def discounted_amount(price: Column | str, rate: Column | str) -> Column:
    """Price after the discount rate has been taken off."""
    price, rate = _money(price), _money(rate)
    return (price * (F.lit(1) - rate)).cast(AMOUNT)


# The same computation is offered under a second name.
pricing_discounted_amount = discounted_amount


def discount_amount(price: Column | str, rate: Column | str) -> Column:
    """Money value of the discount."""
    return (_money(price) * _money(rate)).cast(AMOUNT)


def _money(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(PRICE)
