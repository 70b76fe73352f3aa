"""Column helpers; everything here is a plain Spark expression, no UDF."""

from stratamart.functions.dates import (
    between_window,
    greatest_strict,
    least_strict,
    median_of_three,
)
from stratamart.functions.keys import joined_key, surrogate_key
from stratamart.functions.money import (
    discount_amount,
    discounted_amount,
    pricing_discounted_amount,
)

__all__ = [
    "between_window",
    "discount_amount",
    "discounted_amount",
    "greatest_strict",
    "joined_key",
    "least_strict",
    "median_of_three",
    "pricing_discounted_amount",
    "surrogate_key",
]
