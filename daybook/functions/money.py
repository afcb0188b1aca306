"""Money columns: decimals at the edges, whole cents as long integers for arithmetic and sums.

Cents are exact and stay on the long-integer path, which decimal products and wide decimal sums
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import TOTAL

CENT = Decimal("0.01")


def holds_whole_cents(dtype: T.DataType) -> bool:
    """Whether every value of the type is a whole number of cents."""
    return isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale <= 2)


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def from_cents(amount: Column, dtype: T.DecimalType = TOTAL) -> Column:
    return (amount.cast(T.DecimalType(dtype.precision, 0)) * F.lit(CENT)).cast(dtype)


def floor_at_zero(value: Column) -> Column:
    """Negative becomes 0; null stays null (``greatest`` would turn it into 0)."""
    return F.when(value < 0, 0).otherwise(value)
