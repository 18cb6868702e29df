"""Whole-number arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(value: Column, by: int) -> Column:
    """Integer quotient, exact for every BIGINT."""
    return F.call_function("div", value, F.lit(by))
