"""Number parsing and storage rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts that count as numbers. Blanks, digit separators and
# type suffixes, which a plain cast lets through, are not numbers here.
WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
DECIMAL_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

# Fixed value: the stored number of decimals.
STORED_DECIMALS = 6

# Fixed value: the change reported where there is nothing to compare with.
NO_BASELINE = -99999999.0


def parse_long(text: Column) -> Column:
    """Text to bigint, NULL unless all of it is a whole number in range."""
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("bigint"))


def _parse_real(text: Column, kind: str) -> Column:
    value = text.try_cast(kind)
    finite = text.rlike(DECIMAL_NUMBER) & (F.abs(value) < F.lit("Infinity").cast(kind))
    return F.when(finite, value)


def parse_double(text: Column) -> Column:
    """Text to double, NULL unless all of it is a finite decimal number."""
    return _parse_real(text, "double")


def parse_float(text: Column) -> Column:
    """Text to float, NULL unless all of it is a decimal number in float range."""
    return _parse_real(text, "float")


def stored(column: Column, data_type: T.DataType) -> Column:
    """A value the way keyed tables keep it: reals to six decimals.

    Text, whole numbers and reals can be stored; any other type becomes NULL.
    """
    if isinstance(data_type, T.FloatType | T.DoubleType):
        return F.round(column, STORED_DECIMALS)
    if isinstance(data_type, T.StringType | T.IntegerType | T.LongType):
        return column
    return F.lit(None).cast(data_type)


def widened(column: Column, data_type: T.DataType) -> Column:
    """A percentage as double, through its decimal text if it is a float.

    A float 0.1 compared as double must be 0.1, not 0.10000000149.
    """
    if isinstance(data_type, T.FloatType):
        return column.cast("string").cast("double")
    return column.cast("double")
