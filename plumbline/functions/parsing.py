"""Turning CSV text into typed values without ever raising on a bad one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field texts that a CSV reader takes as "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: the date format of the order and shipping date columns.
STAMP_FORMAT = "M/d/yyyy H:mm"

# What a decoder leaves behind where the bytes were not valid UTF-8.
REPLACEMENT_CHARACTER = "�"


def quoted(name: str) -> str:
    """Column name for use in an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Replace the null tokens in every text column by a real null."""
    return df.select(
        *[
            F.when(~named(name).isin(*NULL_TOKENS), named(name)).alias(name)
            if kind == "string"
            else named(name)
            for name, kind in df.dtypes
        ]
    )


def whole_number(value: Column) -> Column:
    """Text as bigint; ``3.0`` counts as whole, anything fractional or unreadable is null.

    The direct cast comes first, so that long identifiers keep every digit.
    """
    trimmed = F.trim(value.cast("string"))
    as_decimal = trimmed.try_cast("decimal(38,10)")
    return F.coalesce(
        trimmed.try_cast("bigint"),
        F.when(as_decimal == F.floor(as_decimal), as_decimal.try_cast("bigint")),
    )


def decimal_number(value: Column, precision: int, scale: int) -> Column:
    """Text as a decimal, rounded half up to its scale; unreadable text is null."""
    return F.trim(value.cast("string")).try_cast(f"decimal({precision},{scale})")


def stamp(value: Column, pattern: str = STAMP_FORMAT) -> Column:
    """Text as a timestamp, padded or not; unreadable text is null."""
    return F.try_to_timestamp(F.trim(value), F.lit(pattern))


def blank(value: Column) -> Column:
    """Null or empty text."""
    return value.isNull() | (value.cast("string") == "")


def instant_or(value: Column, fallback: Column) -> Column:
    """ISO instant text as a timestamp, or the fallback where it cannot be read."""
    return F.coalesce(value.try_cast("timestamp"), fallback)
