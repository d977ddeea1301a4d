"""Text to typed values. A bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a boolean, and the accepted date and time layouts.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]
DATE_LAYOUT = r"^\d{4}-\d{2}-\d{2}$"
DIGIT = r"\p{Nd}"
TIMESTAMP_LAYOUT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"


def _decimal(c: Column, precision: int, scale: int) -> Column:
    """A text without any digit is no number and isn't parsed: the parser throws an exception for each bad text,
    which takes longer than all other work on a row."""
    return F.when(c.rlike(DIGIT), c.try_cast(f"decimal({precision},{scale})"))


def cast_try_number(c: Column, precision: int = 38, scale: int = 0) -> Column:
    """Decimal rounded half away from zero; with scale 0 the value is delivered as a long."""
    number = _decimal(c, precision, scale)
    return number.try_cast("bigint") if scale == 0 else number


def cast_try_int(c: Column) -> Column:
    """Minutes and miles written as "12.00"."""
    return F.round(_decimal(c, 10, 2), 0).try_cast("int")


def cast_try_date(c: Column) -> Column:
    """ISO dates only: a bare year is not a date."""
    return F.when(c.rlike(DATE_LAYOUT), c.try_cast("date"))


def cast_try_timestamp(c: Column) -> Column:
    """Zone-less timestamp; independent of the session time zone."""
    return F.when(c.rlike(TIMESTAMP_LAYOUT), c.try_cast("timestamp_ntz"))


def cast_try_date_ts(c: Column, kind: str = "date") -> Column:
    if kind not in ("date", "timestamp"):
        raise ValueError(f"kind must be date or timestamp, not {kind}")
    return cast_try_date(c) if kind == "date" else cast_try_timestamp(c)


def cast_try_boolean(c: Column) -> Column:
    word = F.lower(F.trim(c))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def cast_try_double(c: Column) -> Column:
    return c.try_cast("double")


def cast_numeric_flag(c: Column) -> Column:
    """Flags written as numbers ("1.00"); a missing flag counts as not set."""
    return F.coalesce(_decimal(c, 10, 2) == F.lit(1), F.lit(False))
