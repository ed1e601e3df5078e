"""Epoch-millis <-> timestamp with -1 as "absent", and the listing date format."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the listing date pattern, and the text shown when a date is absent.
DISPLAY_PATTERN = "MMM dd, yyyy"
ABSENT_TEXT = "n/a"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def millis_to_timestamp(col) -> Column:
    return F.timestamp_millis(F.nullif(_c(col), F.lit(-1).cast("bigint")))


def timestamp_to_millis(col) -> Column:
    return F.coalesce(F.unix_millis(_c(col)), F.lit(-1).cast("bigint"))


def display_date(col) -> Column:
    return F.coalesce(F.date_format(_c(col), DISPLAY_PATTERN), F.lit(ABSENT_TEXT))
