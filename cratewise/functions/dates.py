"""Repair of partial, zero and impossible release dates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date of "no usable date", and the year that stands for "unknown year".
UNKNOWN_DATE = datetime.date(9999, 12, 31)
UNKNOWN_YEAR = 9999

# The first and the last whole year of a 32-bit count of days around 1970.
FIRST_YEAR, LAST_YEAR = -5_877_640, 5_881_579


def repair_date(year: Column, month: Column, day: Column) -> Column:
    """Earliest date the given parts allow; :data:`UNKNOWN_DATE` when they form no date.

    NULL and 0 mean "part unknown": the year becomes 9999, month and day become 1. So a row with no
    parts at all is dated 9999-01-01, ahead of an impossible date such as 30 February. Whether the
    parts form a date is decided by calendar arithmetic, whatever the session does about errors.
    """
    zero = F.lit(0)
    y = F.coalesce(F.nullif(year, zero), F.lit(UNKNOWN_YEAR)).cast("int")
    m = F.coalesce(F.nullif(month, zero), F.lit(1)).cast("int")
    d = F.coalesce(F.nullif(day, zero), F.lit(1)).cast("int")
    leap = (F.pmod(y, F.lit(4)) == 0) & ((F.pmod(y, F.lit(100)) != 0) | (F.pmod(y, F.lit(400)) == 0))
    last = (
        F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    )
    valid = y.between(FIRST_YEAR, LAST_YEAR) & m.between(1, 12) & d.between(1, last)
    return F.when(valid, F.make_date(y, m, d)).otherwise(F.lit(UNKNOWN_DATE))
