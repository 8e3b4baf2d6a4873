"""Date functions (DAT1-DAT8, SRC4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mysql_short_date(c: Column, fmt: str = "MM/dd/yy") -> Column:
    """SRC4/DAT3: ``STR_TO_DATE(s, '%m/%d/%y')``.

    Spark maps two-digit years to 20xx; MySQL pivots at 70 (``'75'`` → 1975),
    so 100 years are taken off when ``yy >= 70``.  Invalid dates → NULL.
    """
    d = F.try_to_date(c, fmt)
    yy = F.substring_index(c, "/", -1).try_cast("int")
    return F.when(yy >= 70, F.add_months(d, -1200)).otherwise(d)


def date_from_parts(y: Column, m: Column, d: Column) -> Column:
    """DAT7/CLN13: date from numeric parts, invalid (31 Feb) → NULL."""
    txt = F.concat_ws("-", y.cast("bigint").cast("string"), m.cast("bigint").cast("string"),
                      d.cast("bigint").cast("string"))
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(),
                  F.try_to_date(txt, "y-M-d"))


def age_in_year(birth: Column, ref_year: int) -> Column:
    """DAT8: reference year minus birth year."""
    return F.lit(ref_year) - F.year(birth)


def days_before(as_of: Column | str, n: Column | int) -> Column:
    """DAT4/DAT5: ``as_of - INTERVAL n DAY`` for a timestamp."""
    a = F.lit(as_of) if isinstance(as_of, str) else as_of
    k = F.lit(n) if isinstance(n, int) else n
    return a.cast("timestamp_ntz") - F.make_dt_interval(days=k)


def reverse_date_text(ts_text: Column) -> Column:
    """DAT2: ``FORMAT_DATE('%d-%m-%Y', PARSE_DATE('%Y-%m-%d', SUBSTR(ts,1,10)))``."""
    return F.date_format(F.try_to_date(F.substring(ts_text, 1, 10), "yyyy-MM-dd"), "dd-MM-yyyy")
