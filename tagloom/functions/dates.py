"""Date suffixes of table names. The run date is always a parameter."""

import datetime as dt

from pyspark.sql import Column, functions as F

SUFFIX_FORMAT = "yyyyMMdd"


def suffix(day) -> Column:
    return F.date_format(day, SUFFIX_FORMAT)


def previous_suffix(day) -> Column:
    return F.date_format(F.date_sub(day, 1), SUFFIX_FORMAT)


def run_suffix(run_date: dt.date, days_back: int = 0) -> str:
    return (run_date - dt.timedelta(days=days_back)).strftime("%Y%m%d")
