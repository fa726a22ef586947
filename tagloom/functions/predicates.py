"""Presence tests on one or several columns."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WHITESPACE = " \t\n\r\f\x0b"


def non_blank(col) -> Column:
    """Text that holds more than white space; never NULL itself."""
    return F.coalesce(F.trim(col, F.lit(_WHITESPACE)) != "", F.lit(False))


def filled(df: DataFrame, *names: str) -> Column:
    """Every named column is not NULL and, if it is text, not empty."""
    def one(name):
        present = F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, T.StringType):
            present = present & (F.col(name) != "")
        return present
    return reduce(and_, map(one, names))


def any_non_blank(*names: str) -> Column:
    return reduce(or_, (non_blank(F.col(name)) for name in names))
