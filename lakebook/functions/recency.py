"""How many whole months a sale lies before the run date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_months(as_of: date, ref: Column) -> Column:
    """Months from ``ref`` to ``as_of``, truncated toward zero; NULL for no date.

    Two month-ends, or equal days of the month, count as whole months apart, so
    this cannot be replaced by a cut-off date: with a run on 28 February,
    31 January is one month back and 30 January none.
    """
    sold = F.try_to_date(ref.cast("string"), "yyyyMMdd")
    return F.months_between(F.lit(as_of), sold).cast("int")


def within(age: Column, months: int) -> Column:
    """1 if at most ``months`` whole months old (so under ``months + 1``), else 0.

    Future dates have a negative age and count as recent; an unknown age is 0.
    """
    return F.when(age <= months, 1).otherwise(0)


def band(age: Column, limits: Sequence[int]) -> Column:
    """Index of the narrowest of the ascending ``limits`` that holds ``age``.

    Ages beyond all limits, and unknown ones, get ``len(limits)``.
    """
    narrowest = F.lit(len(limits))
    for index in reversed(range(len(limits))):
        narrowest = F.when(age <= limits[index], index).otherwise(narrowest)
    return narrowest.cast("tinyint")
