"""Casts from landed text that give NULL, never an error, for a bad value.

The session may run with ANSI mode on, where a plain cast of bad text fails the
whole job; one bad row in a snapshot must not do that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

# Optional sign, digits, optional fraction; at least a digit or a point.
_NUMBER = r"^\s*([+-]?)(?=[\d.])(\d*)(?:\.\d*)?\s*$"
# Sign and digits behind a zero, for numbers that start with their point.
_WHOLE = "$1" + "0" + "$2"
# So many digits fit into an int.
_SURE_DIGITS = 9


def integral(text: Column, to: DataType) -> Column:
    """Text to a whole number, dropping a decimal fraction (``'2.7'`` gives 2).

    Snapshots taken through float columns carry whole numbers as ``'2.0'``.
    Most values are a few digits, or such with ``.0`` behind, and need no pattern. For the
    others it decides before the cast, because a failing cast costs an exception per row.
    """
    head = F.when(F.endswith(text, F.lit(".0")), F.left(text, F.length(text) - 2)).otherwise(text)
    plain = F.length(head).between(1, _SURE_DIGITS) & (F.ltrim(head, F.lit("0123456789")) == "")
    whole = F.regexp_replace(text, _NUMBER, _WHOLE)
    return F.when(plain, head.try_cast(to)).when(text.rlike(_NUMBER), whole.try_cast(to))


def lenient(text: Column, to: DataType) -> Column:
    """Cast landed text to ``to``; a value that does not fit becomes NULL."""
    if isinstance(to, IntegralType):
        return integral(text, to)
    return text.try_cast(to)
