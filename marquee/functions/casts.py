"""Text to number casts where a bad value is NULL, with ANSI mode on or off.

``try_cast`` alone turns ``'162.0'`` into a NULL integer. Raw extracts are full of such
values, so a fraction is cut off first: ``'162.7'`` is 162 and ``'-.5'`` is 0. Anything
else (``'1e3'``, ``'abc'``, out of range) is NULL. Text goes straight to the integer type,
without a double on the way that would round values above 2**53.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[\s\p{Cntrl}]*"
_FRACTION = rf"^{_BLANK}([+-]?)([0-9]*)[.][0-9]*{_BLANK}$"


def _whole_part(text: Column, digits: int) -> Column:
    """Text of the whole part, or NULL where there is no number of at most ``digits`` digits.

    A ``try_cast`` that fails raises and catches inside, at ten times the cost of this check.
    """
    number = rf"^{_BLANK}[+-]?(?=[.0-9])0*+[0-9]{{0,{digits}}}+([.][0-9]*+)?{_BLANK}$"
    # sign, a zero for values such as '.5', then the digits before the point
    cut = F.regexp_replace(text, _FRACTION, "$10$2")
    whole = F.when(F.contains(text, F.lit(".")), cut).otherwise(text)
    return F.when(text.rlike(number), whole)


def lenient_int(text: Column) -> Column:
    return _whole_part(text, 10).try_cast("int")


def lenient_long(text: Column) -> Column:
    return _whole_part(text, 19).try_cast("bigint")


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


_CASTS = {"int": lenient_int, "long": lenient_long, "double": lenient_double}


def lenient(text: Column, to: str) -> Column:
    """Cast raw text to ``int``, ``long`` or ``double``; ``string`` is left alone."""
    return text if to == "string" else _CASTS[to](text)
