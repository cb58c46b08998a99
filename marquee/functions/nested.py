"""JSON arrays kept as text in a flat file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_array(text: Column, ddl: str) -> Column:
    """Parse JSON text; malformed text is NULL, unknown keys drop, missing keys are NULL."""
    return F.from_json(text, ddl)


def is_corrupt(text: Column, parsed: Column) -> Column:
    """True where there was text that did not parse."""
    return text.isNotNull() & parsed.isNull()
