"""Raw rows to a fact table and its bridges. Everything here is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions import is_corrupt, json_array, lenient

CORRUPT = "corrupt_"


def parse_json_arrays(
    df: DataFrame, arrays: Mapping[str, str], flag: bool = False, parsed_as: str | None = None
) -> DataFrame:
    """Replace JSON text columns by arrays of structs, in one projection.

    With ``flag`` each parsed column gets a ``corrupt_<column>`` boolean beside it, so
    that text lost to bad JSON can be counted later without the text. Columns that ``with_losses`` has
    parsed already, under the prefix ``parsed_as``, are taken instead.
    """
    made = {
        name: json_array(F.col(name), ddl) if parsed_as is None else F.col(parsed_as + name)
        for name, ddl in arrays.items()
    }
    flags = {CORRUPT + name: is_corrupt(F.col(name), array) for name, array in made.items()} if flag else {}
    return df.withColumns(made | flags).drop(*([] if parsed_as is None else [parsed_as + name for name in arrays]))


def loss_names(columns: Iterable[tuple[str, str, str]], arrays: Mapping[str, str]) -> list[str]:
    """The columns that :func:`with_losses` adds."""
    casts = [f"lost_{target}" for _, target, kind in columns if kind != "string"]
    return casts + [f"lost_{name}_{field}" for name, ddl in arrays.items() for field in _fields(ddl)]


def _fields(ddl: str) -> list[str]:
    return StructType.fromDDL(f"item {ddl}")["item"].dataType.elementType.names


def with_losses(
    df: DataFrame, columns: Iterable[tuple[str, str, str]], arrays: Mapping[str, str], parsed_as: str | None = None
) -> DataFrame:
    """Raw rows with how much casts and parsing lose of each: ``lost_<target>`` is 1 where a text that is not
    blank has no number, ``lost_<array>_<field>`` counts elements whose field holds a value that did
    not come out.

    The JSON is parsed a second time, once for all fields, and only where a field was NULL the first time. With the
    prefix ``parsed_as`` the arrays of the first time stay, for ``parse_json_arrays``.
    """
    prefix = parsed_as or "_parsed_"
    # apart from the marks, so that the text is not parsed for each use
    df = df.withColumns({prefix + name: json_array(F.col(name), ddl) for name, ddl in arrays.items()})
    casts = {
        f"lost_{target}": F.when((F.trim(source) != "") & lenient(F.col(source), kind).isNull(), 1).otherwise(0)
        for source, target, kind in columns
        if kind != "string"
    }
    marks = {f"_marks_{name}": lost_marks(F.col(name), F.col(prefix + name), ddl) for name, ddl in arrays.items()}
    counts = {
        f"lost_{name}_{field}": F.coalesce(F.array_size(F.filter(f"_marks_{name}", lambda mark: mark[field])), F.lit(0))
        for name, ddl in arrays.items()
        for field in _fields(ddl)
    }
    # apart from the counts, so that the text is not parsed for each of them
    left = [*marks, *([] if parsed_as else [prefix + name for name in arrays])]
    return df.withColumns(marks).withColumns(casts | counts).drop(*left)


def lost_marks(text: Column, parsed: Column, ddl: str) -> Column:
    """Per element of a JSON array whether each field has a value in the text but none as ``ddl`` types it;
    NULL if all fields came out. One object is an array of one, as for the parser."""
    fields = _fields(ddl)
    whole = F.try_parse_json(text)
    elements = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array(whole))

    def marked(item: Column, element: Column) -> Column:
        held = {field: F.try_variant_get(element, f"$['{field}']", "string") for field in fields}
        lost = (F.coalesce(item[f].isNull() & held[f].isNotNull(), F.lit(False)).alias(f) for f in fields)
        return F.struct(*lost)

    some = F.exists(parsed, lambda item: reduce(Column.__or__, (item[field].isNull() for field in fields)))
    return F.when(some, F.zip_with(parsed, elements, marked))


def fact_select(df: DataFrame, columns: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Project, leniently cast and rename ``(source, target, type)`` columns."""
    return df.select(*(lenient(F.col(src), to).alias(dst) for src, dst, to in columns))


def explode_bridge(
    df: DataFrame,
    key: str,
    array: str | Column,
    fields: Iterable[tuple[str, str]],
    carry: Iterable[str] = (),
) -> DataFrame:
    """One row per array element: key, carried columns, then the renamed struct fields.

    Rows whose array is NULL or empty leave no row. To unroll a single JSON column, pass the
    parsing expression as ``array``: below a parsed column, the filter for empty arrays that
    Spark infers would parse the text a second time.
    """
    kept = [key, *carry]
    items = df.select(*kept, F.explode(array).alias("item"))
    return items.select(*kept, *(F.col("item")[src].alias(dst) for src, dst in fields))


def orphan_rows(bridge: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Bridge rows that an inner join with the fact table drops, NULL keys included.

    The bridge may hold a hot key, which adaptive execution divides; fact keys should be few
    per key, or made distinct by the caller.
    """
    return bridge.join(fact.select(key), key, "left_anti")
