"""Tolerant casts: a value that does not fit the wanted type becomes NULL, it never fails the job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"
RATE = "decimal(38,18)"

# What text must look like before it is handed to the cast. For numbers this is a matter of speed only: the cast
# raises and catches an exception for each bad value, which costs a hundred times as much as the pattern.
_TEXT = {
    "bigint": r"^\s*[+-]?\d+\s*$",
    "decimal": r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$",
    "timestamp": r"^\s*\d{4}-\d{1,2}-\d{1,2}",
    "date": r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$",
}


def _is(c: Column, *types: str) -> Column:
    # typeof() is folded to a literal at planning time, so the branch not taken never reaches execution.
    return F.typeof(c).isin(*types)


def _guarded(c: Column, to: str, kind: str) -> Column:
    """``try_cast`` that text only reaches if it looks right."""
    return F.when(~_is(c, "string") | c.cast("string").rlike(_TEXT[kind]), c.try_cast(to))


def safe_cast(c: Column | str, to: str) -> Column:
    """Cast ``c`` to ``to`` (a Spark type name), with NULL for values that are not valid for it.

    Narrower than ``try_cast`` where that is more generous than a warehouse cast: only ``true``/``false`` are boolean
    text, a timestamp needs a full date (``'12:30'`` would otherwise mean today), date text is only a date, and
    fractional numbers are rounded half away from zero on their way to an integer instead of truncated.
    """
    c = F.col(c) if isinstance(c, str) else c
    to = to.lower()
    if to == "bigint":
        fractional = _is(c, "double", "float") | F.typeof(c).startswith("decimal")
        # In its own type: a cast to fewer places first would round twice.
        rounded = F.round(c, 0).try_cast("bigint")
        return F.when(fractional, rounded).otherwise(_guarded(c, to, "bigint"))
    if to == "boolean":
        text = F.lower(c.cast("string"))
        from_text = F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
        return F.when(_is(c, "string"), from_text).otherwise(c.try_cast("boolean"))
    kind = to.split("(")[0]
    return _guarded(c, to, kind) if kind in _TEXT else c.try_cast(to)


def cast_columns(df: DataFrame, spec: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Project ``df`` to ``(source column, output name, type)`` entries, each through ``safe_cast``."""
    return df.select(*[safe_cast(F.col(source), to).alias(name) for source, name, to in spec])


def round_to_long(c: Column) -> Column:
    """Decimal to integer with rounding half away from zero (a plain cast would truncate)."""
    return F.round(c, 0).cast("bigint")
