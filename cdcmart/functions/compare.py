"""Null-safe comparison of two rows over a list of columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(a: DataFrame | str, b: DataFrame | str, cols: Sequence[str]) -> list[tuple[Column, Column]]:
    def side(x: DataFrame | str, c: str) -> Column:
        return F.col(f"{x}.{c}") if isinstance(x, str) else x[c]

    return [(side(a, c), side(b, c)) for c in cols]


def differs(a: DataFrame | str, b: DataFrame | str, cols: Sequence[str]) -> Column:
    """True where any of ``cols`` is distinct between sides ``a`` and ``b``; NULL equals NULL."""
    return reduce(or_, [~x.eqNullSafe(y) for x, y in _pairs(a, b, cols)])


def same(a: DataFrame | str, b: DataFrame | str, cols: Sequence[str]) -> Column:
    """True where all of ``cols`` are equal; NULL matches nothing, so this is a plain join condition."""
    return reduce(and_, [x == y for x, y in _pairs(a, b, cols)])
