"""Evaluate an expression once and use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    Without it every mention repeats the whole expression, and chained text steps outgrow what one
    generated method may hold. `value` must not contain a Python function.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
