"""Column references that survive dots in names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]
