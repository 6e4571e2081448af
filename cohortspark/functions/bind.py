"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it.

    A fold over nothing hands its start to its end as it is; ``transform`` would copy what ``use`` gives, whole.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda same, _: same, use)
