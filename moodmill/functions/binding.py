"""Column helpers that evaluate an expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time per row."""
    return F.transform(F.array(value), lambda bound: body(bound))[0]


def only_if(
    value: Column, test: Callable[[Column], Column], change: Callable[[Column], Column]
) -> Column:
    """Apply ``change`` where a cheap ``test`` says that it can matter."""
    return let(value, lambda x: F.when(test(x), change(x)).otherwise(x))
