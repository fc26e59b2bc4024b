"""Name an intermediate value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once and written once.

    Expressions that mention an argument many times grow with every nesting, up to methods the
    JVM refuses to compile; a lambda variable keeps them linear.
    """
    return F.transform(F.array(value), use)[0]
