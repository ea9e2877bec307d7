"""Naming a value inside an expression."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often ``use`` mentions it.

    A column that is mentioned twice is copied into the plan twice; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
