"""Evaluate costly expressions once per row."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once; also usable inside array lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def computed(frame: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` whose results are plain values to every later step.

    The optimizer copies the definition of a column into each filter that uses it. For long
    definitions built on each other these copies multiply, so they are generated as the fields of a
    one-element array, which filters do not look into.
    """
    made = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    kept = [name for name in frame.columns if name not in columns]
    return frame.select(*kept, F.inline(made))
