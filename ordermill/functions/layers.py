"""Columns computed in steps.

A rule that uses an intermediate value several times gets it as a column of an earlier step, so the
value is computed once. Independent rules share the steps: fewer steps mean fewer copies of the row.
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame

Layer = dict[str, Column]


def add_layers(df: DataFrame, *rules: list[Layer]) -> DataFrame:
    """Add the first step of every rule, then the second of every rule, and so on."""
    for step in zip_longest(*rules, fillvalue={}):
        df = df.withColumns({name: column for layer in step for name, column in layer.items()})
    return df
