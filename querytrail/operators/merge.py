"""Unions of delimited tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat_checked(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union, refused unless both have the same headers in the same order."""
    if first.columns != second.columns:
        raise ValueError(f"headers differ: {first.columns} / {second.columns}")
    return first.union(second)


def concat_positional(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union by position; the headers of the first win."""
    return first.union(second)


def combine_extracts(extracts: list[DataFrame]) -> DataFrame:
    """Bag union by name; a column missing in one extract becomes null."""
    if not extracts:
        raise ValueError("no extracts to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), extracts)
