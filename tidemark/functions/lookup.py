"""Joins against a lookup that is evaluated once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import settle


def attach(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``lookup``, which is stored first.

    The stored copy is computed once and has a known size, by which the optimizer chooses between a
    broadcast and a shuffled join; the result is the same either way.
    """
    return rows.join(settle(lookup, "lookup"), on, how)
