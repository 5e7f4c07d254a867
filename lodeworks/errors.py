"""Errors carry a rule's name and counts, never values of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class EngineError(RuntimeError):
    """A run cannot go on safely; the message holds no record values."""


def require(condition: bool, message: str) -> None:
    if not condition:
        raise EngineError(message)


def require_none(df: DataFrame, rules: dict[str, Column]) -> None:
    """Raise if any row breaks a rule; all rules are counted in one pass.

    A rule is a column that is true for a bad row; null counts as good.
    """
    counts = df.agg(*[F.count(F.when(bad, 1)).alias(f"r{i}") for i, bad in enumerate(rules.values())]).first()
    broken = [f"{name} ({counts[i]})" for i, name in enumerate(rules) if counts[i]]
    require(not broken, "rows break: " + ", ".join(broken))
