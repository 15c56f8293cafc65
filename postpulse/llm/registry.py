"""What the corpus operators register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q
from .oracles import oracle_sql

__all__ = ["oracle_sql", "queries"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in vars(q).items() if name.startswith("op")}
