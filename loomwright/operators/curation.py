"""Curation steps that change fields under conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repair(c: Column, old: str, new: str) -> Column:
    """``old`` becomes ``new``; ``new`` stays; anything else stays too and is found by ``repair_error``."""
    return F.when(c == old, F.lit(new)).otherwise(c)


def repair_error(c: Column, old: str, new: str) -> Column:
    """Whether a repair can't apply: the value is neither the old nor the new one."""
    return ~c.isin(old, new) | c.isNull()
