"""Columns by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")
