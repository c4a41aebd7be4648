"""Casts of text that other tools wrote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as true.
TRUE_TEXTS = ("t", "True", "true", "1")


def forgiving_true(x: Column) -> Column:
    """True for the usual spellings of true, false for everything else, NULL included."""
    return F.coalesce(x.cast("string").isin(*TRUE_TEXTS), F.lit(False))


def matrix_of(text: Column) -> Column:
    """A matrix of numbers that was saved as JSON text; NULL for anything else."""
    return F.from_json(text, "array<array<double>>")
