"""Null keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def known(*names: str) -> Column:
    """True where none of the columns is null; daily reports leave other rows out."""
    return reduce(and_, (F.col(name).isNotNull() for name in names))
