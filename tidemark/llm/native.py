"""Column expressions shared by the operators (no Python at run time)."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character kept."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def text_key(c: Column) -> Column:
    """Digest that stands for a text in joins; a null text is an empty one."""
    return F.md5(F.coalesce(c, F.lit("")).cast("binary"))


def crc32_text(c: Column) -> Column:
    return F.crc32(F.coalesce(c, F.lit("")).cast("binary"))
