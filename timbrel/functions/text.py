"""Small text expressions shared by the parsers and predicates."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes; the last one is U+3000.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Remove all white space at both ends (``trim`` alone removes blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def fill_template(template: str, **values: Column) -> Column:
    """``str.format`` with columns: ``{name}`` is replaced, doubled braces halve.

    The template is cut apart on the driver and joined with ``concat``, so
    braces inside an inserted answer are never looked at again.
    """
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name])
    return F.concat(*parts) if parts else F.lit("")
