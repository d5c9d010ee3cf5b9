"""Column expressions for turning one comma-separated posting line into fields.

All of them are built-in Spark SQL expressions, so the parse stays inside
whole-stage codegen and runs map-side, one pass over the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An int field: optional sign and ASCII digits, no blanks.  Spark's cast
# trims blanks (' 5' becomes 5), so the pattern is checked as well.
_INT_PATTERN = r"^[+-]?[0-9]+\z"
_INT = r"[+-]?[0-9]+"
_SHORT_INT = r"[+-]?[0-9]{1,9}"  # always within the 32-bit range
# A whole posting line: int, int, optional int, optional int, int, then
# anything (tags and ignored fields; trailing empty fields are dropped).
LINE_PATTERN = rf"(?s)^{_INT},{_INT},(?:{_INT})?,(?:{_INT})?,{_INT}(?:,.*)?\z"
# The same layout with numbers of at most 9 digits: valid without any
# further check.  Only a line that fails it needs the exact range check.
SHORT_LINE_PATTERN = (
    rf"(?s)^{_SHORT_INT},{_SHORT_INT},(?:{_SHORT_INT})?,(?:{_SHORT_INT})?,{_SHORT_INT}(?:,.*)?\z"
)


def split_fields(line: Column) -> Column:
    """Split on ',' keeping every field, trailing empty ones included.

    Java's ``String.split`` drops trailing empty fields.  For a valid line
    that only matters for the optional sixth field (the fifth is a
    non-empty int), and :func:`tags_field` applies that rule, so no regex
    pass is needed to strip the trailing commas.
    """
    return F.split(line, ",", -1)


def tags_field(fields: Column) -> Column:
    """Field 5 when the line has six or more fields after trailing empty
    ones are dropped, i.e. when some field from index 5 on is non-empty;
    else null.  (``1,9,,,5,,x`` gives '' and ``1,8,,,5,`` gives null.)"""
    rest = F.concat_ws("", F.slice(fields, 6, F.greatest(F.size(fields), F.lit(1))))
    return F.when(rest != F.lit(""), field(fields, 5))


def field(fields: Column, i: int) -> Column:
    """0-based field ``i``, or null when the line has fewer fields."""
    return F.get(fields, i)


def is_strict_int(text: Column) -> Column:
    """True when ``text`` is a 32-bit int literal: sign, digits, no blanks, no overflow.

    ``try_cast`` must stay in the test: it is what rejects an overflowing
    number when column pruning has removed the typed projection (a bare
    ``count()``).
    """
    return F.coalesce(text.rlike(_INT_PATTERN) & text.try_cast("int").isNotNull(), F.lit(False))


def empty_to_null(text: Column) -> Column:
    """An empty field means "absent"."""
    return F.nullif(text, F.lit(""))


def is_optional_int(text: Column) -> Column:
    """An optional int field is valid when empty or a strict int."""
    return (text == F.lit("")) | is_strict_int(text)
