"""Language tag to index, and x coordinate back to label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def language_array(langs: Sequence[str]) -> Column:
    """The language list as a literal ``array<string>``; position is the index."""
    return F.array(*[F.lit(name) for name in langs])


def first_language_index(tags: Column, langs: Sequence[str]) -> Column:
    """0-based index of the first language equal to ``tags``, else null.

    Whole-string, case-sensitive equality; a null tag gives null.
    ``array_position`` is 1-based with 0 for "absent".
    """
    pos = F.array_position(language_array(langs), tags)
    return (F.nullif(pos, F.lit(0)) - F.lit(1)).cast("int")


def int_div(x: Column, d: int) -> Column:
    """Integer division truncated toward zero: Spark SQL's ``div``."""
    return F.call_function("div", x, F.lit(d)).cast("int")


def language_label(x: Column, langs: Sequence[str], spread: int) -> Column:
    """Label of the language whose x coordinate is ``x``: ``langs[x div spread]``."""
    return F.get(language_array(langs), int_div(x, spread))
