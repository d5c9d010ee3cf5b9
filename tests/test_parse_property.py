"""The parser against a plain-Python model of the original's line semantics."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postcluster.sources.text import _line_is_valid, parse_postings

_INT = re.compile(r"[+-]?[0-9]+")


def java_split(line: str) -> list[str]:
    """``String.split(",")``: trailing empty fields are dropped."""
    parts = line.split(",")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and line != "":
        return []
    return parts


def parse_int(text: str) -> int:
    if not _INT.fullmatch(text):
        raise ValueError(text)
    value = int(text)
    if not -(2**31) <= value < 2**31:
        raise ValueError(text)
    return value


def model(line: str):
    """The typed posting, or None when the original would fail on the line."""
    try:
        f = java_split(line)
        return (
            parse_int(f[0]),
            parse_int(f[1]),
            None if f[2] == "" else parse_int(f[2]),
            None if f[3] == "" else parse_int(f[3]),
            parse_int(f[4]),
            f[5] if len(f) >= 6 else None,
        )
    except (ValueError, IndexError):
        return None


field_text = st.one_of(
    st.integers(-(2**31) - 5, 2**31 + 5).map(str),
    st.integers(0, 99).map(lambda v: f"+{v}"),
    st.text(alphabet="0123456789+- aC#", max_size=4),
    st.just(""),
    st.integers(10**9, 10**11).map(str),
)
line_text = st.one_of(
    st.lists(field_text, min_size=0, max_size=8).map(",".join),
    st.text(alphabet="0123456789,+- aC", max_size=14),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line_text, min_size=1, max_size=40))
def test_parser_matches_model(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    flags = {r["i"]: r["ok"] for r in df.select("i", _line_is_valid(F.col("value")).alias("ok")).collect()}
    want = {i: model(s) for i, s in enumerate(lines)}
    assert {i: bool(flags[i]) for i in flags} == {i: w is not None for i, w in want.items()}
    valid = [(i, s) for i, s in enumerate(lines) if want[i] is not None]
    if valid:
        got = parse_postings(spark.createDataFrame(valid, "i int, value string")).collect()
        assert sorted((tuple(r) for r in got), key=repr) == sorted(
            (want[i] for i, _ in valid), key=repr)
