"""Text scan and posting parser (the original suite's load/parse tests)."""

from __future__ import annotations

import pytest

from postcluster.sources.tables import postings_from_tables
from postcluster.sources.text import parse_postings, posting_lines, read_posting_lines, read_postings
from tests.conftest import SF_SMALL

GOOD = [
    ("1,6,,,140,CSS", (1, 6, None, None, 140, "CSS")),
    ("2,7,,6,-67", (2, 7, None, 6, -67, None)),
    ("1,8,,,5,", (1, 8, None, None, 5, None)),
    ("1,9,,,5,,x", (1, 9, None, None, 5, "")),
    ("1,10,11,,5,a,b", (1, 10, 11, None, 5, "a")),
    ('3,1,,,0,"q', (3, 1, None, None, 0, '"q')),
    ("1,+3,,,-0,C++", (1, 3, None, None, 0, "C++")),
    ("1,12,,,5,,,,", (1, 12, None, None, 5, None)),
    ("1,2147483647,-2147483648,,5,Java", (1, 2147483647, -2147483648, None, 5, "Java")),
    ("1,13,,,5,12345678901", (1, 13, None, None, 5, "12345678901")),
    ("1,14,,,0012,a b", (1, 14, None, None, 12, "a b")),
    ("2,15,,14,5,\u2028", (2, 15, None, 14, 5, "\u2028")),
]

BAD = ["1,2", "", "1,2,,,,CSS", "1, 2,,,5", "1,x,,,5", "1,99999999999,,,5", "1,2,3.5,,5", ",,,,,",
       "1,2147483648,,,5", "1,5,,-2147483649,5", "1,5,,,5 ", "1,5,,,+", "1,5,,,5\u2028"]


def test_edge_lines_parse(spark, lines_file):
    path = lines_file([line for line, _ in GOOD])
    rows = [tuple(r) for r in read_postings(spark, path).collect()]
    assert sorted(rows, key=repr) == sorted([want for _, want in GOOD], key=repr)


def test_lines_equal_postings(spark, lines_file):
    path = lines_file([line for line, _ in GOOD])
    lines = read_posting_lines(spark, path)
    assert lines.count() == parse_postings(lines).count() == len(GOOD)


@pytest.mark.parametrize("bad", BAD)
@pytest.mark.parametrize("action", ["collect", "count"])
def test_malformed_line_fails_job(spark, lines_file, bad, action):
    path = lines_file(["1,6,,,140,CSS", bad, "2,7,,6,-67"])
    df = read_postings(spark, path)
    with pytest.raises(Exception, match="malformed posting line|USER_RAISED_EXCEPTION"):
        getattr(df, action)()


def test_render_and_parse_round_trip(spark):
    typed = postings_from_tables(spark, SF_SMALL)
    parsed = parse_postings(posting_lines(typed))
    assert typed.exceptAll(parsed).isEmpty()
    assert parsed.exceptAll(typed).isEmpty()


def test_schema(spark, lines_file):
    df = read_postings(spark, lines_file(["1,6,,,140,CSS"]))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("posting_type", "int"), ("id", "int"), ("accepted_answer", "int"),
        ("parent_id", "int"), ("score", "int"), ("tags", "string"),
    ]
