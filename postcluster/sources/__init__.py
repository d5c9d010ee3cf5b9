"""Sources and sinks: posting text, the table adapter, the text report."""

from postcluster.sources.tables import (
    answer_postings,
    other_postings,
    posting_lines_from_tables,
    posting_text_from_tables,
    postings_from_tables,
    question_postings,
    read_table,
)
from postcluster.sources.text import (
    POSTING_COLUMNS,
    POSTING_SCHEMA,
    parse_postings,
    posting_lines,
    read_posting_lines,
    read_postings,
)

__all__ = [
    "POSTING_COLUMNS",
    "POSTING_SCHEMA",
    "answer_postings",
    "other_postings",
    "parse_postings",
    "posting_lines",
    "posting_lines_from_tables",
    "posting_text_from_tables",
    "postings_from_tables",
    "question_postings",
    "read_posting_lines",
    "read_postings",
    "read_table",
]
