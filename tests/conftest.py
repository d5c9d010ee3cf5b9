from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postcluster.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

POSTING_SCHEMA = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="postcluster-tests")
    yield session
    session.stop()


@pytest.fixture
def postings_df(spark):
    """Build a posting DataFrame from tuples."""
    def make(rows):
        return spark.createDataFrame(rows, POSTING_SCHEMA)
    return make


@pytest.fixture
def lines_file(tmp_path):
    """Write text lines to a file and return its path."""
    def make(lines, name="postings.csv"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)
    return make
