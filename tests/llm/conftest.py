from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from texts; row i has doc_id i."""
    def make(texts, schema=DOCS):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)
    return make


def clashing_words(length=1024):
    """Two words whose letters follow the Thue-Morse sequence and its
    complement: every hash that sums letters times powers of a base modulo
    2**64 is equal for them."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
