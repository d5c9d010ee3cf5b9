"""The parser is stateless, so it also runs on a streaming text source."""

from __future__ import annotations

from postcluster.streaming import read_posting_stream


def test_parse_postings_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("1,6,,,140,CSS\n2,7,,6,-67\n1,8,,,5,\n")
    stream = read_posting_stream(spark, str(src))
    assert stream.isStreaming
    query = (stream.writeStream.format("memory").queryName("parsed_postings_stream")
             .option("checkpointLocation", str(tmp_path / "ckpt"))
             .trigger(availableNow=True).start())
    try:
        query.awaitTermination(120)
        rows = sorted(tuple(r) for r in spark.table("parsed_postings_stream").collect())
    finally:
        query.stop()
    assert rows == [(1, 6, None, None, 140, "CSS"), (1, 8, None, None, 5, None), (2, 7, None, 6, -67, None)]
