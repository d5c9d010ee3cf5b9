"""DataFrame helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postcluster import session
from postcluster.llm.words import slices

#: Names inside the operators; callers' columns travel in one struct, so no
#: column of theirs can clash with these.
ROW, TEXT = "_row", "_text"


def find_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster where it is not there, install it or use ``--py-files``; a
    folder that an executor lacks does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def _table_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema, prefers_large_types=False)


def map_texts(df: DataFrame, text: str, keep: list[str], fields: str,
              make: Callable[[], Callable[[pa.Array], list]]) -> DataFrame:
    """A column struct ``_row`` with the ``keep`` columns, followed by
    ``fields`` computed from each row's text.

    ``make()`` runs once in each task and returns the function from a slice
    of texts (an Arrow string array, about 4 MB) to the new columns.  The
    plan is one map over the scan: no shuffle, and a task holds one slice.
    """
    find_code(df.sparkSession)
    cols = [F.col(f"`{c}`") for c in keep]
    packed = df.select(F.struct(*cols).alias(ROW), F.col(f"`{text}`").cast("string").alias(TEXT))
    new = T.StructType.fromDDL(fields)
    schema = T.StructType([packed.schema[ROW], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = _table_schema(schema)
        work = make()
        for batch in batches:
            for part in slices(batch, TEXT):
                made = work(part.column(TEXT))
                columns = [part.column(ROW)] + [
                    x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, to.field(i + 1).type)
                    for i, x in enumerate(made)
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(to.field(i).type) if c.type != to.field(i).type else c
                     for i, c in enumerate(columns)], schema=to)

    return packed.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared folder that
    ``spark.checkpoint.dir`` names, so a lost executor rereads them.

    The files go with :func:`drop`, with the end of a :func:`scope`, with
    ``session.discard_all`` or, if the session's
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` says so, with the frame.
    """
    spark = df.sparkSession
    find_code(spark)
    if not spark.sparkContext.getCheckpointDir():
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    done = df.checkpoint(eager=True)
    session.track(spark, _folder(done))
    return done


def _folder(cut_frame: DataFrame) -> str:
    return cut_frame._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()


def drop(*cut_frames: DataFrame) -> None:
    """Delete the files of frames from :func:`cut` that nothing reads any more."""
    for frame in cut_frames:
        session.discard(frame.sparkSession, {_folder(frame)})


def keep_only(spark: SparkSession, before: set[str], *cut_frames: DataFrame) -> None:
    """Delete what was written since ``before`` (``session.open_folders``), but
    for some frames from :func:`cut`."""
    session.discard(spark, session.open_folders(spark) - before - {_folder(f) for f in cut_frames})


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Whatever the operators write inside is deleted at the end; results
    must be written or collected before."""
    before = session.open_folders(spark)
    try:
        yield
    finally:
        session.discard(spark, session.open_folders(spark) - before)
