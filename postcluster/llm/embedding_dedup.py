"""Near-duplicate vectors by quantised tile products with error bounds.

Vectors of one label (and one length) are compared with each other, each with
all, and linked when their cosine in double precision reaches a threshold.

1. Equal vectors are one representative with a weight, so copies cost nothing
   more, however many there are.
2. Representatives of a label are dealt into blocks by a hash of their id; each
   pair of blocks is one unit of work.  A label of t tiles of ``TILE`` vectors
   has about sqrt(t) blocks (and none of more than ``MOST_TILES`` tiles), so a
   vector travels about sqrt(t) times, and a label that holds a third of all
   rows is spread over t / 2 tasks.
3. A pair of blocks is worked through tile by tile.  In a pair of tiles, vectors are int8 codes times a scale.  The product of
   the codes is an exact integer, and by Cauchy-Schwarz the true cosine
   differs from the scaled product by at most
   ``|x'| * err(y) + err(x) * |y'| + err(x) * err(y)``, where ``err`` is the
   length of a vector's quantisation error and ``x'`` its decoded form.
   Only pairs that may reach the threshold are computed again in double
   precision.  No pair at or over the threshold can be missed.
4. A pair of blocks gives link counts per vector and a spanning forest of its
   links (never more rows than vectors), not the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.components import components, forest
from postcluster.llm.frames import cut

THRESHOLD = 0.98
TILE = 1024
#: Tiles of one block at most: 64 MB of 512 numbers.
MOST_TILES = 16
#: Pairs computed in double precision at a time.
EXACT_CHUNK = 1 << 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (int8), scales, decoded lengths and error lengths of unit vectors."""
    scale = np.abs(unit).max(axis=1, initial=0.0) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def links(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of ``x`` and ``y``, or i < j within ``x``) whose cosine
    reaches the threshold."""
    def prepared(v):
        norm = np.linalg.norm(v, axis=1)
        return v, norm, quantise(v / norm[:, None])

    a, a_norm, (a_codes, a_scale, a_len, a_err) = prepared(x)
    b, b_norm, (b_codes, b_scale, b_len, b_err) = prepared(x if y is None else y)
    # Sums of dim products of codes are exact below 2**24 in single precision.
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (a_codes.astype(kind) @ b_codes.astype(kind).T).astype(np.float64)
    near *= a_scale[:, None] * b_scale
    bound = a_len[:, None] * b_err + a_err[:, None] * b_len + a_err[:, None] * b_err
    near += bound
    may = near >= threshold - 1e-9  # the last term covers the rounding of these sums
    if y is None:
        may = np.triu(may, 1)
    i, j = np.nonzero(may)
    true = np.zeros(len(i), bool)
    for at in range(0, len(i), EXACT_CHUNK):
        p, q = i[at:at + EXACT_CHUNK], j[at:at + EXACT_CHUNK]
        true[at:at + EXACT_CHUNK] = np.einsum("ij,ij->i", a[p], b[q]) / (a_norm[p] * b_norm[q]) >= threshold
    return i[true], j[true]


def _block(cell: pa.StructArray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, copies and vectors of the k-th block of a pair, from Arrow's buffers."""
    rows = cell.field("rows")[k].values
    ids, copies, vectors = (rows.field(c) for c in ("rep", "copies", "vector"))
    return ids.to_numpy(), copies.to_numpy(), vectors.flatten().to_numpy().reshape(len(rows), -1)


FOUND = "a long, b long, n long"


def _compare(threshold: float, tile: int):
    def pair(cell: pa.StructArray) -> pa.RecordBatch | None:
        x_id, x_n, x = _block(cell, 0)
        y_id, y_n, y = _block(cell, len(cell) - 1)
        low, high = [], []
        x_count, y_count = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        for p in range(0, len(x), tile):
            for q in range(0 if len(cell) == 2 else p, len(y), tile):
                same = len(cell) == 1 and p == q
                i, j = links(x[p:p + tile], None if same else y[q:q + tile], threshold)
                i, j = i + p, j + q
                np.add.at(x_count, i, y_n[j])
                np.add.at(y_count, j, x_n[i])
                if len(i):
                    a, b = forest(x_id[i], y_id[j])
                    low.append(a)
                    high.append(b)
        if not low:
            return None
        node, count = np.concatenate([x_id, y_id]), np.concatenate([x_count, y_count])
        node, count = node[count > 0], count[count > 0]
        a, b = forest(np.concatenate(low), np.concatenate(high))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([node, a])),
            pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(b)]),
            pa.concat_arrays([pa.array(count), pa.nulls(len(a), pa.int64())]),
        ], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = pair(batch.column("blocks")[k].values)
                if found is not None:
                    yield found
    return run


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, vec_id: str = "vec_id",
                 vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    ``n_links`` counts the other rows linked directly, equal vectors
    included.  A null or empty vector, one of zeros only, one with a null or
    non-finite entry, a null label and a null id link with nothing.  Vectors
    of different lengths link with nothing.  A repeated row is another vector
    with the same id.  A null id has no component and is not kept.
    """
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"),
                     F.col(f"`{vector}`").cast("array<double>").alias("v"), F.col(f"`{label}`").alias("label"))
    top = float(np.finfo(np.float64).max)
    sound = F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= top))
        & F.exists("v", lambda e: e != 0.0), F.lit(False))
    # Equal vectors of a label have equal keys (128 bits of hash).
    keyed = rows.select("id", "v", "label", sound.alias("sound")).select(
        "id", "v", "label", "sound",
        F.when(F.col("sound"), F.xxhash64("label", "v")).alias("k1"),
        F.when(F.col("sound"), F.xxhash64(F.lit(7), "v", "label")).alias("k2"))
    reps = cut(keyed.where("sound").groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("vector"),
        F.first("label").alias("label")))
    reps = reps.withColumn("dim", F.size("vector"))
    tiles = F.count("*") / F.lit(tile)
    sizes = reps.groupBy("label", "dim").agg(
        F.greatest(F.ceil(F.sqrt(tiles)), F.ceil(tiles / MOST_TILES)).cast("int").alias("blocks"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    blocks = dealt.groupBy("label", "dim", "blocks", "block").agg(
        F.collect_list(F.struct("rep", "copies", "vector")).alias("rows"))  # MOST_TILES tiles at most, about
    paired = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "label", "dim", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        F.struct("block", "rows").alias("t"))
    pairs = paired.groupBy("label", "dim", "low", "high").agg(F.sort_array(F.collect_list("t")).alias("blocks"))
    pairs = pairs.where((F.size("blocks") == 2) | (F.col("low") == F.col("high")))
    found = cut(pairs.select("blocks").mapInArrow(_compare(threshold, tile), FOUND))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    of_rep = components(found.where("b IS NOT NULL").select("a", "b"))
    known = (
        reps.select("k1", "k2", "rep", "copies").join(counts, "rep", "left")
        .join(of_rep, F.col("rep") == F.col("id"), "left")
        .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    )
    component = F.coalesce("component", "id")
    return keyed.select("id", "k1", "k2").join(known, ["k1", "k2"], "left").select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
