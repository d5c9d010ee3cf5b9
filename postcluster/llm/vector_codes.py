"""Vector codes: product quantisation with exact nearest entries.

Vectors become integers, are cut into parts, and every part position has a
codebook of at most 64 entries that a few rounds of means improve.  The code
of a vector is the index of the nearest entry in each part.

**Slice and intersect.**  The nearest entry is found exactly without comparing
with all entries.  Each dimension of a part keeps the entries' coordinates
sorted, with a prefix mask before each: the uint64 set of the entries sorted
before it.  Entries near in single dimensions give an initial radius that some
entry is known to lie in.  A dimension's entries inside the radius are a range
of its sorted coordinates, so their mask is the difference of two prefix
masks; ANDed over the dimensions, the masks leave the candidates.  No entry
outside can be nearer or as near, and the candidates' distances are exact
integers, so ties go to the lowest index.

**Scale.**  A round is one pass over the vectors.  A task adds up its parts by
entry and sends one row for each entry used; Spark adds those up, and the
driver gets the codebooks alone (``PARTS * ENTRIES`` rows, whatever the input).
Tasks get the codebooks with their code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import ROW, cut, find_code

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Integers beyond this are not coded: their squared distances may pass 64 bits.
LARGEST = 1 << 23
#: Vectors worked on at a time.
BATCH = 4096
VECTOR = "_vector"


class Codebook:
    """The entries of one part: int64[entries, dimensions]."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("an entry mask has 64 bits")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.left_shift(np.uint64(1), self.order.astype(np.uint64))
        self.before = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        self.before[1:] = np.bitwise_or.accumulate(bits, axis=0)

    def _distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return np.square(x - self.entries[entry]).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """A whole radius that holds an entry: the distance, rounded down, of
        the best of the entries next in each single dimension."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        for d in range(x.shape[1]):
            place = np.minimum(np.searchsorted(self.sorted[:, d], x[:, d]), len(self.entries) - 1)
            np.minimum(best, self._distance(x, self.order[place, d]), out=best)
        root = np.sqrt(best.astype(np.float64)).astype(np.int64)
        root -= root * root > best  # the square root of a large integer may round up or down
        return root + ((root + 1) * (root + 1) <= best)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries whose coordinates are all within the radius."""
        mask = np.full(len(x), self.before[-1, 0] if x.shape[1] else np.uint64(1), np.uint64)
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, side="right")
            mask &= self.before[high, d] ^ self.before[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry, ties to the
        lowest index.  A part without dimensions is at distance 0 of entry 0."""
        index, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not x.shape[1]:
            return index, best
        mask = self.candidates(x, self.radius(x))
        best[:] = np.iinfo(np.int64).max
        rows = np.flatnonzero(mask)
        while len(rows):
            left = mask[rows]
            lowest = left & (~left + np.uint64(1))
            entry = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
            distance = self._distance(x[rows], entry)
            nearer = distance < best[rows]
            index[rows[nearer]], best[rows[nearer]] = entry[nearer], distance[nearer]
            mask[rows] = left ^ lowest
            rows = rows[left != lowest]
        return index, best


def part_bounds(dim: int, parts: int) -> list[int]:
    """Where the parts begin; equal parts if ``parts`` divides ``dim``."""
    return [p * dim // parts for p in range(parts + 1)]


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(sound, rows of each vector's integers, fits) of a batch: ``sound``
    marks the vectors that are there and finite; of those, ``fits`` the ones
    whose integers are not too large."""
    lists = batch.column(VECTOR)
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    size = np.where(valid, pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(), 0).astype(np.int64)
    flat = lists.flatten()
    values = pa.compute.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(size)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sound = valid & (bad[first[1:]] == bad[first[:-1]])
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(values * SCALE)
    large = np.concatenate([[0], np.cumsum(~(np.abs(whole) <= LARGEST))])
    fits = large[first[1:]] == large[first[:-1]]
    whole = np.where(np.abs(whole) <= LARGEST, whole, 0).astype(np.int64)
    return sound, [whole[a:b] for a, b in zip(first[:-1], first[1:])], fits


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(sound rows, which of them can be coded, those as a matrix), a few
    thousand vectors at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            sound, rows, fits = _vectors(part)
            part = part.filter(pa.array(sound))
            kept = [rows[k] for k in np.flatnonzero(sound)]
            can = np.array([len(r) == dim for r in kept], bool) & fits[sound]
            yield part, can, np.array([r for r, c in zip(kept, can) if c], np.int64).reshape(int(can.sum()), dim)


def _smallest(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """The sound vectors (of any length but 0) of each batch's smallest ids."""
    for batch in batches:
        sound, rows, fits = _vectors(batch)
        ids = batch.column("id").to_pylist()
        use = [k for k in np.flatnonzero(sound & fits).tolist() if ids[k] is not None and len(rows[k])]
        use = sorted(use, key=lambda k: (ids[k], rows[k].tolist()))[:entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[k] for k in use], pa.int64()), pa.array([rows[k].tolist() for k in use], pa.list_(pa.int64()))],
            names=["id", "whole"])


def _sums(batches: Iterator[pa.RecordBatch], books: list[Codebook], bounds: list[int]) -> Iterator[pa.RecordBatch]:
    """A task's sums: one row (part, entry, n, sums) for each entry used."""
    count = [np.zeros(len(b.entries), np.int64) for b in books]
    total = [np.zeros_like(b.entries) for b in books]
    for _, _, x in _matrices(batches, bounds[-1]):
        for p, book in enumerate(books):
            own = x[:, bounds[p]:bounds[p + 1]]
            index, _ = book.nearest(own)
            np.add.at(count[p], index, 1)
            np.add.at(total[p], index, own)
    used = [(p, int(e)) for p in range(len(books)) for e in np.flatnonzero(count[p])]
    yield pa.RecordBatch.from_arrays([
        pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
        pa.array([int(count[p][e]) for p, e in used], pa.int64()),
        pa.array([total[p][e].tolist() for p, e in used], pa.list_(pa.int64())),
    ], names=["part", "entry", "n", "sums"])


def _codes(batches: Iterator[pa.RecordBatch], books: list[Codebook], bounds: list[int]) -> Iterator[pa.RecordBatch]:
    for rows, can, x in _matrices(batches, bounds[-1]):
        index = np.zeros((len(x), len(books)), np.uint8)
        error = np.zeros(len(x), np.int64)
        for p, book in enumerate(books):
            own, distance = book.nearest(x[:, bounds[p]:bounds[p + 1]])
            index[:, p] = own
            error += distance
        place = pa.array(np.cumsum(can) - 1, mask=~can)
        yield pa.RecordBatch.from_arrays([
            rows.column(ROW), pa.array([r.tobytes().hex() for r in index], pa.string()).take(place),
            pa.array(error).take(place)], names=[ROW, "code", "error"])


def learn_codebooks(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", parts: int = PARTS,
                    entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one int64[entries, dimensions] for each part.

    They start as the parts of the vectors of the smallest ids (ties by the
    vectors themselves; null ids are not taken) and follow ``rounds`` rounds
    of assignment to the nearest entry and replacement by the floored mean.
    The length is that of the first vector.  Without vectors: no entries.
    """
    find_code(df.sparkSession)
    source = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"),
                       F.col(f"`{vector}`").cast("array<double>").alias(VECTOR))
    first = source.mapInArrow(lambda b: _smallest(b, entries), "id long, whole array<long>").orderBy(
        "id", "whole").limit(entries).collect()
    dim = len(first[0].whole) if first else 0
    bounds = part_bounds(dim, parts)
    alike = [r.whole for r in first if len(r.whole) == dim]
    start = np.array(alike, np.int64).reshape(len(alike), dim)
    books = [start[:, a:b].copy() for a, b in zip(bounds, bounds[1:])]
    for _ in range(rounds if dim else 0):
        now = [Codebook(b) for b in books]
        partial = source.mapInArrow(lambda b, now=now: _sums(b, now, bounds),
                                    "part int, entry int, n long, sums array<long>")
        widest = max(b - a for a, b in zip(bounds, bounds[1:]))
        added = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(widest)])
        for r in added.collect():  # parts * entries rows
            for i in range(books[r.part].shape[1]):
                books[r.part][r.entry, i] = r[f"s{i}"] // r.n
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    """sha256 of all integers by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def encode(df: DataFrame, books: list[np.ndarray], vector: str = "embedding",
           keep: list[str] | None = None) -> DataFrame:
    """Kept columns (struct ``_row``) with ``code`` (two hex digits for each
    part) and ``error`` (squared distances to the entries, summed).

    Vectors that are null or hold null or non-finite components have no row.
    One of another length than the codebooks', or with an integer beyond
    ``LARGEST``, has a null code and error.
    """
    find_code(df.sparkSession)
    bounds = np.cumsum([0] + [b.shape[1] for b in books]).tolist()
    now = [Codebook(b) for b in books]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias(ROW),
                     F.col(f"`{vector}`").cast("array<double>").alias(VECTOR))
    kind = rows.schema[ROW].dataType.simpleString()
    return rows.mapInArrow(lambda b: _codes(b, now, bounds), f"{ROW} {kind}, code string, error long")


def decode(codes: list[str], books: list[np.ndarray]) -> np.ndarray:
    """The integer vectors that codes stand for."""
    index = np.array([list(bytes.fromhex(c)) for c in codes], np.int64).reshape(-1, len(books))
    return np.concatenate([b[index[:, p]] for p, b in enumerate(books)], axis=1)


def compress(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every vector
    that is there and finite; ``label_error`` adds up the errors of its label
    (nulls are one label).  Repeated rows are rows of their own; see
    :func:`learn_codebooks` and :func:`encode` for odd vectors."""
    books = learn_codebooks(df, vector, vec_id, parts, entries, rounds)
    named = df.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"),
                      F.col(f"`{vector}`").alias("vector"))
    done = cut(encode(named, books, "vector", ["id", "label"]).select(f"{ROW}.id", f"{ROW}.label", "code", "error"))
    # Grouped by two keys, so that the join on the label has an exchange of its
    # own on both sides and a label with very many rows is split at run time.
    sums = done.groupBy(F.col("label").alias("of"), F.isnull("label").alias("none")).agg(
        F.sum("error").alias("label_error"))
    return done.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(vec_id), "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
