"""Quality scores from random-indexing word vectors and a small network.

1. **Word vectors** by random indexing, over all documents: every word has a
   fixed sparse random signature (``SIGNS`` entries of +1 or -1), and a word's
   vector is the sum of the signatures of the words around its occurrences.
   Words are hashed to ``BUCKETS`` rows, so the table has one fixed size
   whatever the corpus.  Each task sums its own part; Spark adds the parts row
   block by row block.
2. **Pooling**: a document is the mean and the spread of its words' unit
   vectors, with the share of words that repeat one of the four before them.
3. **Network**: two layers in numpy, fitted on a bounded sample of labelled
   rows; a temperature, fitted on rows kept back from the weights, calibrates
   its probabilities.

A word is a run of letters and digits or a run of other marks; case stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import TEXT, cut, drop, map_texts
from postcluster.llm.learning import FIT_ROWS, fit_rows
from postcluster.llm.words import byte_classes, scan, segment_sums, seeds64, slices

BUCKETS = 1 << 13
DIM = 32
SIGNS = 2
REACH = 2              # words on each side that count as surroundings
BLOCK = 256            # rows of the table that travel together
PARTITIONS = BUCKETS // BLOCK
HIDDEN = 24
STEPS = 600

#: Runs of letters and digits (and bytes beyond ASCII), and runs of marks.
MARKS = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
TOKENS = byte_classes(splitting=MARKS)


def _signatures() -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's signature has its entries, and their signs."""
    draw = seeds64(BUCKETS * SIGNS, 77).reshape(BUCKETS, SIGNS)
    return ((draw >> np.uint64(8)) % np.uint64(DIM)).astype(np.int64), np.where(draw & np.uint64(2), 1.0, -1.0)


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and where each text's words begin."""
    words = scan(texts, TOKENS)
    return (words.hashes() & np.uint64(BUCKETS - 1)).astype(np.int64), words.first


def add_surroundings(table: np.ndarray, word: np.ndarray, first: np.ndarray) -> None:
    """Add the signatures around every word of some texts to the table."""
    at, sign = _signatures()
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    flat = table.reshape(-1)
    for gap in range(1, REACH + 1):
        same = text[gap:] == text[:-gap]
        left, right = word[:-gap][same], word[gap:][same]
        for a, b in ((left, right), (right, left)):
            for s in range(SIGNS):
                flat += np.bincount(a * DIM + at[b, s], weights=sign[b, s], minlength=flat.size)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, float32[BUCKETS, DIM], from all documents.

    A task sends at most one table (``BUCKETS * DIM`` numbers); the sums that
    reach the driver are one table.
    """
    source = docs.select(F.col(f"`{text}`").cast("string").alias(TEXT))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, DIM))
        for batch in batches:
            for part in slices(batch, TEXT, 2 << 20):
                add_surroundings(table, *buckets(part.column(TEXT)))
        used = [b for b in range(PARTITIONS) if table[b * BLOCK:(b + 1) * BLOCK].any()]
        rows = [table[b * BLOCK:(b + 1) * BLOCK].astype(np.float32).tobytes() for b in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(rows, pa.binary())],
                                         names=["block", "part"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block not in sums:
                    sums[block] = np.zeros(BLOCK * DIM)
                sums[block] += np.frombuffer(part, np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.astype(np.float32).tobytes() for s in sums.values()],
                                                        pa.binary())], names=["block", "part"])

    schema = "block int, part binary"
    parts = source.mapInArrow(partial, schema).repartition("block").mapInArrow(total, schema)
    table = np.zeros((BUCKETS, DIM), np.float32)
    for row in parts.collect():  # one table
        table[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.part, np.float32).reshape(BLOCK, DIM)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norm > 0, norm, 1)


INPUTS = 2 * DIM + 2


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of each text's word vectors, the share of words that
    repeat one of the four before, and a mark for texts without words."""
    word, first = buckets(texts)
    n = np.diff(first)
    out = np.zeros((len(n), INPUTS), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        rows = vectors[word]
        size = n[full][:, None].astype(np.float32)
        mean = np.add.reduceat(rows, first[full], axis=0) / size
        np.square(rows, out=rows)
        square = np.add.reduceat(rows, first[full], axis=0) / size
        out[full, :DIM] = mean
        out[full, DIM:2 * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
        text = np.repeat(np.arange(len(n)), n)
        again = np.zeros(len(word), bool)
        for gap in range(1, 5):
            again[gap:] |= (word[gap:] == word[:-gap]) & (text[gap:] == text[:-gap])
        out[:, -2] = segment_sums(again.astype(np.float64), first) / np.maximum(n, 1)
    out[:, -1] = n == 0
    return out


@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.shift) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray) -> Network:
    """Two layers by Adam on four fifths of the rows; the temperature that
    gives the last fifth the lowest log loss."""
    order = np.random.default_rng(5).permutation(len(y))
    keep = order[: max(1, len(y) // 5)]
    use = order[len(keep):] if len(y) > len(keep) else order
    shift, scale = x[use].mean(0), x[use].std(0) + 1e-3
    rng = np.random.default_rng(6)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    share = np.clip(y[use].mean(), 0.02, 0.98)
    p[3][0] = np.log(share / (1 - share))
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    z = (x - shift) / scale
    for step in range(1, STEPS + 1):
        rows = use if len(use) <= 512 else use[rng.integers(0, len(use), 512)]
        hidden = np.tanh(z[rows] @ p[0] + p[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - y[rows]) / len(rows)
        back = np.outer(error, p[2]) * (1 - hidden ** 2)
        grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ error + 1e-4 * p[2], np.array([error.sum()])]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] -= 0.01 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]))

    def loss(t: float) -> float:
        s = np.clip(net.logits(x[keep]) / t, -30, 30)
        return float(np.mean(np.log1p(np.exp(-s)) * y[keep] + np.log1p(np.exp(s)) * (1 - y[keep])))

    net.temperature = min(np.geomspace(0.25, 8, 60).tolist(), key=loss)
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:  # nothing to learn from: all rows stay
            return np.full(len(texts), 0.5)
        return self.network.scores(pool(texts, self.vectors))


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS) -> Model:
    """Word vectors from all documents; the network from at most ``bound``
    labelled rows.  Without rows of both labels, every score is 0.5."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = cut(fit_rows(docs, labels, "quality", bound))
    made = map_texts(rows, "text", ["y"], "x array<float>", lambda: lambda texts: [
        pa.array(list(pool(texts, shared.value)), pa.list_(pa.float32()))])
    found = made.select("_row.y", "x").collect()  # bound rows of INPUTS numbers
    drop(rows)
    found.sort(key=lambda r: (r.x, r.y))          # the fit does not depend on their order
    x = np.array([r.x for r in found], float).reshape(len(found), INPUTS)
    y = np.array([r.y for r in found], float)
    return Model(vectors, fit_network(x, y) if len(set(y)) == 2 else None)


def score_quality(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (struct ``_row``) with ``score`` (0 to 1, higher: better)
    and ``predicted`` (1 if the score is 0.3 or more) of each whole text.

    Null and empty texts are scored by the mark for texts without words.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def work(texts: pa.Array) -> list:
            score = model.scores(texts).astype(np.float64)
            return [pa.array(score), pa.array((score >= 0.3).astype(np.int32))]

        return work

    return map_texts(df, text, keep or df.columns, "score double, predicted int", make)
