"""Removal of word sequences that stand more than once in a corpus.

A window is ``width`` consecutive words of one document.  A window repeats if
its words also start anywhere else, in the same document or another; the words
that repeated windows cover are removed.

1. **Super-k-mers.**  Each window has a minimiser: the smallest hash of the
   ``MINIMISER`` words long runs inside it.  Equal windows have equal
   minimisers, and neighbouring windows mostly share one, so consecutive
   windows with one minimiser travel together, as one packed string, to the
   bucket of that minimiser.  The string holds the 64-bit hash of each window
   (packing the words themselves would cost three times the shuffle), so two
   windows count as equal when these hashes are.
2. **Buckets.**  Rows are sorted by minimiser within a partition and streamed;
   sorting the windows of a run of buckets counts them exactly.
3. Intervals of repeated windows go back to their documents.

**Hot content.**  A passage in a third of all documents would send a third of
all rows to its buckets.  A first look at a bounded sample of documents finds
windows that are that common.  They are known to repeat, so tasks mark them
where they are and send nothing.  Minimisers that stay common without them
(a common line in ever different surroundings) are split into sub-buckets by
window hash; equal windows still meet.  The sample changes the work, never
the result.  How finely a bucket is split follows the share that the sample
shows and the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import ROW, TEXT, cut, drop
from postcluster.llm.words import ASCII_SPACE, mix64, run_hashes, scan, segment_sums, slices

WIDTH = 35
MINIMISER = 6
#: Windows in one packed string at most.
STRING_WINDOWS = 64
#: A row's place is its first window and the number of its windows in one number.
COUNT = 1 << 31
#: Documents looked at for hot content, and what makes it hot there.
SAMPLE_DOCS = 4000
HOT_COUNT = 8
MAX_HOT_WINDOWS, MAX_HOT_BUCKETS = 100_000, 10_000
#: Packed bytes that a bucket task sorts at a time, and that a sub-bucket should have.
SORT_BYTES = 24 << 20
SUB_BYTES = 4 << 20

def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive entries."""
    size, low = 1, values
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:len(values) - width + 1], low[width - size:])


class Windows:
    """The windows of a slice of texts."""

    def __init__(self, texts: pa.Array, width: int):
        words = scan(texts)
        minimiser = min(MINIMISER, width)
        hashes = words.hashes()
        whole = run_hashes(hashes, width)
        n = np.maximum(words.counts - width + 1, 0)  # windows of each text
        self.text = np.repeat(np.arange(len(n)), n)
        skip = np.repeat(np.cumsum(n) - n, n)
        self.start = np.arange(len(self.text)) - skip  # word position in its text
        at = self.start + words.first[:-1][self.text]
        self.hash = whole[at]
        if len(whole):
            self.bucket = sliding_min(run_hashes(hashes, minimiser), width - minimiser + 1)[at]
        else:
            self.bucket = whole

    def take(self, which: np.ndarray) -> None:
        self.text, self.start = self.text[which], self.start[which]
        self.hash, self.bucket = self.hash[which], self.bucket[which]

    def runs(self, most: int, by_bucket: bool) -> np.ndarray:
        """First window of each run of consecutive windows."""
        n = len(self.start)
        new = np.ones(n, bool)
        if n:
            new[1:] = (np.diff(self.text) != 0) | (np.diff(self.start) != 1)
            if by_bucket:
                new[1:] |= self.bucket[1:] != self.bucket[:-1]
            first = np.flatnonzero(new)
            inside = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
            new |= inside % most == 0
        return np.flatnonzero(new)


class Hot:
    """Windows known to repeat, and buckets to split, with the number of parts."""

    def __init__(self, windows: list[tuple[int, int]], buckets: list[tuple[int, int]]):
        pairs = np.array(windows, np.int64).reshape(-1, 2).view(np.uint64)
        order = np.argsort(pairs[:, 0])
        self.hash, self.of = pairs[order, 0], pairs[order, 1]
        split = np.array(buckets, np.int64).reshape(-1, 2).view(np.uint64)
        order = np.argsort(split[:, 0])
        self.buckets, self.parts = split[order, 0], split[order, 1]

    def repeats(self, w: Windows) -> np.ndarray:
        if not len(self.hash):
            return np.zeros(len(w.hash), bool)
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        return (self.hash[at] == w.hash) & (self.of[at] == w.bucket)

    def split(self, w: Windows) -> None:
        if len(self.buckets):
            at = np.minimum(np.searchsorted(self.buckets, w.bucket), len(self.buckets) - 1)
            hot = np.flatnonzero(self.buckets[at] == w.bucket)
            with np.errstate(over="ignore"):
                w.bucket[hot] = mix64(w.bucket[hot] + mix64(w.hash[hot]) % self.parts[at[hot]] + np.uint64(1))


def _binary(packed: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def super_kmers(batches: Iterator[pa.RecordBatch], width: int, hot: Hot) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, row key, place, packed string) of ``_row, _text``.
    An empty string says that its windows are known to repeat."""
    for batch in batches:
        for part in slices(batch, TEXT):
            w = Windows(part.column(TEXT), width)
            known = hot.repeats(w)
            marked = Windows.__new__(Windows)
            vars(marked).update({k: v[known] for k, v in vars(w).items()})
            w.take(~known)
            hot.split(w)
            for these, packs in ((w, True), (marked, False)):
                if not len(these.start):
                    continue
                first = these.runs(STRING_WINDOWS if packs else 1 << 30, packs)
                size = np.diff(np.append(first, len(these.start)))
                if packs:
                    packed = _binary(np.ascontiguousarray(these.hash).view(np.uint8), np.cumsum(size) * 8)
                    bucket = these.bucket[first]
                else:  # any bucket will do: spread them
                    packed = _binary(np.zeros(0, np.uint8), np.zeros(len(first), np.int64))
                    bucket = mix64(these.hash[first] + these.text[first].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket.view(np.int64)), part.column(ROW).take(pa.array(these.text[first])),
                    pa.array(these.start[first] * COUNT + size), packed,
                ], names=["bucket", ROW, "place", "packed"])


def _repeated(rows: pa.Table, width: int) -> pa.RecordBatch:
    """Intervals of the repeated windows of whole buckets, sorted by bucket."""
    rows = rows.combine_chunks()
    bucket = rows.column("bucket").to_numpy()
    start, n = np.divmod(rows.column("place").to_numpy(), COUNT)
    packed = rows.column("packed").combine_chunks()
    packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
    marked = packed.is_valid().to_numpy(zero_copy_only=False) & (pa.compute.binary_length(packed).to_numpy() == 0)
    sent = np.where(marked, 0, n)
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
    codes = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].copy().view(np.uint64)
    row = np.repeat(np.arange(len(n)), sent)
    group = np.cumsum(np.concatenate([[0], bucket[1:] != bucket[:-1]]))[row]
    order = np.lexsort((codes, group))
    same = (codes[order][1:] == codes[order][:-1]) & (group[order][1:] == group[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.flatnonzero(twice)
    inside = hit - (np.cumsum(sent) - sent)[row[hit]]
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit))[:len(first)] - 1
    at = np.concatenate([row[hit[first]], np.flatnonzero(marked)]).astype(np.int64)
    low = np.concatenate([inside[first] + start[row[hit[first]]], start[marked]])
    high = np.concatenate([inside[last] + start[row[hit[first]]], start[marked] + n[marked] - 1]) + width
    key = rows.column(ROW).combine_chunks().take(pa.array(at))
    key = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
    return pa.RecordBatch.from_arrays([key, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                                      names=[ROW, "low", "high"])


def count_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by bucket; whole buckets are counted together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.column("packed").nbytes
        begins, ends = held[0].column("bucket")[0], batch.column("bucket")[-1]
        if size >= SORT_BYTES and begins != ends:  # a bucket that goes on is only gathered
            rows = pa.Table.from_batches(held)
            bucket = rows.column("bucket").to_numpy()
            whole = int(np.searchsorted(bucket, bucket[-1]))  # the last may go on
            if whole:
                yield _repeated(rows.slice(0, whole), width)
                rows = rows.slice(whole)
            held, size = rows.to_batches(), rows.column("packed").nbytes
    if held:
        yield _repeated(pa.Table.from_batches(held), width)


def find_hot(keyed: DataFrame, width: int) -> Hot:
    """Common windows and buckets of a bounded sample (see the module text)."""
    total = keyed.count()
    part = max(1, total // SAMPLE_DOCS)
    sample = keyed.where(F.pmod(F.xxhash64(ROW), F.lit(part)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, TEXT):
                w = Windows(piece.column(TEXT), width)
                pair = np.stack([w.hash, w.bucket], axis=1).view(np.int64)
                pair, count = np.unique(pair, axis=0, return_counts=True) if len(pair) else (pair, np.zeros(0, int))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(count.astype(np.int64))],
                    names=["hash", "bucket", "n"])

    counts = cut(sample.mapInArrow(run, "hash long, bucket long, n long")
                 .groupBy("hash", "bucket").agg(F.sum("n").alias("n")))
    windows = counts.where(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "hash").limit(MAX_HOT_WINDOWS).collect()
    rest = counts.where(F.col("n") < HOT_COUNT).groupBy("bucket").agg(F.sum("n").alias("n"))
    buckets = rest.where(F.col("n") >= HOT_COUNT * MINIMISER).orderBy(F.desc("n"), "bucket").limit(
        MAX_HOT_BUCKETS).collect()
    drop(counts)
    return Hot([(r.hash, r.bucket) for r in windows], [(r.bucket, 1 + r.n * part * 8 // SUB_BYTES) for r in buckets])


def remove_repeats(df: DataFrame, width: int = WIDTH, text: str = "text", id_col: str = "doc_id",
                   keep: list[str] | None = None, as_written: bool = False) -> DataFrame:
    """Kept columns (struct ``_row``) with ``n_words``, ``n_removed`` and
    ``kept``: the words that stay, joined by one space.  With ``as_written``,
    a text that loses nothing is kept as it is, white space and null included.

    A row is known by its id and a hash of its text, so null and repeated ids
    do no harm; a repeated row repeats all its windows.  Null, empty and short
    texts (below ``width`` words) have no window and lose nothing.
    """
    th = F.xxhash64(F.col(f"`{text}`").cast("string"))
    key = F.struct(F.col(f"`{id_col}`").alias("id"), th.alias("th"))
    kept_cols = [F.col(f"`{c}`") for c in (keep or df.columns)]
    keyed = df.select(key.alias(ROW), F.col(f"`{text}`").cast("string").alias(TEXT))
    hot = df.sparkSession.sparkContext.broadcast(find_hot(keyed, width))
    id_type = keyed.schema[ROW].dataType.simpleString()
    rows = keyed.mapInArrow(lambda b: super_kmers(b, width, hot.value),
                            f"bucket long, {ROW} {id_type}, place long, packed binary")
    sorted_rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    spans = sorted_rows.mapInArrow(lambda b: count_windows(b, width), f"{ROW} {id_type}, low int, high int")
    per_row = spans.groupBy(f"{ROW}.id", f"{ROW}.th").agg(
        F.collect_list(F.struct("low", "high")).alias("spans"))  # at most one a word
    texts = df.select(F.struct(*kept_cols).alias(ROW), F.col(f"`{id_col}`").alias("_id"), th.alias("_th"),
                      F.col(f"`{text}`").cast("string").alias(TEXT))
    joined = texts.join(per_row, F.col("_id").eqNullSafe(F.col("id")) & F.col("_th").eqNullSafe(F.col("th")), "left")
    packed = joined.select(ROW, TEXT, F.col("spans.low").alias("low"), F.col("spans.high").alias("high"))
    kind = packed.schema[ROW].dataType.simpleString()
    return packed.mapInArrow(lambda b: _cut_out(b, as_written), f"{ROW} {kind}, n_words long, n_removed long, kept string")


_SPACES = bytes(0x20 if b in ASCII_SPACE else b for b in range(256))


def _cut_out(batches: Iterator[pa.RecordBatch], as_written: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, TEXT):
            words = scan(part.column(TEXT))
            delta = np.zeros(len(words) + 1, np.int64)
            ends = []
            for name in ("low", "high"):
                lists = part.column(name)
                owner = pa.compute.list_parent_indices(lists).to_numpy()
                ends.append(words.first[owner] + pa.compute.list_flatten(lists).to_numpy(zero_copy_only=False))
            np.add.at(delta, ends[0].astype(np.int64), 1)
            np.add.at(delta, ends[1].astype(np.int64), -1)
            gone = np.cumsum(delta[:-1]) > 0
            removed = segment_sums(gone.astype(np.int64), words.first)
            kept = []
            for i, text in enumerate(part.column(TEXT).to_pylist()):
                if as_written and not removed[i]:
                    kept.append(text)
                    continue
                found = (text or "").encode().translate(_SPACES).split()
                if removed[i]:
                    stays = ~gone[words.first[i]:words.first[i + 1]]
                    found = [found[k] for k in np.flatnonzero(stays)]
                kept.append(b" ".join(found).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column(ROW), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], names=[ROW, "n_words", "n_removed", "kept"])
