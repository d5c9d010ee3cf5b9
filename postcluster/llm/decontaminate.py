"""Benchmark passages in documents, edits included.

Word sequences are embedded by the CGK random walk: a pointer walks along the
words, and at every step a random bit, fixed by the step and the word under
the pointer, says whether it moves on.  What the pointer sees is the embedded
string.  Sequences at a small edit distance fall back into step after an edit,
so their embeddings differ in few places: edit distance becomes Hamming
distance.

1. **Windows** are as long as the item: for each size of an item, a document's
   window of so many words is walked along as the item is, and a walk that
   comes to the end of its window sees padding.
2. **Bit-sampling LSH**: each of ``repeats(size)`` independent walks keeps a
   few random places of the whole embedding (``sampled``); windows equal to
   an item there are candidates.  Longer items take more edits and get more
   repeats and fewer places.  ``tests/llm/test_decontaminate.py`` measures the
   recall for each size.
3. **Where windows start.**  An edit takes away two of an item's pairs of
   neighbouring words at most, so ``size - 1 - 2 * edits`` of them must stand
   in the window.  Windows that hold too few cannot be within the distance
   and are not walked; no window is lost by this.
4. **Verification**: the exact word edit distance between the whole item and
   the best stretch of the document around the candidate, in a window of the
   item's size and the edits it may have (a bit-parallel dynamic program).
   A leak has edits in at most ``1 - SIMILARITY`` of the item's words.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  The benchmark is
taken in blocks of about ``BLOCK_WORDS`` words; each block is shared with all
tasks in a job of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import ROW, cut, drop, map_texts
from postcluster.llm.words import mix64, scan, seeds64

SIMILARITY = 0.8
#: Steps of a walk for each word of the window.
STEPS_EACH = 1.2
BLOCK_WORDS = 1_000_000
#: Windows that walk together, all their repeats counted.
WALK_BLOCK = 1 << 16
#: Word pairs are first looked up in a table of this many bits.
TABLE_BITS = 20

_WALKS = seeds64(4096, 401)
_PAIR, _STEP, _PADDING = seeds64(3, 402)


def repeats(size: int) -> int:
    """Independent walks for items of a size."""
    return 14 if size <= 24 else 20 if size <= 48 else 28


def sampled(size: int) -> int:
    """Places that a walk keeps."""
    return 3 if size <= 64 else 2 if size <= 256 else 1


def steps(size: int) -> int:
    return max(int(STEPS_EACH * size), sampled(size))


def places(size: int, repeat: int) -> np.ndarray:
    """The random steps that a repeat keeps."""
    rng = np.random.default_rng([403, size, repeat])
    return np.sort(rng.choice(steps(size), sampled(size), replace=False))


def walk_keys(words: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """uint64[repeats, windows]: the key of each window of ``words`` from
    ``start`` to ``end``, in each repeat of the walk for items of ``size``."""
    many, n = repeats(size), len(start)
    keys = np.empty((many, n), np.uint64)
    kept = np.zeros((many, steps(size)), bool)
    for r in range(many):
        kept[r, places(size, r)] = True
    for a in range(0, n, max(1, WALK_BLOCK // many)):
        part = slice(a, a + max(1, WALK_BLOCK // many))
        at = np.repeat(start[part][None], many, axis=0)
        stop = end[part][None]
        key = np.broadcast_to((np.arange(many, dtype=np.uint64) * _STEP + np.uint64(size))[:, None], at.shape).copy()
        with np.errstate(over="ignore"):
            for step in range(steps(size)):
                seen = np.where(at < stop, words[np.minimum(at, len(words) - 1)], _PADDING)
                here = kept[:, step]
                if here.any():
                    key[here] = mix64(key[here] * _STEP + seen[here])
                bits = (seen ^ _WALKS[:many, None]) * _WALKS[64 + step % 4000]
                at = np.minimum(at + (bits >> np.uint64(63)).astype(np.int64), stop)
        keys[:, part] = key
    return keys


def myers(item: list[int], text: list[int]) -> list[int]:
    """For every end in ``text``: the least edit distance between ``item`` and
    a stretch that ends there (Myers' bit-parallel program, any length)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    match: dict[int, int] = {}
    for i, w in enumerate(item):
        match[w] = match.get(w, 0) | 1 << i
    up, down, score, out = full, 0, m, []
    for w in text:
        eq = match.get(w, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        h_up = down | (full & ~(d | up))
        h_down = up & d
        score += bool(h_up & top) - bool(h_down & top)
        h_up = (h_up << 1) & full
        h_down = (h_down << 1) & full
        up = h_down | (full & ~(x | h_up))
        down = h_up & x
        out.append(score)
    return out


class Size:
    """The items of one size: what must stand in a window, and their keys."""

    def __init__(self, size: int, most: int, items: np.ndarray, start: np.ndarray, hashes: np.ndarray, pairs: np.ndarray):
        self.size, self.most = size, most
        self.run = min(2, size)  # single words count for items of one word
        self.need = size - self.run + 1 - self.run * most
        self.pairs = pairs       # which of the block's word pairs are in these items
        key = walk_keys(hashes, start, start + size, size)
        self.keys = []
        for row in key:
            order = np.argsort(row, kind="stable")
            self.keys.append((row[order], items[order]))

    def starts(self, hit: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Words at which a window may begin, from the places ``hit`` (and
        their texts) of this size's word pairs."""
        if self.need <= 0:
            return np.arange(first[-1])
        if len(hit) < self.need:
            return np.zeros(0, np.int64)
        last = self.need - 1
        near = (hit[last:] - hit[:len(hit) - last] <= self.size + self.most - self.run) & (text[last:] == text[:len(hit) - last])
        begin = hit[:len(hit) - last][near]
        low = np.maximum(begin - (self.run + 1) * self.most, first[text[:len(hit) - last][near]])
        edge = np.zeros(first[-1] + 1, np.int32)
        np.add.at(edge, low, 1)
        np.add.at(edge, begin + 1, -1)
        return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of each word with the next one (at the end: with padding)."""
    with np.errstate(over="ignore"):
        return mix64(hashes * _PAIR + np.append(hashes[1:], _PADDING))


class Finder:
    """The keys of a block of items, and what verifies their matches."""

    def __init__(self, items: list[tuple[int, str]], similarity: float):
        words = scan(pa.array([t for _, t in items], pa.string()), lower=True)
        hashes, size = words.hashes(), words.counts
        self.ids = [i for i, _ in items]
        self.words = [hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        self.sizes = size
        self.distinct = np.array([len(set(w)) for w in self.words], np.int64)
        self.most = [int((1 - similarity) * len(w) + 1e-9) for w in self.words]
        owner = np.repeat(np.arange(len(items)), size)
        self.item_words = np.unique(self._word_keys(owner, hashes))
        # Pairs of neighbouring words inside an item; of an item of one word, the word.
        inside = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
        single = size[owner] == 1
        pair = np.where(single, mix64(hashes), pair_hashes(hashes) if len(hashes) else hashes)
        known = inside | single
        self.pairs, number = np.unique(pair[known], return_inverse=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._low(self.pairs)] = True
        self.by_size = []
        for m in np.unique(size[size > 0]).tolist():
            mine = np.flatnonzero(size == m)
            has = np.zeros(len(self.pairs), bool)
            has[number[size[owner[known]] == m]] = True
            self.by_size.append(Size(m, self.most[mine[0]], mine, words.first[:-1][mine], hashes, has))

    @staticmethod
    def _low(keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)

    def _hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the block's word pairs in a document, and which they are."""
        at = np.flatnonzero(self.table[self._low(keys)])
        which = np.minimum(np.searchsorted(self.pairs, keys[at]), max(len(self.pairs) - 1, 0))
        true = self.pairs[which] == keys[at] if len(self.pairs) else np.zeros(0, bool)
        return at[true], which[true]

    def candidates(self, words, hashes: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, start) of windows that an item's key meets."""
        found = [np.zeros((0, 3), np.int64)]
        pair_at, pair = self._hits(pair_hashes(hashes))
        word_at, word = self._hits(mix64(hashes)) if any(s.run == 1 for s in self.by_size) else (pair_at, pair)
        for size in self.by_size:
            at, which = (word_at, word) if size.run == 1 else (pair_at, pair)
            hit = at[size.pairs[which]]
            text = np.searchsorted(words.first, hit, side="right") - 1
            start = size.starts(hit, text, words.first)
            if not len(start):
                continue
            of = np.searchsorted(words.first, start, side="right") - 1
            keys = walk_keys(hashes, start, np.minimum(start + size.size, words.first[1:][of]), size.size)
            for row, (key, item) in zip(keys, size.keys):
                low = np.searchsorted(key, row)
                count = np.searchsorted(key, row, side="right") - low
                k = np.repeat(np.arange(len(row)), count)
                place = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(k))
                found.append(np.stack([of[k], item[place], start[k]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, texts: pa.Array) -> list[list[dict]]:
        """Per text: its leaks, the best one for each item."""
        words = scan(texts, lower=True)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not len(words):
            return out
        hashes, last = words.hashes(), None
        text, item, low, high = self._stretches(hashes, self.candidates(words, hashes), words.first)
        for k in np.flatnonzero(self._plausible(hashes, item, low, high)).tolist():
            scores = myers(self.words[item[k]], hashes[low[k]:high[k]].tolist())
            least = min(scores)
            if least <= self.most[item[k]]:
                of_text = out[text[k]]
                leak = {"item_id": self.ids[item[k]], "distance": least,
                        "end_word": int(low[k] + scores.index(least) + 1 - words.first[text[k]])}
                if of_text and last == (text[k], item[k]):  # another stretch of the same text and item
                    if least < of_text[-1]["distance"]:
                        of_text[-1] = leak
                else:
                    of_text.append(leak)
                last = (text[k], item[k])
        return out

    def _stretches(self, hashes: np.ndarray, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where the items of candidate rows (text, item, start) can be, with
        the edits they may have; overlapping stretches of an item are one."""
        text, item, start = rows.T
        size, most = self.sizes[item], np.array(self.most, np.int64)[item]
        low = np.maximum(start - most, first[text])
        high = np.minimum(start + size + most, first[text + 1])
        some = low < high  # a chance match across the end of a text may leave none
        text, item, low, high = text[some], item[some], low[some], high[some]
        new = np.ones(len(low), bool)
        new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (low[1:] > high[:-1])
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(low))[:len(at)] - 1
        return text[at], item[at], low[at], high[end]

    def _plausible(self, hashes: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """False where a stretch lacks more of the item's different words than
        the item may have edits: an edit takes away one word at most."""
        length = high - low
        owner = np.repeat(np.arange(len(item)), length)
        if not len(owner):
            return np.zeros(len(item), bool)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + low[owner]
        key = self._word_keys(item[owner], hashes[at])
        place = np.minimum(np.searchsorted(self.item_words, key), len(self.item_words) - 1)
        have = self.item_words[place] == key
        pairs = np.unique(owner[have] * np.int64(len(self.item_words)) + place[have])
        found = np.bincount(pairs // len(self.item_words), minlength=len(item))
        return found + np.array(self.most, np.int64)[item] >= self.distinct[item]

    @staticmethod
    def _word_keys(item: np.ndarray, words: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(words + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


LEAKS = "array<struct<item_id:long,distance:int,end_word:int>>"
_ARROW_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end_word", pa.int32())]))


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[Iterator[list]]:
    """The blocks of the benchmark (dealt by a hash), each an iterator that
    brings its items when it is asked."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"),
                             F.col(f"`{text}`").cast("string").alias("text")).where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // (6 * block_words)
    if blocks > 1:
        items = cut(items.withColumn("block", F.pmod(F.xxhash64("text", "id"), F.lit(blocks))))

    def bring(b: int) -> Iterator[list]:
        rows = (items.where(F.col("block") == b) if blocks > 1 else items).select("id", "text").collect()
        yield sorted(((r.id, r.text) for r in rows), key=repr)

    for b in range(blocks):
        yield bring(b)


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
               item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """Kept columns (struct ``_row``) with ``leaks``: an array of (item_id,
    distance, end_word), one for each benchmark item that a text holds.

    Null and empty texts hold nothing; null and blank items are nowhere; items
    with equal texts, and repeated rows, are each answered.  Items below five
    words tolerate no edit at a similarity of 0.8.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias("row"),
                     F.col(f"`{text}`").cast("string").alias("text"))

    def one(source: DataFrame, items: list, columns: list[str]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(Finder(items, similarity))

        def make():
            finder = shared.value
            return lambda texts: [pa.array(finder.leaks(texts), _ARROW_LEAKS)]

        return map_texts(source, "text", columns, f"leaks {LEAKS}", make)

    blocks = list(benchmark_blocks(benchmark, item_id, item_text, block_words))
    if len(blocks) == 1:
        return one(rows, next(blocks[0]), ["row"]).select(F.col(f"{ROW}.row").alias(ROW), "leaks")
    # One job for each block, which writes the few rows with leaks.
    rows = cut(rows.withColumn("at", F.monotonically_increasing_id()))
    parts = [cut(one(rows, next(block), ["at"]).where(F.size("leaks") > 0).select(f"{ROW}.at", "leaks")) for block in blocks]
    found = cut(reduce(DataFrame.union, parts).groupBy("at").agg(F.flatten(F.collect_list("leaks")).alias("leaks")))
    drop(*parts)
    return rows.join(found, "at", "left").select(
        F.col("row").alias(ROW), F.coalesce("leaks", F.array().cast(LEAKS)).alias("leaks"))
