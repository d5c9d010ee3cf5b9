"""Phrase collocations by prefix-free parsing.

1. **Parse.**  A text is a sequence of words and separators.  A place where
   the ``OVERLAP`` tokens that follow have a hash of 0 modulo ``MODULUS`` is a
   trigger; the text is cut into chunks from trigger to trigger, and a chunk
   reaches over the trigger's tokens at its end, so neighbours overlap by
   exactly those.  Where cuts fall depends on content alone: what stands in
   many documents gives the same chunks in all of them.  Spark counts the
   distinct chunks of each language: the dictionary, with the frequencies of
   the parse.
2. **Count.**  Phrases are counted inside distinct chunks, weighted by their
   frequency.  A phrase belongs to the chunk that holds its start before the
   overlap at the end (or anywhere, in a text's last chunk); it is never
   longer than the overlap and one word, so it lies in that chunk whole, and
   what overlaps is counted once.
3. **Levels.**  Phrases of k words are looked for only where both phrases of
   k - 1 words inside are frequent, by a bit filter of those (a false bit
   costs work, never a row).  Within a task they are told apart by exact word
   numbers, between tasks by the words themselves: counts are exact.
4. **Score.**  Every cut of a phrase is joined with the counts of its two
   parts; 38-digit decimals keep ``1000 * a * n`` and ``l * r`` exact.

**Scale.**  The texts are parsed once; all levels read the dictionary, which is
written and deleted.  Nothing is gathered by language but one top list, which
every task shortens first.  The filter is the only thing shared with all
tasks: at most ``MAX_FILTER_BITS`` bits, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postcluster.llm.frames import TEXT, cut, find_code
from postcluster.llm.words import Words, byte_classes, mix64, scan, seeds64, slices, strings
from postcluster.session import materialize

LONGEST = 5           # words of a phrase at most
LEAST = 100           # occurrences of a candidate at least
COVERED = 100         # % of a phrase's occurrences inside a longer one that make it part of that
TOP = 2000            # phrases of a language in the report
MODULUS = 16
#: Bits of a level's filter: this many for each frequent phrase, up to 128 MB.
BITS_EACH, MIN_FILTER_BITS, MAX_FILTER_BITS = 16, 1 << 16, 1 << 30
BLOCKS = 64           # pieces of a filter that are made at a time
#: Chunks are counted so many bytes at a time.
COUNT_BYTES = 8 << 20

#: Words and separators are tokens of two classes; a separator is written as a line feed.
SPLITTING = b".,;:!?\x0a\x0b\x0c\x0d"
TOKENS = byte_classes(b"\x20\x09", SPLITTING)
_SPLITS = np.isin(np.arange(256), list(SPLITTING))
_PLAIN = byte_classes(b"\x20")
_PLACES = seeds64(64, 1101)
_BREAK = np.uint64(0x0A0A0A0A0A0A0A0B)


# --- the parse ------------------------------------------------------------------

def parse(texts: pa.Array, overlap: int, modulus: int = MODULUS) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text, last, chunk) of every chunk of some texts; ``last`` marks the
    chunk that ends its text.  Tokens are joined by one space."""
    found = scan(texts, TOKENS, lower=True)
    text = np.repeat(np.arange(len(texts)), found.counts)
    breaks = _SPLITS[found.data[found.start]] if len(found) else np.zeros(0, bool)
    keep = np.ones(len(text), bool)  # of separators in a row one stays, and none before a text's first word
    keep[1:] = ~(breaks[1:] & (breaks[:-1] | (text[1:] != text[:-1])))
    keep[:1] = ~breaks[:1]
    text, breaks = text[keep], breaks[keep]
    words = Words(found.data, found.start[keep], found.end[keep],
                  np.searchsorted(text, np.arange(len(texts) + 1)), found.texts)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool), pa.array([], pa.string())
    hashes = np.where(breaks, _BREAK, words.hashes())
    # A trigger has its whole window inside its text; a text's first token always begins a chunk.
    with np.errstate(over="ignore"):
        window = np.zeros(n, np.uint64)
        for i in range(overlap):
            window[:n - i] += hashes[i:] * _PLACES[i]
    end = words.first[1:][text]
    trigger = (mix64(window) % np.uint64(modulus) == 0) & (np.arange(n) + overlap <= end)
    trigger[words.first[:-1][words.counts > 0]] = True
    first = np.flatnonzero(trigger)
    of = text[first]
    last = np.append(of[1:] != of[:-1], True)
    stop = np.where(last, end[first], np.append(first[1:], 0) + overlap)
    # One buffer of all tokens, each behind it a space; a separator is a line feed.
    length = np.where(breaks, 1, words.end - words.start)
    at = np.concatenate([[0], np.cumsum(length + 1)])
    plain = np.full(int(at[-1]), 0x20, np.uint8)
    letters = np.repeat(at[:-1], length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    plain[letters] = words.data[np.repeat(words.start, length) + letters - np.repeat(at[:-1], length)]
    plain[at[:-1][breaks]] = 0x0A
    return of, last, strings(plain, at[first], at[stop] - 1 - at[first]).cast(pa.string())


def dictionary(df: DataFrame, text: str, lang: str, overlap: int, modulus: int) -> DataFrame:
    """``lang, last, chunk, n``: the distinct chunks and how often each stands."""
    find_code(df.sparkSession)
    source = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias(TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, TEXT):
                of, last, chunk = parse(part.column(TEXT), overlap, modulus)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(of)), pa.array(last), chunk], names=["lang", "last", "chunk"])

    return source.mapInArrow(run, "lang string, last boolean, chunk string").groupBy("lang", "last", "chunk").agg(
        F.count("*").alias("n"))


# --- counting -------------------------------------------------------------------

class Chunks:
    """Word numbers (exact within the slice), hashes and counted starts of a
    slice of the dictionary."""

    def __init__(self, part: pa.RecordBatch, overlap: int):
        chunk = part.column("chunk")
        tokens = pc.split_pattern(chunk, " ")
        self.strings = tokens.flatten()
        coded = self.strings.dictionary_encode()
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.words = len(coded.dictionary)
        self.hash = word_hashes(coded.dictionary)[self.word]
        size = pc.list_value_length(tokens).to_numpy().astype(np.int64)
        self.chunk = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        inside = np.arange(len(self.word)) - first[self.chunk]
        last = part.column("last").to_numpy(zero_copy_only=False)
        breaks = coded.dictionary.index(pa.scalar("\n", pa.string())).as_py()
        stop = np.flatnonzero(self.word == breaks) if breaks >= 0 else np.zeros(0, np.int64)
        bounds = np.sort(np.concatenate([stop, first + size]))
        #: Where the piece that a token stands in ends.
        self.piece_end = bounds[np.searchsorted(bounds, np.arange(len(self.word)), side="right")] if len(self.word) else bounds
        counted = (last[self.chunk] | (inside < size[self.chunk] - overlap)) & (self.word != breaks)
        self.starts = np.flatnonzero(counted)
        self.n = part.column("n").to_numpy().astype(np.int64)
        langs = part.column("lang").dictionary_encode()
        self.lang = langs.indices.to_numpy().astype(np.int64)
        self.lang_hash = word_hashes(langs.dictionary)[self.lang]
        self.part = part

    def of_length(self, k: int, filter_: "Filter | None") -> np.ndarray:
        """Counted starts of phrases of k words that may be frequent."""
        at = self.starts[self.starts + k <= self.piece_end[self.starts]]
        if filter_ is not None:
            for i in (0, 1):
                at = at[filter_.holds(self.phrase_hash(at + i, k - 1))]
        return at

    def phrase_hash(self, at: np.ndarray, k: int) -> np.ndarray:
        return phrase_hashes(np.stack([self.hash[at + i] for i in range(k)], axis=1), self.lang_hash[self.chunk[at]])

    def count(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """``lang, phrase, n`` of the phrases that start at some places."""
        group, most = self.lang[self.chunk[at]], len(self.lang) + 1
        for i in range(k):
            if most * self.words >= 1 << 62:
                group = np.unique(group, return_inverse=True)[1]
                most = len(at) + 1
            group = group * self.words + self.word[at + i]
            most *= self.words
        _, one, which = np.unique(group, return_index=True, return_inverse=True)
        total = np.zeros(len(one), np.int64)
        np.add.at(total, which, self.n[self.chunk[at]])
        start = at[one]
        phrases = pc.binary_join_element_wise(*[self.strings.take(pa.array(start + i)) for i in range(k)], " ")
        return pa.RecordBatch.from_arrays(
            [self.part.column("lang").take(pa.array(self.chunk[start])), phrases, pa.array(total)],
            names=["lang", "phrase", "n"])


def word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each string without spaces (it need not be unique)."""
    found = scan(words, _PLAIN)
    out = np.zeros(len(words), np.uint64)
    out[found.counts > 0] = found.hashes()
    return out


def phrase_hashes(words: np.ndarray, lang: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((words * _PLACES[8:8 + words.shape[1]]).sum(axis=1, dtype=np.uint64) + lang * _PLACES[63])


class Filter:
    """Bits at the hashes of the frequent phrases of one length."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.bits = bits
        size = bits // 8 // BLOCKS
        self.data = np.frombuffer(b"".join(blocks.get(b, bytes(size)) for b in range(BLOCKS)), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes % np.uint64(self.bits)
        return (self.data[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def build_filter(frequent: DataFrame, k: int, count: int) -> Filter:
    """The filter of the phrases ``lang, phrase`` of k words, a block a group."""
    bits = MIN_FILTER_BITS
    while bits < min(count * BITS_EACH, MAX_FILTER_BITS):
        bits *= 2
    size = bits // 8 // BLOCKS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = pc.split_pattern(batch.column("phrase"), " ").flatten()
                bit = phrase_hashes(word_hashes(words).reshape(-1, k), word_hashes(batch.column("lang"))) % np.uint64(bits)
                byte = (bit >> np.uint64(3)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((byte // size).astype(np.int32)),
                     pa.array((byte % size * 8 + (bit & np.uint64(7)).astype(np.int64)).astype(np.int32))],
                    names=["block", "bit"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bit = batch.column("block").to_numpy(), batch.column("bit").to_numpy()
            for b in np.unique(block).tolist():
                own = bit[block == b]
                np.bitwise_or.at(made.setdefault(b, np.zeros(size, np.uint8)), own >> 3,
                                 np.left_shift(1, own & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(made), pa.int32()), pa.array([m.tobytes() for m in made.values()], pa.binary())],
            names=["block", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(places, "block int, bit int").distinct().repartition(
        "block").mapInArrow(blocks, "block int, bits binary").collect()
    return Filter(bits, {r.block: r.bits for r in rows})


def count_phrases(chunks: DataFrame, k: int, overlap: int, filter_: Filter | None) -> DataFrame:
    """``lang, phrase, n`` of all phrases of k words that may be frequent, with
    how often they stand.  For single words, a null phrase has their number."""
    shared = chunks.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "chunk", COUNT_BYTES):
                found = Chunks(part, overlap)
                made = found.count(found.of_length(k, shared.value), k)
                yield made
                if k == 1 and made.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [made.column("lang"), pa.nulls(made.num_rows, pa.string()), made.column("n")], names=made.schema.names)

    return chunks.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                     longest: int = LONGEST, modulus: int = MODULUS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, a`` of all phrases of up to ``longest`` words that
    stand ``least`` times or more; and ``lang, n``, the languages' words."""
    overlap = max(longest - 1, 1)
    chunks = materialize(dictionary(df, text, lang, overlap, modulus), "chunks")
    levels, totals, filter_ = [], None, None
    for k in range(1, longest + 1):
        counted = count_phrases(chunks.frame, k, overlap, filter_)
        enough = F.col("n") >= least
        found = cut(counted.where(enough | F.col("phrase").isNull()) if k == 1 else counted.where(enough))
        if k == 1:
            totals = found.where("phrase IS NULL").select("lang", "n")
            found_words = found.where("phrase IS NOT NULL")
        levels.append((found_words if k == 1 else found).select(
            "lang", "phrase", F.lit(k).alias("k"), F.col("n").alias("a")))
        many = levels[-1].count()
        if not many:
            break
        if k < longest:
            filter_ = build_filter(levels[-1], k, many)
    chunks.discard()
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.union(level)
    return phrases, totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 covered: int = COVERED, top: int = TOP, modulus: int = MODULUS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut,
    ``n`` the language's words; ``score = floor(1000 * a * n / (l * r))``.
    Phrases that stand (nearly) always inside a longer one are left out.

    Null and empty texts have no words; a null language is ``und``, like one
    of that name.  Repeated rows are counted as often as they stand.  Of equal
    scores the more frequent phrase comes first, then the order of bytes.
    """
    phrases, totals = frequent_phrases(df, text, lang, least, longest, modulus)
    many = phrases.where("k > 1")
    words = F.split("phrase", " ", -1)
    # A phrase of k - 1 words inside one of k words: its first or its last k - 1.
    inside = many.where("k > 2").select("lang", "a", words.alias("w"), F.col("k").alias("long")).select(
        "lang", "a", F.explode(F.array(F.expr("slice(w, 1, long - 1)"), F.expr("slice(w, 2, long - 1)"))).alias("w"))
    longer = inside.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    stays = many.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    cuts = stays.select("lang", "phrase", "a", words.alias("w"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("head"),
        F.array_join(F.expr(f"slice(w, cut + 1, {longest})"), " ").alias("tail"))
    heads = phrases.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("head_l"), F.col("a").alias("l"))
    tails = phrases.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("tail_r"), F.col("a").alias("r"))
    parts = (
        cuts.join(heads, (F.col("lang") == F.col("lang_l")) & (F.col("head") == F.col("head_l")))
        .join(tails, (F.col("lang") == F.col("lang_r")) & (F.col("tail") == F.col("tail_r")))
        .join(totals, "lang"))
    score = F.expr("CAST(1000 * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(16, 0)) AS DECIMAL(38, 0)) div "
                   "(CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    weakest = parts.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("s")).groupBy(
        "lang", "phrase", "a", "n").agg(F.min("s").alias("s"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return weakest.select("lang", "phrase", "a", "s.l", "s.r", "n", F.col("s.score").alias("score")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
