"""Token counts under a unigram vocabulary.

A word (a run of non-space bytes, with the vocabulary's word mark in front)
is cut into the pieces whose scores sum highest; among equal sums the cut
with fewest pieces counts.  The forward score of a prefix, the best sum over
its cuts, does not depend on what follows, so the distinct words of a slice
are put into a trie, each node's forward score is formed once from those of
its ancestors, and the count at a word's terminal node is stored for all its
occurrences.  The trie is kept in depth-first order: the sorted words, with a
stack of one state per character of the current path.

Scores are the model file's.  A character without a piece becomes one byte
piece per UTF-8 byte, each scored ``UNKNOWN_BELOW`` under the lowest score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postcluster.llm.frames import map_texts
from postcluster.llm.words import scan, segment_sums

WORD_MARK = "▁"
UNKNOWN_BELOW = 10.0
#: A worker keeps the counts of this many words; the cache is then emptied.
CACHED_WORDS = 500_000


@dataclass
class Pieces:
    """A unigram vocabulary: piece -> score."""

    score: dict[str, float]

    @classmethod
    def read(cls, path: str) -> Pieces:
        """From a sentencepiece model file; its ordinary pieces count."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        score = {
            model.IdToPiece(i): float(model.GetScore(i))
            for i in range(model.GetPieceSize())
            if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i))
        }
        if sum(map(len, score)) > 32 << 20:
            raise ValueError(f"{path} is no vocabulary of up to 32 MB")
        return cls(score)


class Counter:
    """Counts the pieces of words."""

    def __init__(self, pieces: Pieces):
        floor = min(pieces.score.values(), default=0.0)
        self.byte_score = floor - UNKNOWN_BELOW
        # Every suffix of a piece, with the piece's score if it is one.
        self.ends: dict[str, float | None] = {p[k:]: None for p in pieces.score for k in range(len(p))}
        self.ends |= pieces.score
        self.cache: dict[str, tuple[int, float]] = {}

    @classmethod
    def of(cls, pieces: Pieces) -> Counter:
        """The worker process's counter: its cache serves the next task too."""
        known = vars(pieces).get("_counter")
        if known is None:
            known = pieces._counter = cls(pieces)
        return known

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, int, float]]:
        """(word, pieces, score) of distinct words, by a walk of their trie."""
        ends, byte_score = self.ends, self.byte_score
        best: list[tuple[float, int]] = [(0.0, 0)]  # (score, -pieces) of each prefix
        before = ""
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1:]
            for at in range(shared + 1, len(word) + 1):
                begin, top = at - 1, None
                while begin >= 0:
                    score = ends.get(word[begin:at], False)
                    if score is False:
                        break
                    if score is not None:
                        was = best[begin]
                        now = (was[0] + score, was[1] - 1)
                        if top is None or now > top:
                            top = now
                    begin -= 1
                if word[at - 1:at] not in ends or ends[word[at - 1:at]] is None:
                    size = len(word[at - 1].encode())
                    now = (best[at - 1][0] + size * byte_score, best[at - 1][1] - size)
                    if top is None or now > top:
                        top = now
                best.append(top)
            yield word, -best[-1][1], best[-1][0]
            before = word

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, pieces and score of each text."""
        words = scan(texts)
        coded = words.strings().dictionary_encode()
        keys, back = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        new = [k for k in keys if k not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache, new = {}, keys
        for word, n, score in self.walk(WORD_MARK + k for k in new):
            self.cache[word[len(WORD_MARK):]] = (n, score)
        found = [self.cache[k] for k in keys]
        n = np.array([f[0] for f in found], np.int64)[back] if found else np.zeros(0, np.int64)
        score = np.array([f[1] for f in found], float)[back] if found else np.zeros(0)
        return words.counts, segment_sums(n, words.first), segment_sums(score, words.first)


def token_counts(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (struct ``_row``) with ``n_words``, ``n_tokens`` and
    ``score`` of each whole text.

    Null, empty and blank texts count 0 words, 0 tokens and score 0.  Rows are
    independent: repeated rows each get their own equal count.
    """
    shared = df.sparkSession.sparkContext.broadcast(Pieces.read(path))

    def make():
        counter = Counter.of(shared.value)

        def work(texts: pa.Array) -> list:
            n_words, n_tokens, score = counter.counts(texts)
            return [pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(score)]

        return work

    return map_texts(df, text, keep or df.columns, "n_words long, n_tokens long, score double", make)
