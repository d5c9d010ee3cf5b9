"""Byte-level BPE encoding and decoding of whole texts.

A greedy-merge BPE encoding has a useful property: the encoding of a byte
string is fixed by the last token of each of its prefixes.  The last token of
a prefix is the one vocabulary entry that ends there and that may follow the
last token of the prefix before it, where "may follow" means that the two
tokens, written side by side, would not be merged across their border.

So the distinct words of a slice are put into a trie and walked depth first;
each node needs one step, from the states of its ancestors, and a prefix that
many words share is encoded once.  The trie is kept in its depth-first order
(the sorted words and the length that each shares with the one before), which
needs a stack of one state per byte of the current path and no node objects.

Decoding turns ids back into bytes and reads them as UTF-8 (bytes that are no
UTF-8 become U+FFFD, as the public library does).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from postcluster.llm.frames import map_texts

#: Fixed value: how the byte-level vocabulary splits a text into words.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: A worker keeps the encodings of this many words between slices; the cache is
#: then emptied, which costs time and changes nothing.
CACHED_WORDS = 400_000


def printable_bytes() -> dict[str, int]:
    """The vocabulary file's alphabet: each byte is one printable character.

    Bytes that are printable in Latin-1 stand for themselves, the others are
    numbered from U+0100 in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + i)] = b
    return table


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary: what the tasks need, a few MB."""

    tokens: list[bytes]                      # by id
    parts: dict[int, tuple[int, int]]        # the two tokens that a merge joins
    rank: dict[tuple[int, int], int]         # order of the merge of two tokens
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a tokenizer file in the public JSON format."""
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, alphabet = stored["model"], printable_bytes()
        special = {a["content"]: a["id"] for a in stored["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *special.values()])
        tokens = [b""] * size
        for text, i in model["vocab"].items():
            if text not in special:
                tokens[i] = bytes(alphabet[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        ids = model["vocab"]
        rank, parts = {}, {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (ids[left], ids[right])
            rank[pair] = r
            parts.setdefault(ids[left + right], pair)
        return cls(tokens, parts, rank, special)


class Encoder:
    """Encodes words against a vocabulary."""

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Encoder:
        """The worker process's encoder: its caches serve the next task too."""
        known = vars(vocabulary).get("_encoder")
        if known is None:
            known = vocabulary._encoder = cls(vocabulary)
        return known

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        special = set(vocabulary.special.values())
        self.lengths = [len(t) for t in vocabulary.tokens]
        self.born = {i: vocabulary.rank[p] for i, p in vocabulary.parts.items()}
        # Every suffix of a token, with the token's id if it is one: a walk
        # backwards from a byte stops as soon as no token ends with it.
        self.ends = {t[k:]: -1 for t in vocabulary.tokens for k in range(len(t))}
        self.ends |= {t: i for i, t in enumerate(vocabulary.tokens) if t and i not in special}
        self.follows: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}

    def _spine(self, token: int, side: int) -> Iterator[tuple[int, float]]:
        """The tokens that touch one end of ``token`` while it is built, last
        first, each with the rank of the merge that ends it."""
        end = float("inf")
        while True:
            yield token, end
            if token not in self.v.parts:
                return
            end = self.born[token]
            token = self.v.parts[token][side]

    def may_follow(self, left: int, right: int) -> bool:
        """True if no merge crosses the border of the two tokens.

        A pair of border tokens is merged if its rank comes before both of
        them are used up; at equal rank the merge further left goes first.
        """
        known = self.follows.get((left, right))
        if known is None:
            known = True
            outer = list(self._spine(right, 0))
            for a, a_end in self._spine(left, 1):
                for b, b_end in outer:
                    r = self.v.rank.get((a, b))
                    if r is not None and r < a_end and r <= b_end:
                        known = False
            self.follows[left, right] = known
        return known

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """Encodings of distinct words, by a depth-first walk of their trie."""
        ends, follows, lengths = self.ends, self.follows, self.lengths
        last: list[int] = [-1]  # last[i]: last token of the path's first i bytes
        before = b""
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            for at in range(shared + 1, len(word) + 1):
                begin = at - 1
                while True:  # the tokens that end here, shortest first
                    token = ends.get(word[begin:at])
                    if token is None:
                        raise ValueError(f"no token of the vocabulary ends at byte {at} of {word!r}")
                    if token >= 0:
                        if begin == 0:
                            break
                        fits = follows.get((last[begin], token))
                        if fits or fits is None and self.may_follow(last[begin], token):
                            break
                    begin -= 1
                last.append(token)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= lengths[last[at]]
            yield word, tuple(reversed(ids))
            before = word

    def learn(self, words: set[str]) -> None:
        """Put the encodings of ``words`` into the cache."""
        new = {w.encode(): w for w in words if w not in self.cache}
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache, new = {}, {w.encode(): w for w in words}
        for word, ids in self.walk(new):
            self.cache[new[word]] = ids


#: Texts of these characters alone (all of them ASCII, or Latin letters) are
#: split by the same pattern with plain character ranges, several times faster.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PLAIN = re.compile(f"[\t\n\r -~{_LETTERS}]*")
_PLAIN_WORDS = re.compile(
    WORD_PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}0-9]")
    .replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]")
)


class Splitter:
    """Texts into words; special tokens stand alone."""

    def __init__(self, vocabulary: Vocabulary):
        self.any_words = regex.compile(WORD_PATTERN).findall
        self.special = vocabulary.special
        marks = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = regex.compile(f"({marks})") if marks else None

    def words(self, text: str) -> list[str]:
        plain = _PLAIN.fullmatch(text) is not None
        return _PLAIN_WORDS.findall(text) if plain else self.any_words(text)

    def pieces(self, text: str) -> list[str]:
        if self.marks is None or not any(s in text for s in self.special):
            return self.words(text)
        out: list[str] = []
        for part in self.marks.split(text):
            out += [part] if part in self.special else self.words(part)
        return out


def encode_texts(texts: list[str | None], encoder: Encoder, splitter: Splitter) -> list[list[int]]:
    """Token ids of each text (null: none)."""
    pieces = [splitter.pieces(t) if t else [] for t in texts]
    encoder.learn(set(chain.from_iterable(pieces)) - splitter.special.keys())
    found = encoder.cache
    if any(any(s in t for s in splitter.special) for t in texts if t):
        found = found | {s: (i,) for s, i in splitter.special.items()}
    return [list(chain.from_iterable(map(found.__getitem__, p))) for p in pieces]


def decode_ids(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text that the ids stand for; ids outside the vocabulary are skipped."""
    size = len(vocabulary.tokens)
    return b"".join(vocabulary.tokens[i] for i in ids if 0 <= i < size).decode("utf-8", "replace")


def _shared(df: DataFrame, path: str):
    # A vocabulary is a parameter of fixed size (its file is checked), not data.
    with open(path, "rb") as file:
        if file.seek(0, 2) > 64 << 20:
            raise ValueError(f"{path} is no vocabulary of up to 64 MB")
    return df.sparkSession.sparkContext.broadcast(Vocabulary.read(path))


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row's kept columns (struct ``_row``) with ``ids array<int>``.

    Null and empty texts have no ids.  Rows are independent, so repeated
    rows, clashing column names and empty tables need no care.
    """
    shared = _shared(df, path)

    def make():
        vocabulary = shared.value
        encoder, splitter = Encoder.of(vocabulary), Splitter(vocabulary)

        def work(texts: pa.Array) -> list:
            return [pa.array(encode_texts(texts.to_pylist(), encoder, splitter), pa.list_(pa.int32()))]

        return work

    return map_texts(df, text, keep or df.columns, "ids array<int>", make)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with a column ``decoded`` from an id array (null ids: null text)."""
    from pyspark.sql import functions as F

    shared = _shared(df, path)

    @F.pandas_udf("string")
    def to_text(column):
        return column.map(lambda x: None if x is None else decode_ids(x, shared.value))

    return df.withColumn("decoded", to_text(F.col(ids)))


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode each text: kept columns, token count and digests of
    the ids (decimal, comma-joined) and of the decoded text (UTF-8)."""
    shared = _shared(df, path)

    def make():
        vocabulary = shared.value
        encoder, splitter = Encoder.of(vocabulary), Splitter(vocabulary)
        digits = [str(i) for i in range(len(vocabulary.tokens))]

        def sha(data: bytes) -> str:
            return hashlib.sha256(data).hexdigest()

        def work(texts: pa.Array) -> list:
            counts, of_ids, of_text = [], [], []
            for ids in encode_texts(texts.to_pylist(), encoder, splitter):
                counts.append(len(ids))
                of_ids.append(sha(",".join(map(digits.__getitem__, ids)).encode()))
                raw = b"".join(map(vocabulary.tokens.__getitem__, ids))
                of_text.append(sha(raw.decode("utf-8", "replace").encode()))
            return [pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)]

        return work

    return map_texts(df, text, keep or df.columns,
                     "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
