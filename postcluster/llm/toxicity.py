"""Toxicity scores from a lexicon, with misspellings and context.

1. **Lexicon.**  Terms are learned from a bounded sample of labelled rows:
   words and word beginnings (stems) that stand in toxic texts and hardly
   ever in others, counted by Spark.
2. **Automaton.**  The lexicon's trie is intersected with Levenshtein
   automata: a state is the set of (trie node, edits spent) that a word's
   bytes can have reached.  Determinised, it is one byte-driven table that
   accepts every word within the edit budget of a term, and every word that
   begins with a stem.  All words of a slice are run through the table
   together, one byte column at a time; nearly all reach the dead state
   within three bytes.  A large lexicon has several tables.
3. **Context windows.**  Each hit is weighed by its surroundings: hits inside an
   open quotation, whatever its marks, that began and ends within
   ``QUOTE_WINDOW`` words weigh less; further hits near by weigh more.
4. **Score.**  A logistic regression over a few sums of hit weights, fitted on
   the same sample.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import cut, drop, map_texts
from postcluster.llm.learning import FIT_ROWS, fit_rows
from postcluster.llm.words import byte_classes, scan, segment_sums

#: Word matter: letters, digits and all bytes beyond ASCII.
TERM_WORDS = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

STEM_LENGTHS = range(4, 8)
MIN_TEXTS = 3            # toxic texts that must hold a term, at least
MIN_EVIDENCE = 8.0       # log likelihood ratio: term and label against chance
MIN_ODDS = 30.0          # toxic against other share of texts
STEM_WORDS = 5           # different words that a stem must begin
MAX_STATES = 60_000      # of one determinised automaton
TERMS_EACH = 64          # terms of one automaton at most
WINDOW = 12              # words on each side of a hit
QUOTE_WINDOW = 40        # words of a quotation before and after a hit
QUOTED_WEIGHT = 0.35
#: Marks in the bytes that :func:`plain_marks` makes: either side, opening, closing.
DOUBLE, SINGLE, OPENS, CLOSES = 0x22, 0x27, 0x02, 0x03
#: Punctuation beyond ASCII separates words: general and CJK punctuation, guillemets, inverted marks.
BEYOND_ASCII = "\\x{A0}\\x{A1}\\x{AB}\\x{BB}\\x{BF}\\x{2000}-\\x{206F}\\x{3000}-\\x{303F}"

EXACT, FUZZY, STEM = 1, 2, 3
FEATURES = 6


class TooManyStates(ValueError):
    """The determinised automaton would pass ``MAX_STATES``."""


def edit_budget(term: bytes) -> int:
    """Edits that a misspelled term may have: none in short ones, where an
    edit often gives another word."""
    return 0 if len(term) < 6 else 1 if len(term) < 10 else 2


@dataclass
class Automaton:
    """``next[state, class[byte]]``; state 0 is dead, state 1 the start.
    ``kind[state]``: what a word that ends here is (0: nothing).  A stem's
    state accepts whatever follows."""

    classes: np.ndarray  # uint8[256]
    next: np.ndarray     # int32[states, classes]
    kind: np.ndarray     # uint8[states]

    def run(self, words) -> np.ndarray:
        """The kind of each word of a scanned slice."""
        n = len(words)
        state = np.ones(n, np.int32)
        length = words.end - words.start
        alive = np.arange(n)
        for i in range(int(length.max(initial=0))):
            alive = alive[length[alive] > i]
            if not len(alive):
                break
            after = self.next[state[alive], self.classes[words.data[words.start[alive] + i]]]
            state[alive] = after
            alive = alive[(after != 0) & (self.kind[after] != STEM)]
        return self.kind[state]


def build_automaton(words: list[bytes], stems: list[bytes]) -> Automaton:
    """Determinise (trie x Levenshtein) by subsets, breadth first."""
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    below: list[int] = [0]  # largest budget of a term at or under the node
    stem_at: set[int] = set()
    for term, is_stem in [(w, False) for w in words] + [(s, True) for s in stems]:
        node, budget = 0, 0 if is_stem else edit_budget(term)
        below[0] = max(below[0], budget)
        for byte in term:
            if byte not in children[node]:
                children.append({})
                below.append(0)
                children[node][byte] = len(children) - 1
            node = children[node][byte]
            below[node] = max(below[node], budget)
        if is_stem:
            stem_at.add(node)
        else:
            ends[node] = budget
    used = sorted({b for c in children for b in c})
    classes = np.zeros(256, np.uint8)
    for i, byte in enumerate(used):
        classes[byte] = i + 1

    def close(states: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Cheapest edits of each node, with missing bytes of the word."""
        todo = deque(states)
        while todo:
            node = todo.popleft()
            for child in children[node].values():
                cost = states[node] + 1
                if cost <= below[child] and cost < states.get(child, 99):
                    states[child] = cost
                    todo.append(child)
        return frozenset(states.items())

    def kind_of(states: frozenset) -> int:
        if any(node in stem_at and cost == 0 for node, cost in states):
            return STEM
        best = min((cost for node, cost in states if node in ends and cost <= ends[node]), default=99)
        return 0 if best == 99 else EXACT if best == 0 else FUZZY

    def step(states: frozenset, byte: int | None) -> frozenset:
        after: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= below[node] and cost < after.get(node, 99):
                after[node] = cost

        for node, cost in states:
            reach(node, cost + 1)  # a byte too many
            for b, child in children[node].items():
                if b == byte:
                    if cost <= below[child]:
                        reach(child, cost)
                else:
                    reach(child, cost + 1)  # a wrong byte
        return close(after)

    start = close({0: 0})
    number = {frozenset(): 0, start: 1}
    table, kinds = [[0] * (len(used) + 1), [0] * (len(used) + 1)], [0, kind_of(start)]
    todo = deque([start])
    while todo:
        states = todo.popleft()
        row = table[number[states]]
        if kinds[number[states]] == STEM:
            row[:] = [number[states]] * len(row)
            continue
        for c, byte in enumerate([None, *used]):
            after = step(states, byte)
            if after not in number:
                if len(number) >= MAX_STATES:
                    raise TooManyStates(f"{len(words)} words and {len(stems)} stems")
                number[after] = len(table)
                table.append([0] * (len(used) + 1))
                kinds.append(kind_of(after))
                todo.append(after)
            row[c] = number[after]
    return Automaton(classes, np.array(table, np.int32), np.array(kinds, np.uint8))


@dataclass
class Automata:
    """Automata of parts of a lexicon; every word is run through all of them."""

    parts: list[Automaton]

    def run(self, words) -> np.ndarray:
        """The kind of each word, as one automaton of the whole lexicon has it:
        a stem before an exact term before a misspelled one."""
        rank, kinds = np.array([0, 2, 1, 3], np.uint8), np.array([0, FUZZY, EXACT, STEM], np.uint8)
        best = np.zeros(len(words), np.uint8)
        for part in self.parts:
            np.maximum(best, rank[part.run(words)], out=best)
        return kinds[best]


def build_automata(words: list[bytes], stems: list[bytes]) -> Automata:
    """Automata that together hold every term; neighbours in the alphabet,
    which share states, stay together."""
    terms = sorted([(w, False) for w in words] + [(s, True) for s in stems])
    todo, parts = [terms[a:a + TERMS_EACH] for a in range(0, len(terms), TERMS_EACH)], []
    while todo:
        part = todo.pop()
        try:
            parts.append(build_automaton([t for t, stem in part if not stem], [t for t, stem in part if stem]))
        except TooManyStates:
            if len(part) == 1:
                raise
            todo += [part[:len(part) // 2], part[len(part) // 2:]]
    return Automata(parts)


def learn_lexicon(rows: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Words and stems from ``text, y``: those with enough evidence, all of
    them.  The rows are a bounded sample, so the driver gets a part of its words.

    Spark counts, for each word and each word beginning, the toxic and other
    texts that hold it.  Near copies count once: texts with the same smallest
    hash of their long words are taken for copies of one.
    """
    # Case is that of ASCII letters: other scripts count as they are written.
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_distinct(F.regexp_extract_all(lower, F.lit(f"([0-9a-z\\x{{80}}-\\x{{10FFFF}}&&[^{BEYOND_ASCII}]]+)"), F.lit(1)))
    long_words = F.filter("words", lambda w: F.length(w) >= 8)
    texts = (
        rows.select("y", found.alias("words"))
        .withColumn("origin", F.coalesce(
            F.array_min(F.transform(long_words, lambda w: F.xxhash64(w))), F.xxhash64("words")))
        .groupBy("origin", "y").agg(F.min("words").alias("words"))
    )
    toxic, other = F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other")
    t, o = (x or 0 for x in texts.agg(toxic, other).first())
    odds = ((F.col("toxic") + 0.5) / F.lit(t + 1)) / ((F.col("other") + 0.5) / F.lit(o + 1))
    # Of the texts that hold a term, are more toxic than chance gives?  The texts
    # without it have no part in this, so it is the same for a term of few texts
    # (of a small language, say) and for one that many could hold.
    held = F.col("toxic") + F.col("other")
    evidence = (F.col("toxic") * F.log(F.col("toxic") / held * F.lit((t + o) / max(t, 1)))
                + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") / held * F.lit((t + o) / max(o, 1)))
                         ).otherwise(0.0))
    chosen = (F.col("toxic") >= MIN_TEXTS) & (evidence >= MIN_EVIDENCE) & (odds >= MIN_ODDS)

    def top(counted: DataFrame) -> list:
        return counted.where(chosen).collect()

    words = texts.select("y", "origin", F.explode("words").alias("word"))
    begins = F.explode(F.array(*[F.substring("word", 1, n) for n in STEM_LENGTHS])).alias("term")
    by_text = (
        words.where(F.length("word") >= STEM_LENGTHS[0])
        .select("y", "origin", "word", begins)
        .groupBy("term", "origin", "y").agg(F.min("word").alias("word"))
    )
    counted = by_text.groupBy("term").agg(
        toxic, other, F.size(F.collect_set(F.when(F.col("y") == 1, F.col("word")))).alias("kinds"))
    stems: list[str] = []
    for row in sorted(top(counted.where(F.col("kinds") >= STEM_WORDS)), key=lambda r: (len(r.term), r.term)):
        if not any(row.term.startswith(s) for s in stems):
            stems.append(row.term)
    terms = [r.term for r in sorted(top(words.groupBy(F.col("word").alias("term")).agg(toxic, other)), key=lambda r: (-r.toxic, r.term))]
    exact = [w for w in terms if not any(w.startswith(s) for s in stems)]
    return [w.encode() for w in exact], [s.encode() for s in stems]


def plain_marks(texts: pa.Array) -> pa.Array:
    """The texts with punctuation beyond ASCII as ASCII bytes, byte for byte:
    quotation marks as ``DOUBLE``, ``SINGLE``, ``OPENS`` or ``CLOSES``, all
    other as spaces."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return texts
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].copy()
    data[(data == OPENS) | (data == CLOSES)] = 0x20
    two = np.full(256, 0, np.uint8)
    two[[0xA0, 0xA1, 0xBF, 0xAB, 0xBB]] = [0x20, 0x20, 0x20, OPENS, CLOSES]
    at = np.flatnonzero(data[:-1] == 0xC2)
    at = at[two[data[at + 1]] > 0]
    data[at] = data[at + 1] = two[data[at + 1]]
    general, cjk = np.full(256, 0x20, np.uint8), np.full(256, 0x20, np.uint8)
    general[0x98:0x9C], general[0x9C:0xA0], general[0xB9], general[0xBA] = SINGLE, DOUBLE, OPENS, CLOSES
    cjk[[0x8C, 0x8E]], cjk[[0x8D, 0x8F]] = OPENS, CLOSES
    lead = np.flatnonzero((data[:-2] == 0xE2) | (data[:-2] == 0xE3)) if len(data) > 2 else np.zeros(0, np.int64)
    first, second, third = data[lead], data[lead + 1], data[lead + 2]
    more = (first == 0xE2) & (second == 0x81) & (third <= 0xAF)
    use = (second == 0x80) | more
    code = np.where(more, 0x20, np.where(first == 0xE2, general[third], cjk[third])).astype(np.uint8)[use]
    for i in range(3):
        data[lead[use] + i] = code
    moved = pa.py_buffer((offsets - offsets[0]).astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, moved, pa.py_buffer(data)])


def quoted(words, hit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for the words ``hit`` (of the texts ``doc``) inside a quotation.

    A mark opens if a word follows and none precedes, and closes if a word or
    a sentence's punctuation precedes and no word follows; guillemets and CJK marks that
    stand free open or close as they are drawn.  An apostrophe is neither.  A
    hit is quoted if the last mark before it opens and the next one closes.
    """
    out = np.zeros(len(hit), bool)
    data, ends = words.data, words.texts
    matter = TERM_WORDS[data] > 0
    for codes in ((DOUBLE, OPENS, CLOSES), (SINGLE,)):
        mark = np.isin(data, codes)
        new = mark.copy()  # the bytes of one mark are one run
        new[1:] &= (data[1:] != data[:-1]) | np.isin(np.arange(1, len(data)), ends)
        begin = np.flatnonzero(new)
        if not len(begin):
            continue
        stop = np.flatnonzero(mark & np.append(new[1:] | ~mark[1:], True)) + 1
        text = np.searchsorted(ends, begin, side="right") - 1
        inside_left, inside_right = begin > ends[text], stop < ends[text + 1]
        left = np.where(inside_left, data[np.maximum(begin - 1, 0)], 0x20)
        before = inside_left & matter[np.maximum(begin - 1, 0)]
        after = inside_right & matter[np.minimum(stop, len(data) - 1)]
        ended = before | np.isin(left, list(b".,!?;:"))
        opens, closes = after & ~before, ended & ~after
        free = ~opens & ~closes & ~(before & after)
        opens |= free & (data[begin] == OPENS)
        closes |= free & (data[begin] == CLOSES)
        keep = opens | closes
        begin, text, opens = begin[keep], text[keep], opens[keep]
        if len(begin) < 2:
            continue
        last = np.searchsorted(begin, words.start[hit]) - 1
        held = (last >= 0) & (last + 1 < len(begin))
        last, following = np.where(held, last, 0), np.where(held, last + 1, 0)
        gap = hit - np.searchsorted(words.start, begin[last])
        rest = np.searchsorted(words.start, begin[following]) - hit
        out |= (held & opens[last] & ~opens[following] & (text[last] == doc) & (text[following] == doc)
                & (gap < QUOTE_WINDOW) & (rest <= QUOTE_WINDOW))
    return out


def features(texts: pa.Array, automaton: Automaton | Automata) -> np.ndarray:
    """Sums of hit weights of each text, float64[texts, FEATURES]."""
    words = scan(plain_marks(texts), TERM_WORDS, lower=True)
    out = np.zeros((len(texts), FEATURES))
    kind = automaton.run(words)
    hit = np.flatnonzero(kind)
    if len(hit):
        doc = np.searchsorted(words.first, hit, side="right") - 1
        weight = np.where(quoted(words, hit, doc), QUOTED_WEIGHT, 1.0)
        # Other hits of the same text at most WINDOW words away.
        near = (np.searchsorted(hit, np.minimum(hit + WINDOW + 1, words.first[doc + 1]))
                - np.searchsorted(hit, np.maximum(hit - WINDOW, words.first[doc])))
        context = weight * np.log1p(near)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i, k in enumerate((EXACT, FUZZY, STEM)):
            out[:, i] = segment_sums(np.where(kind[hit] == k, weight, 0.0), first)
        out[:, 3] = segment_sums(context, first)
        out[:, 4] = 100 * segment_sums(weight, first) / np.maximum(words.counts, 1)
        np.maximum.at(out[:, 5], doc, context)
    return np.log1p(out)


@dataclass
class Model:
    automaton: Automata
    weights: np.ndarray  # FEATURES + 1, the last is the bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = features(texts, self.automaton) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; classes weigh alike."""
    x = np.column_stack([x, np.ones(len(x))])
    share = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (importance * (p - y)) / max(len(y), 1) + ridge * w
        hess = (x * (importance * p * (1 - p))[:, None]).T @ x / max(len(y), 1) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS) -> Model:
    """Learn lexicon and weights from at most ``bound`` labelled rows.

    Without any usable label, or any term with enough evidence, every score is 0.5 less a hair (nothing is
    called toxic).
    """
    rows = cut(fit_rows(docs, labels, "toxic", bound))
    automaton = build_automata(*learn_lexicon(rows))
    made = map_texts(rows, "text", ["y"], "x array<double>",
                     lambda: lambda texts: [pa.array(list(features(texts, automaton)), pa.list_(pa.float64()))])
    found = made.select("_row.y", "x").collect()  # bound rows of a few numbers
    drop(rows)
    x = np.array([r.x for r in found]).reshape(len(found), FEATURES)
    y = np.array([r.y for r in found], float)
    if len(set(y)) < 2 or not x.any():
        return Model(automaton, np.array([0.0] * FEATURES + [-1e-6]))
    return Model(automaton, fit_logistic(x, y))


def score_toxicity(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (struct ``_row``) with ``score`` (0 to 1) and ``predicted``
    (1 if the score is 0.5 or more) of each whole text.

    Null and empty texts have no hits and get the score of a clean text.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def work(texts: pa.Array) -> list:
            score = model.scores(texts)
            return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

        return work

    return map_texts(df, text, keep or df.columns, "score double, predicted int", make)
