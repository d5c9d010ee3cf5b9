"""License notices found by template-markup matching.

A template is the wording of a notice or of a whole license with markup:

* ``<<optional ...>>`` holds what a notice may leave out, other markup included;
* ``<<var N>>`` or ``<<var M-N>>`` stands for one (or M) to N words of any
  kind: a name, a year, the mark of a list.

All other wording is mandatory and must stand in the text word for word.  Each
template is compiled into an automaton over words: state i reads the i-th word
of the wording (or any word, in a replaceable region) to state i + 1; optional
regions and words beyond a region's minimum add free moves ahead.  One pass over
a text follows all beginnings together; of the notices of a template that
overlap, the one that begins first counts, as long as it goes.

Words are those of the text after A-Z is lower-cased, so punctuation and line
breaks do not matter.  A text whose mandatory wording differs is not accepted.
The whole licenses stand in ``license_texts``, one file each; a file's name and
``-full`` is its label.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from importlib.resources import files
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postcluster.llm.frames import map_texts
from postcluster.llm.words import ALNUM_WORDS, LOWER

#: Phrases of the base scan and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Templates of common notices and the labels they add.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license <<optional version>> 2 0",
    "gpl-3.0": "<<optional this work is>> licensed under the gnu <<optional lesser>> <<optional affero>>"
               " general public license <<optional version>> <<optional v>> 3",
    "gpl-2.0": "licensed under the gnu <<optional lesser>> general public license"
               " <<optional version>> <<optional v>> 2",
    "mit-notice": "<<optional released>> <<optional licensed>> under the <<optional terms of the>> mit license",
    "cc-by-4.0": "licensed under <<optional the>> cc by 4 0",
    "cc-by-nc-4.0": "licensed under <<optional the>> cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under <<optional the>> cc by sa 4 0",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this"
                " software and associated documentation files <<optional the software>> to deal in the"
                " <<var 1>> without restriction",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are"
                " permitted provided that the following conditions are met",
    "proprietary": "copyright <<optional c>> <<var 6>> all rights reserved",
}

#: score of a text with a template's notice, with a base phrase alone, with neither
FULL, PHRASE_ONLY, NONE = 1.0, 0.5, 0.0


MARKUP = re.compile(r"(<<optional\b|<<var\s+[0-9]+(?:-[0-9]+)?>>|>>)")


def standard_templates() -> dict[str, str]:
    """``TEMPLATES`` and the whole licenses, by label."""
    whole = {f.name.removesuffix(".txt") + "-full": f.read_text(encoding="utf-8")
             for f in files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")}
    return TEMPLATES | dict(sorted(whole.items()))


@dataclass
class Automaton:
    """Words accepted by a template.  State i reads ``words[i]`` (None: any
    word) to state i + 1; ``reach[i]`` are the states that i is or moves to freely."""

    words: list[bytes | None]
    reach: list[tuple[int, ...]]
    starts: frozenset[bytes]
    anchor: bytes  # the longest mandatory word sequence, without which nothing is accepted

    def find(self, words: list[bytes]) -> list[tuple[int, int]]:
        """First word and end of each notice, leftmost and then longest first."""
        final, found = len(self.words), []
        active: dict[int, int] = {}  # state -> where its notice began
        best, at = None, 0
        while True:
            if best is None and at < len(words) and words[at] in self.starts:
                for state in self.reach[0]:
                    active.setdefault(state, at)
            if at == len(words) or not active:
                if best is not None:
                    found.append(best)
                    active, best, at = {}, None, best[1]
                    continue
                if at == len(words):
                    return found
                at += 1
                continue
            after: dict[int, int] = {}
            for state, first in active.items():
                if self.words[state] is None or self.words[state] == words[at]:
                    for s in self.reach[state + 1]:
                        if first < after.get(s, len(words)):
                            after[s] = first
            at += 1
            first = after.pop(final, None)
            if first is not None and (best is None or first <= best[0]):
                best = (first, at)
            active = after if best is None else {s: f for s, f in after.items() if f <= best[0]}


def parse_template(template: str) -> list:
    """A template as a list of ``bytes`` (a word), ``(least, most)`` (a
    replaceable region) and lists (optional regions)."""
    open_lists: list[list] = [[]]
    for part in MARKUP.split(template):
        if part.startswith("<<optional"):
            open_lists.append([])
        elif part.startswith("<<var"):
            limits = [int(n) for n in part[5:-2].split("-")]
            open_lists[-1].append((limits[0] if len(limits) == 2 else 1, limits[-1]))
        elif part == ">>":
            if len(open_lists) == 1:
                raise ValueError(f"markup ends that did not begin: {template[:60]!r}")
            region = open_lists.pop()
            open_lists[-1].append(region)
        else:
            open_lists[-1].extend(normal(part).split())
    if len(open_lists) > 1:
        raise ValueError(f"markup that does not end: {template[:60]!r}")
    return open_lists[0]


def compile_template(template: str) -> Automaton:
    words: list[bytes | None] = []
    ahead: dict[int, list[int]] = {}  # free moves, always to a later state

    def add(items: list) -> None:
        for item in items:
            begin = len(words)
            if isinstance(item, bytes):
                words.append(item)
            elif isinstance(item, tuple):
                least, most = item
                words.extend([None] * most)
                for state in range(begin + least, len(words)):
                    ahead.setdefault(state, []).append(len(words))
            else:
                add(item)
                ahead.setdefault(begin, []).append(len(words))

    items = parse_template(template)
    add(items)
    reach: list[tuple[int, ...]] = [()] * (len(words) + 1)
    for state in range(len(words), -1, -1):
        reach[state] = tuple(sorted({state}.union(*(reach[s] for s in ahead.get(state, [])))))
    if len(words) in reach[0] or any(words[s] is None for s in reach[0]):
        raise ValueError(f"a template must begin with wording: {template[:60]!r}")
    runs = [b" ".join(run) for kind, run in groupby(items, lambda i: isinstance(i, bytes)) if kind]
    if not runs:
        raise ValueError(f"a template needs mandatory wording: {template[:60]!r}")
    return Automaton(words, reach, frozenset(words[s] for s in reach[0]), b" " + max(runs, key=len) + b" ")


_NORMAL = bytes(np.where(ALNUM_WORDS[LOWER] > 0, LOWER, 0x20).astype(np.uint8))


def normal(text: str) -> bytes:
    """The text's words in lower case, each between two spaces."""
    return b" " + b" ".join(text.encode().translate(_NORMAL).split()) + b" "


def places(line: bytes, phrase: str) -> list[int]:
    """Word positions at which a phrase stands in ``normal`` text."""
    found, at, target = [], 0, f" {phrase} ".encode()
    while (at := line.find(target, at)) >= 0:
        found.append(line.count(b" ", 0, at))
        at += 1
    return found


def notices(line: bytes, automata: dict[str, Automaton]) -> list[tuple[str, int, int]]:
    """(label, first word, last word) of the notices in ``normal`` text, by
    label and place."""
    found, words = [], None
    for label in sorted(automata):
        if automata[label].anchor in line:
            words = line.split() if words is None else words
            found += [(label, first, end - 1) for first, end in automata[label].find(words)]
    return found


def scan_licenses(df: DataFrame, text: str = "text", keep: list[str] | None = None,
                  phrases: dict[str, str] = BASE_PHRASES,
                  templates: dict[str, str] | None = None) -> DataFrame:
    """Kept columns (struct ``_row``) with what each whole text says of its license.

    ``n_words``; ``n_base`` places of base phrases with their ``first_word``
    and ``last_word`` (null without any); ``base_labels``; ``labels`` with the
    templates' added (both sorted, distinct, comma-joined, empty without any);
    ``score`` 1 with a template's notice, 0.5 with a base phrase alone, else 0;
    ``notices``, the label, first and last word of every notice.  ``templates``
    are :func:`standard_templates` unless given.  Null and empty texts have no
    words, labels or notices; repeated rows each get the same.
    """
    templates = standard_templates() if templates is None else templates

    def make():
        automata = {label: compile_template(t) for label, t in templates.items()}

        def work(texts: pa.Array) -> list:
            out = []
            for text in texts.to_pylist():
                line = normal(text) if text else b"  "
                at = {p: places(line, p) for p in phrases}
                base = {phrases[p] for p, found in at.items() if found}
                every = sorted(i for found in at.values() for i in found)
                whole = notices(line, automata)
                more = {label for label, _, _ in whole}
                out.append((max(0, line.count(b" ") - 1) if line.strip() else 0, len(every),
                            every[0] if every else None, every[-1] if every else None,
                            ",".join(sorted(base)), ",".join(sorted(base | more)),
                            FULL if more else PHRASE_ONLY if base else NONE,
                            [dict(zip(("label", "first_word", "last_word"), n)) for n in whole]))
            columns = zip(*out) if out else [[]] * 8
            place = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                     pa.list_(place))
            return [pa.array(c, t) for c, t in zip(columns, kinds)]

        return work

    return map_texts(df, text, keep or df.columns,
                     "n_words long, n_base long, first_word long, last_word long,"
                     " base_labels string, labels string, score double,"
                     " notices array<struct<label:string,first_word:long,last_word:long>>", make)

