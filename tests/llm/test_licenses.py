from __future__ import annotations

import random
import re

import pytest

from postcluster.llm import licenses as li
from postcluster.llm.catalog import op8_licenses, oracle_queries
from tests.llm.conftest import SF


TEMPLATES = li.standard_templates()


def pattern_of(template):
    """A regular expression over words that a space follows, made by
    replacing the innermost markup until none is left."""
    template = re.sub(r"<<var ([0-9]+)>>", r"<<var 1-\1>>", template)
    made = []

    def put(pattern):
        made.append(pattern)
        return f" \x00{len(made) - 1}\x00 "

    def words(text):
        parts = re.findall("\x00[0-9]+\x00|[0-9A-Za-z]+", text)
        return "".join(made[int(p[1:-1])] if p[0] == "\x00" else p.lower() + " " for p in parts)

    template = re.sub("<<var ([0-9]+)-([0-9]+)>>", lambda m: put(f"(?:[^ ]+ ){{{m[1]},{m[2]}}}"), template)
    while "<<" in template:
        template = re.sub("<<optional((?:(?!<<|>>).)*)>>", lambda m: put(f"(?:{words(m[1])})?"), template, flags=re.S)
    return re.compile("(?<= )" + words(template))


def some_notice(items, rng):
    """A notice of a parsed template."""
    out = []
    for item in items:
        if isinstance(item, bytes):
            out.append(item.decode())
        elif isinstance(item, tuple):
            out += [rng.choice(["jane", "2020", "c", "öz"]) for _ in range(rng.randint(*item))]
        elif rng.random() < 0.6:
            out += some_notice(item, rng)
    return out


def found(text, label):
    return li.notices(li.normal(text), {label: li.compile_template(TEMPLATES[label])})


def test_automata_accept_what_the_pattern_accepts():
    texts = [
        "Licensed under the Apache License, Version 2.0.", "licensed under the apache license 2.0",
        "Licensed under an Apache License 2.0", "Released under the MIT License.", "under the terms of the MIT license",
        "Copyright (c) 2020 Jane Q. Public. All rights reserved.", "Copyright All rights reserved",
        "copyright a b c d e f g all rights reserved", "This work is licensed under the GNU General Public License, version 3.",
        "licensed under the gnu affero general public license v 3", "Licensed under CC BY-NC 4.0.", "", "mit license",
    ]
    for label, template in li.TEMPLATES.items():
        for text in texts:
            assert bool(found(text, label)) == bool(pattern_of(template).search(li.normal(text).decode()))


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_notices_with_any_choice_of_regions_and_with_one_word_changed(label):
    rng = random.Random(label)
    items, pattern = li.parse_template(TEMPLATES[label]), pattern_of(TEMPLATES[label])
    kept = 0
    for trial in range(25):
        words = some_notice(items, rng)
        if trial % 2:  # a word lost, doubled or replaced, anywhere
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], [words[at]] * 2, ["other"]])
        words = ["before", "the"] * rng.randrange(3) + words + ["after", "mit"] * rng.randrange(3)
        text = "".join(rng.choice([w, w.upper()]) + rng.choice([" ", "\n * ", ", ", ") "]) for w in words)
        want = pattern.search(li.normal(text).decode())
        assert bool(found(text, label)) == bool(want)
        assert want or trial % 2
        kept += bool(want)
    assert kept >= 13


def test_whole_licenses():
    assert {"mit-full", "isc-full", "bsd-2-clause-full", "bsd-3-clause-full", "apache-2.0-full", "gpl-2.0-full",
            "gpl-3.0-full"} <= set(TEMPLATES)
    every = {label: li.compile_template(t) for label, t in TEMPLATES.items()}
    for label in TEMPLATES:
        if label.endswith("-full"):  # each is its own and no other's
            text = " ".join(some_notice(li.parse_template(TEMPLATES[label]), random.Random(3)))
            assert [n[0] for n in li.notices(li.normal(text), every) if n[0].endswith("-full")] == [label]


def test_places_of_notices():
    grant = " ".join(w.decode() for w in li.parse_template(TEMPLATES["mit-full"]) if isinstance(w, bytes))
    at = grant.index("be liable")
    text = "x\nMIT License\nCopyright (c) 2020 Jane Doe\n" + grant[:at] + "the authors or copyright holders " + grant[at:]
    n = len(text.split())
    assert found(text, "mit-full") == [("mit-full", 1, len(li.normal(text).split()) - 1)]
    twice = found(f"{text} y {text}", "mit-full")  # the second copy begins after x
    assert [first for _, first, _ in twice] == [1, len(li.normal(text).split()) + 2] and n > 100
    nested = li.compile_template("a <<optional b <<optional c>> d>> <<var 0-2>> e")
    cases = {"a e": [(0, 2)], "a b d e": [(0, 4)], "a b c d x y e": [(0, 7)], "a b c e": [(0, 4)], "a b c f e": [],
             "a a e": [(0, 3)], "a e e e e": [(0, 4)], "a x x x e": [], "e a": [], "a": [], "": [], "a e a e": [(0, 4)]}
    for line, want in cases.items():
        assert nested.find(line.encode().split()) == want, line


def test_markup_that_cannot_be_compiled():
    for bad in ("<<optional a", "a >>", "<<var 3>> a", "<<optional a>>", ""):
        with pytest.raises(ValueError):
            li.compile_template(bad)


def test_rows(spark, docs):
    texts = [None, "", "MIT License mit license", "The Apache-License; general public license", "mit licenses",
             "Licensed under the Apache License, Version 2.0.", "x " * 30000 + "MIT LICENSE"]
    got = li.scan_licenses(docs(texts)).orderBy("_row.doc_id").collect()
    assert [tuple(r)[1:8] for r in got] == [
        (0, 0, None, None, "", "", 0.0),
        (0, 0, None, None, "", "", 0.0),
        (4, 2, 0, 2, "mit", "mit", 0.5),
        (6, 2, 1, 3, "apache,gpl", "apache,gpl", 0.5),
        (2, 0, None, None, "", "", 0.0),
        (8, 1, 3, 3, "apache", "apache,apache-2.0", 1.0),
        (30002, 1, 30000, 30000, "mit", "mit", 0.5),
    ]
    assert [[tuple(n) for n in r.notices] for r in got] == [[], [], [], [], [], [("apache-2.0", 0, 7)], []]


def test_repeated_rows_and_own_templates(spark):
    df = spark.createDataFrame([(1, "A b, c"), (1, "A b, c"), (None, "a c")], "doc_id long, text string")
    got = li.scan_licenses(df, templates={"own": "a <<optional b>> c"}).collect()
    assert sorted((r.n_words, r.labels, r.score, [tuple(n) for n in r.notices]) for r in got) == [
        (2, "own", 1.0, [("own", 0, 1)]), (3, "own", 1.0, [("own", 0, 2)]), (3, "own", 1.0, [("own", 0, 2)])]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "mit license", "x")], "score long, text string, labels string")
    assert li.scan_licenses(df).collect()[0]._row.labels == "x"
    assert li.scan_licenses(df.limit(0)).collect() == []


def test_query_equals_its_sql(spark):
    from tests.llm.sql import same_rows
    same_rows(op8_licenses(spark, SF), oracle_queries()["op8_licenses"], SF)
