"""License scans: base phrases against a word-by-word search, rules and suppression."""

import random
import re

import pytest
from llm_rows import EDGES, documents  # noqa: F401

from meterstar.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = {}
    for phrase, label in L.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        if at:
            places[label] = at
    return len(words), places


def test_words_and_phrases():
    rng = random.Random(6)
    parts = ["GNU", "General", "Public", "License", "apache", "cc", "by", "CC-BY", "mit", "MIT License", " ", "-", "\n",
             "é", "ſ", "\x7f", "license", "x9", "_", "gnu general public license", "ΑΒ"]
    for _ in range(2000):
        text = rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randrange(25)))
        body, n = L.canonical(text)
        assert (n, L.phrase_places(body)) == slow(text), text


def found(text):
    return {(a, b, label) for a, b, label, _ in L.detections(L.canonical(text)[0])}


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0", {"apache-2.0"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl-3.0-or-later"}),
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
    ("GNU Affero General Public License", {"agpl"}),
    ("released under CC BY-NC-SA 4.0", {"cc-by-nc-sa-4.0"}),
    ("the MIT License", {"mit"}),
    ("3-Clause BSD License", {"bsd-3-clause"}),
    ("Mozilla Public License, v. 2.0", {"mpl-2.0"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("Creative Commons Attribution-Non-Commercial-ShareAlike 4.0", {"cc-by", "cc-by-nc-sa"}),
    ("distributed under the terms of the GNU General Public License as published by the Free Software Foundation;"
     " either version 3 of the License, or (at your option) any later version", {"gpl-3.0-or-later"}),
    ("This product includes software developed by the Apache Group", {"apache-1.1"}),
    ("All rights reserved.", {"all-rights-reserved"}),
    ("an apache helicopter, a bison and a sleepy cat", set()),
])
def test_rules(text, labels):
    assert {label for *_, label in found(text)} == labels


def test_there_are_hundreds_of_rules_and_their_keywords_are_needed():
    assert len(L.RULES) >= 200
    for keyword, group in L.rules().items():
        for rule in group:
            assert 0 < rule.priority <= 100


def sample(parsed, rng):
    """A random string that the parsed pattern matches."""
    out = ""
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                kind, value = rng.choice(arg)
                out += {"LITERAL": lambda: chr(value), "RANGE": lambda: chr(rng.randint(*value)),
                        "CATEGORY": lambda: "19"[rng.randrange(2)]}[str(kind)]()
            case "MAX_REPEAT":
                for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))):
                    out += sample(arg[2], rng)
            case "BRANCH":
                out += sample(rng.choice(arg[1]), rng)
            case "SUBPATTERN":
                out += sample(arg[3], rng)
            case "ASSERT":
                out += ""
            case other:
                raise AssertionError(other)
    return out


def test_no_keyword_hides_a_match():
    rng = random.Random(8)
    for keyword, group in L.rules().items():
        for rule in group:
            parsed = re._parser.parse(rule.pattern.pattern)
            for _ in range(200):
                body = f" {sample(parsed, rng)} ".encode("latin-1")
                assert rule.pattern.search(body) and keyword in body, (rule, body)


def test_resolution_against_a_slow_one():
    rng = random.Random(7)
    texts = ["gnu general public license version 2 or later", "apache license version 2 0", "cc by sa 4 0", "mit license",
             "creative commons attribution 4 0", "licensed under the", "bsd 3 clause license", "public domain", "word"]
    for _ in range(200):
        body, _ = L.canonical(" ".join(rng.choice(texts) for _ in range(rng.randrange(8))))
        raw = sorted(
            (-r.priority, m.start() - m.end(), m.start(), m.end(), r.label)
            for k, group in L.rules().items() if k in body for r in group for m in r.pattern.finditer(body))
        kept = []
        for p, size, a, b, label in raw:
            if not any(x <= a and b <= y and (q, s) != (p, size) for q, s, x, y, _ in kept):
                kept.append((p, size, a, b, label))
        assert sorted(label for *_, label, _ in L.detections(body)) == sorted(k[4] for k in kept)


def test_documents(spark, documents):
    rows = EDGES + [(9, "Über: the MIT License, CC BY. And CC-BY 4.0!"), (10, "GPLv3 only")]
    got = L.digest(L.scan_licenses(documents(rows))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        n, places = slow(text)
        starts = [p for at in places.values() for p in at]
        r = by_id[doc_id]
        assert (r.n_words, r.n_base) == (n, len(starts))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted(places))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert by_id[10].labels == "gpl-3.0" and by_id[9].labels == "cc-by,cc-by-4.0,mit"
    assert L.scan_licenses(documents([])).count() == 0
