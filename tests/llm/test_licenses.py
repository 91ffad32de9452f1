from __future__ import annotations

import random
import re

import pytest

from tests.llm import rows
from tillwise.llm import licenses

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_places(text):
    found = words(text)
    out = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        out += [(i, label) for i in range(len(found)) if found[i : i + len(parts)] == parts]
    return sorted(out)


def parsed(text):
    """Recursive descent over a well-formed expression: (terms rank, names)."""
    tokens = re.findall(r"[()]|[a-z0-9.+:-]+", text.lower())

    def either(i):
        rank, names, i = both(i)
        while i < len(tokens) and tokens[i] == "or":
            r, n, i = both(i + 1)
            rank, names = min(rank, r), names | n
        return rank, names, i

    def both(i):
        rank, names, i = one(i)
        while i < len(tokens) and tokens[i] == "and":
            r, n, i = one(i + 1)
            rank, names = max(rank, r), names | n
        return rank, names, i

    def one(i):
        if tokens[i] == "(":
            rank, names, i = either(i + 1)
            i += 1
        else:
            name = licenses.identifier(tokens[i])
            rank, names, i = licenses.RANK.get(name, licenses.UNKNOWN), {name}, i + 1
        if i < len(tokens) and tokens[i] == "with":
            known = licenses.identifier(tokens[i + 1]) in licenses.EXCEPTIONS
            rank = (licenses.WEAK if rank == licenses.COPYLEFT else rank) if known else licenses.UNKNOWN
            i += 2
        return rank, names, i

    return either(0)[:2]


IDS = ["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-or-later", "LGPL-2.1+", "AGPL-3.0", "CC-BY-NC-4.0", "LicenseRef-own"]


def expression(rng, depth=3):
    if not depth or rng.random() < 0.3:
        name = rng.choice(IDS)
        return name + rng.choice(["", "", " WITH Classpath-exception-2.0", " with odd-exception"])
    joined = f" {rng.choice(['AND', 'OR', 'and'])} ".join(expression(rng, depth - 1) for _ in range(rng.randint(1, 3)))
    return f"({joined})" if rng.random() < 0.5 else joined


def test_expressions_against_recursive_descent():
    rng = random.Random(4)
    for _ in range(500):
        text = expression(rng)
        rpn, whole = licenses.postfix(text.lower().encode())
        assert whole
        assert (licenses.evaluate(rpn), set(licenses.operands(rpn))) == parsed(text), text


@pytest.mark.parametrize("line, rpn, whole", [
    ("mit or", ["mit", "or"], False),
    ("(mit or apache-2.0", ["mit", "apache-2", "or"], False),
    ("mit) or isc", ["mit"], True),
    ("mit license text", ["mit"], True),
    ("mit */", ["mit"], True),
    ("and mit", [], False),
    ("", [], False),
    ("(" * 5000 + "mit" + ")" * 5000, ["mit"], True),
    ("(" * 5000, [], False),
])
def test_where_expressions_end(line, rpn, whole):
    assert licenses.postfix(line.encode()) == (rpn, whole)


def scanned(text):
    return licenses.scan_text(text.encode(), licenses.automaton())


@pytest.mark.parametrize("text, labels, terms", [
    ("// SPDX-License-Identifier: MIT OR GPL-3.0-only */\ncode", ["gpl-3", "mit"], "permissive"),
    ("SPDX-License-Identifier: (MIT AND GPL-2.0-only WITH Classpath-exception-2.0)", ["gpl-2", "mit"], "weak-copyleft"),
    ("SPDX-License-Identifier: GPL-2.0 AND\n", ["gpl-2"], "unknown"),
    ('"license": "Apache-2.0",', ["apache-2"], "permissive"),
    ("License: see the file\n", [], "none"),
    ("a license without any colon", [], "none"),
    ("Under the GNU General Public License, version 3.", ["gpl-3"], "copyleft"),
    ("Under the MIT\n * License. CC-BY-NC-SA 4.0", ["cc-by-nc", "cc-by-nc-sa", "mit"], "restricted"),
    ("", [], "none"),
])
def test_labels_and_terms(text, labels, terms):
    found = scanned(text)
    assert (found["labels"], found["terms"]) == (labels, terms)
    assert (found["score"] > 0) == bool(labels) and 0 <= found["score"] <= 1


def test_overlapping_and_repeated_places():
    found = scanned("cc by nc by nc cc by nc cc by nc")
    assert [p[0] for p in found["places"] if p[3]] == [0, 5, 8]
    assert scanned("xunder the mit license")["base_labels"] == []
    assert scanned("éunder the mit license under the MIT licenseé")["base_labels"] == []
    many = scanned("Licensed under the MIT License. " * 50_000)
    assert many["n_words"] == 250_000 and sum(p[3] for p in many["places"]) == 50_000


def test_against_brute_force(spark):
    rng = random.Random(9)
    bits = ["under", "the", "MIT", "License", "apache", "license,", "Version", "2.0", "CC", "BY-NC", "é", "\n", "x_y", "\x00", "٣", "nc"]
    data = rows.awkward(80)
    notices = ["Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "under the mit license"]
    for i, row in enumerate(data):
        if row[1] and i % 2:
            text = row[1] + " " + " ".join(rng.choices(bits, k=rng.randint(1, 60))) + rng.choice(notices)
            data[i] = (*row[:1], text, *row[2:])
    got = licenses.scan(rows.frame(spark, data)).collect()
    assert len(got) == len(data)
    assert sorted(map(str, (r.row for r in got))) == sorted(str(r) for r in rows.frame(spark, data).collect())
    for r in got:
        places = [(p.start, p.label) for p in r.places if p.base]
        assert sorted(places) == base_places(r.row.text)
        assert r.n_words == len(words(r.row.text))
        assert r.base_labels == sorted({label for _, label in places}) and set(r.base_labels) <= set(r.labels)
        assert r.labels == sorted(set(r.labels))


def test_empty(spark):
    assert licenses.scan(rows.frame(spark, [])).collect() == []
