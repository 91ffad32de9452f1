"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags in the words of
a text, and a shunting-yard parser evaluates the and/or/with expressions behind the tags.

The automaton runs over the lower-cased words joined by single spaces, so punctuation and line
breaks inside a notice don't matter. A tag (``SPDX-License-Identifier:``, ``license =``) leads back
to the text, where the rest of its line is parsed. Of an ``or`` the mildest terms hold, of an ``and``
the strictest, and a known exception behind ``with`` softens copyleft.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwise.llm.common import passed_through

# The phrases every scan counts, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Further notices, as words.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache software license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "boost software license": "bsl-1",
    "released into the public domain": "unlicense",
    "cc0 1 0 universal": "cc0",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved": "all-rights-reserved",
}
# Tags, as words; the strict ones are always followed by an expression, the others only perhaps.
TAGS = {"spdx license identifier": True, "license": False, "licence": False, "license expression": False}
TERMS = ("none", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "restricted", "unknown")
_OF = {
    "permissive": "mit apache apache-2 bsd bsd-2-clause bsd-3-clause 0bsd isc zlib bsl-1 unlicense cc0 cc-by python-2",
    "weak-copyleft": "lgpl lgpl-2 lgpl-2.1 lgpl-3 mpl mpl-1.1 mpl-2 epl epl-1 epl-2 cddl-1 cc-by-sa",
    "copyleft": "gpl gpl-2 gpl-3",
    "network-copyleft": "agpl agpl-3",
    "restricted": "cc-by-nc cc-by-nd cc-by-nc-sa cc-by-nc-nd sspl-1 all-rights-reserved",
}
RANK = {name: TERMS.index(terms) for terms, names in _OF.items() for name in names.split()}
UNKNOWN, WEAK, COPYLEFT = (TERMS.index(t) for t in ("unknown", "weak-copyleft", "copyleft"))
EXCEPTIONS = (
    "classpath-exception-2", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note",
    "font-exception-2", "bison-exception-2.2", "autoconf-exception-3", "openssl-exception",
)
# How far a label found this way is trusted; several labels of a text add up as independent ones.
TAG_TRUST, NOTICE_TRUST = 0.9, 0.6

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEPARATOR = re.compile(rb"[\"']?[ \t]*[:=]+[ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9.+:-]+)")
_VERSION = re.compile(r"(-\d+)(\.0)+$")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def identifier(word: str) -> str:
    """An identifier without what does not change its terms: ``GPL-3.0-or-later`` is ``gpl-3``."""
    word = word.lower().rstrip(".:")
    word = re.sub(r"(-only|-or-later|\+)$", "", word)
    if word.startswith(("cc-by", "cc0")):
        return re.sub(r"-\d+(\.\d+)*$", "", word)
    return _VERSION.sub(r"\1", word)


def postfix(line: bytes) -> tuple[list[str], bool]:
    """The longest expression at the start of a lower-cased line in postfix order, and if it is whole.

    ``with`` binds closest, then ``and``, then ``or``; all are left-associative. The expression ends
    where a token can't go on with it. It is not whole if an operand or a parenthesis is missing.
    """
    out: list[str] = []
    waiting: list[str] = []
    at, operand, depth = 0, True, 0
    while found := _TOKEN.match(line, at):
        token = found.group(1).decode()
        if token == "(":
            if not operand:
                break
            waiting.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            depth -= 1
        elif token in _PRECEDENCE:
            if operand:
                break
            while waiting and _PRECEDENCE.get(waiting[-1], 0) >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand or not (name := identifier(token)):
                break
            out.append(name)
            operand = False
        at = found.end()
    whole = not operand and not depth
    return out + [w for w in reversed(waiting) if w != "("], whole


def evaluate(rpn: Sequence[str]) -> int:
    """Rank in ``TERMS`` of a whole expression in postfix order."""
    stack: list[tuple[int, str]] = []
    for token in rpn:
        if token not in _PRECEDENCE:
            stack.append((RANK.get(token, UNKNOWN), token))
            continue
        (right, name), (left, _) = stack.pop(), stack.pop()
        if token == "with":
            soft = WEAK if left == COPYLEFT else left
            stack.append((soft if name in EXCEPTIONS else UNKNOWN, ""))
        else:
            stack.append((min(left, right) if token == "or" else max(left, right), ""))
    return stack[0][0]


def operands(rpn: Sequence[str]) -> list[str]:
    """The licences an expression names, without operators and exceptions."""
    out = []
    for i, token in enumerate(rpn):
        if token not in _PRECEDENCE and not (i + 1 < len(rpn) and rpn[i + 1] == "with"):
            out.append(token)
    return out


def automaton(base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES) -> ahocorasick.Automaton:
    """Finds the phrases between word borders; the characters are the bytes of the text."""
    found: dict[str, list] = {}
    for phrase, label in base.items():
        found.setdefault(phrase, [None, None, None])[0] = label
    for phrase, label in notices.items():
        found.setdefault(phrase, [None, None, None])[1] = label
    for phrase, strict in TAGS.items():
        found.setdefault(phrase, [None, None, None])[2] = strict
    out = ahocorasick.Automaton()
    for phrase, kinds in found.items():
        key = f" {phrase} ".encode().decode("latin-1")
        out.add_word(key, (len(key), phrase.count(" ") + 1, *kinds))
    out.make_automaton()
    return out


def _joined(lowered: bytes) -> bytes:
    """The words between single spaces, one also before the first and behind the last."""
    data = np.frombuffer(b" " + lowered + b" ", np.uint8)
    space = data == 32
    space[1:] &= space[:-1]
    space[0] = False
    return data[~space].tobytes()


def scan_text(data: bytes, finder: ahocorasick.Automaton) -> dict:
    """What ``scan`` returns for one text in UTF-8."""
    lowered = data.translate(_WORD_BYTES)
    words = _joined(lowered)
    places: list[tuple[int, int, str, bool]] = []
    tags: list[tuple[int, bool]] = []
    at = counted = 0
    for end, (length, n, base, notice, strict) in finder.iter(words.decode("latin-1")):
        counted += words.count(b" ", at, end)  # borders before the one that ends the match
        at = end
        first = counted - n
        if base is not None:
            places.append((first, first + n, base, True))
        if notice is not None:
            places.append((first, first + n, notice, False))
        if strict is not None:
            tags.append((first + n, strict))
    places = _outermost(places)
    trust = {label: NOTICE_TRUST for _, _, label, _ in places}
    rank = max((RANK.get(label, UNKNOWN) for label in trust), default=0)
    expressions = []
    for rpn, whole in _tagged(data, lowered, tags):
        names = operands(rpn)
        for name in names if whole else [x for x in names if x in RANK]:
            trust[name] = TAG_TRUST
        rank = max(rank, evaluate(rpn) if whole else UNKNOWN)
        expressions.append(" ".join(rpn))
    doubt = 1.0
    for _, sure in sorted(trust.items()):
        doubt *= 1 - sure
    return {
        "n_words": words.count(b" ") - 1,
        "places": places,
        "base_labels": sorted({label for _, _, label, base in places if base}),
        "labels": sorted(trust),
        "expressions": expressions,
        "terms": TERMS[rank],
        "score": 1 - doubt,
    }


def _outermost(places: list[tuple[int, int, str, bool]]) -> list[tuple[int, int, str, bool]]:
    """In order of start, without notices that lie inside a longer place; the base phrases all stay."""
    out, reach = [], -1
    ordered = sorted(places, key=lambda p: (p[0], -p[1], not p[3], p[2]))
    widest = (-1, -1)
    for start, end, label, base in ordered:
        inside = end <= reach and (start, end) != widest
        if base or not inside:
            out.append((start, end, label, base))
        if end > reach:
            reach, widest = end, (start, end)
    return out


def _tagged(data: bytes, lowered: bytes, tags: list[tuple[int, bool]]) -> Iterator[tuple[list[str], bool]]:
    """Expressions that follow tags, which are given by the word behind them.

    A tag that need not be one counts only if its whole expression names known licences.
    """
    if not tags:
        return
    inside = np.frombuffer(lowered, np.uint8) != 32
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    ends = np.flatnonzero(stops) + 1
    done = -1
    for behind, strict in sorted(tags, key=lambda t: (t[0], not t[1])):
        begin = int(ends[behind - 1])
        if begin == done or not (found := _SEPARATOR.match(data, begin)):
            continue
        done = begin  # two tags that end in one word are one
        stop = data.find(b"\n", found.end())
        line = data[found.end() : stop if stop >= 0 else len(data)].translate(_LOWER)
        rpn, whole = postfix(line)
        names = operands(rpn)
        if strict and names or whole and all(x in RANK for x in names):
            yield rpn, whole


_PLACE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
_ARROW = {
    "n_words": pa.int64(), "places": pa.list_(_PLACE), "base_labels": pa.list_(pa.string()),
    "labels": pa.list_(pa.string()), "expressions": pa.list_(pa.string()), "terms": pa.string(),
    "score": pa.float64(),
}
_SPARK = (
    "n_words long, places array<struct<start:bigint,end:bigint,label:string,base:boolean>>, "
    "base_labels array<string>, labels array<string>, expressions array<string>, terms string, score double"
)


def scan(
    docs: DataFrame, text: str = "text", base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES
) -> DataFrame:
    """(row, n_words, places, base_labels, labels, expressions, terms, score) for every row of ``docs``.

    ``row`` holds the input columns. ``places`` are the phrases found, as words from 0, the end
    exclusive; they may overlap, but a notice inside a longer one is not listed. ``expressions`` are in
    postfix order. ``terms`` are the strictest of all notices and expressions, and ``score`` says how
    sure it is that the text states a licence. Texts are scanned whole, however long. NULL and empty
    texts have no words, no label and score 0; repeated rows are scanned one by one; an empty table
    gives an empty result.
    """
    packed = passed_through(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton(base, notices)
        for batch in batches:
            rows = batch.column("row")
            texts = pc.struct_field(rows, text)
            for low in range(0, len(rows), 256):
                found = [scan_text((t.as_py() or "").encode(), finder) for t in texts.slice(low, 256)]
                yield pa.record_batch(
                    [rows.slice(low, 256), *[pa.array([f[n] for f in found], kind) for n, kind in _ARROW.items()]],
                    names=["row", *_ARROW],
                )

    schema = T.StructType([packed.schema["row"], *T._parse_datatype_string(_SPARK).fields])
    return packed.mapInArrow(run, schema)
