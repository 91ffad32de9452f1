"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos int, row string"


def awkward(n=60, seed=3):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing names."""
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("ba", "ké", "ti", "Om", "zu") for b in ("r", "ndo", "Li", "s.")]
    shared = ["Shared Line of many words here", "  SHARED line of many words HERE\t", "", "odd"]
    docs = []
    for i in range(n):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        lines += rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(lines)
        docs.append([i, "\n".join(lines), rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", "src12", None])])
    docs[3][1], docs[4][1], docs[5][1] = None, "", " \n\t"
    docs[6][0] = None
    docs[7][1] = "\n".join(["one long line of text " + str(i % 50) for i in range(3000)])
    docs += [docs[8], docs[8], [100, *docs[8][1:]], [9, "another text under one id\nodd", "en", "src0"]]
    return [(*d, None if d[1] is None else len(d[1]), "k", 1, None) for d in docs]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def dicts(rows):
    return [dict(zip([c.split()[0] for c in SCHEMA.split(", ")], r)) for r in rows]
