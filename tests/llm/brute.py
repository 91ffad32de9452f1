"""Plain versions of the operators, over lists of dictionaries, to test against."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % n


def line_dedup(docs, min_docs, keep="none"):
    """{(doc_id, text): (n_lines, n_dropped, kept)}"""
    seen = defaultdict(set)
    distinct = {(d["doc_id"], d["text"] or "") for d in docs}
    keys = {}
    for doc in distinct:
        lines = doc[1].split("\n")
        keys[doc] = [line.strip(SPACES).translate(LOWER) for line in lines]
        for pos, key in enumerate(keys[doc]):
            if key:
                seen[key].add(doc)
    out = {}
    firsts = {}
    for key, holders in seen.items():
        firsts[key] = min(holders, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc in distinct:
        kept, dropped, done = [], 0, set()
        for line, key in zip(doc[1].split("\n"), keys[doc]):
            common = key and len(seen[key]) >= min_docs
            spared = keep == "first" and common and firsts[key] == doc and key not in done
            done.add(key)
            if common and not spared:
                dropped += 1
            else:
                kept.append(line)
        out[doc] = (len(keys[doc]), dropped, "\n".join(kept))
    return out


def measures(text):
    text = text or ""
    tokens = words(text)
    windows = defaultdict(list)
    for i in range(len(tokens) - 7):
        windows[tuple(tokens[i : i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [line for line in text.split("\n") if words(line)]
    return {
        "n_words": len(tokens),
        "word_chars": sum(map(len, tokens)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": text.count("\n") + 1,
        "n_upper": len(re.findall(r"[A-Z]", text)),
    }


def base_failed(m):
    return m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]


def learnt_cutoffs(docs, labels, rules, risk, delta, steps, stratum="lang"):
    """({(stratum, rule): cutoff}, {stratum: bound}) from the definition, document by document.

    A cutoff is certified if the exact binomial chance of seeing so few rejected clean documents, were
    their true share the allowed one, is at most alpha; the mildest is tried first.
    """
    good = {i for i, quality, *_ in labels if quality == 1 and i is not None}
    held = defaultdict(list)
    for d in docs:
        m = measures(d["text"])
        if d["doc_id"] in good and not base_failed(m):
            held[d[stratum] or ""].append({rule: math.ceil(share * steps - 1e-12) for rule, share in rules(m).items()})
    names = list(rules(measures("")))

    def certified(rejected, n, alpha):
        p = risk / len(names)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(rejected + 1))
        return rejected < n and tail <= alpha

    def learn(found, strata):
        alpha, out = delta / (len(names) * strata), {}
        for rule in names:
            for step in range(steps, -1, -1):
                if not certified(sum(f[rule] > step for f in found), len(found), alpha):
                    break
                out[rule] = step / steps
        return out

    def can(found, strata):
        return certified(0, len(found), delta / (len(names) * strata))

    every = len(held)
    pooled = [] if all(can(f, every) for f in held.values()) else [s for s, f in held.items() if not can(f, every + 1)]
    tests = every if all(can(f, every) for f in held.values()) else every + 1
    pool = learn([f for s in pooled for f in held[s]], tests)
    cutoffs, bound = {}, {}
    for s, found in held.items():
        own = pool if s in pooled else learn(found, tests)
        cutoffs.update({(s, rule): c for rule, c in own.items()})
        if own:
            bound[s] = "pool" if s in pooled else "own"
    return cutoffs, bound


FEATURE_BYTES = {
    "symbols": b"#*$%&<>@^~=+_\\", "bars": b"|", "shouts": b"!?", "stops": b".,;:", "digits": b"0123456789",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "quotes": b"\"'`()[]{}", "vowels": b"aeiouAEIOU",
    "wide": bytes(range(128, 256)), "breaks": b"\n",
}


def quality_features(text):
    """The features of the quality classifier by name, from their definitions."""
    text = text or ""
    data, tokens, m = text.encode(), words(text), measures(text)
    solid = max(sum(b not in SPACES.encode() for b in data), 1)
    n = max(len(tokens), 1)
    counts = Counter(tokens)
    lengths = [len(t.encode()) for t in tokens]
    return {
        **{name: sum(b in chosen for b in data) / solid for name, chosen in FEATURE_BYTES.items()},
        "log_words": math.log1p(len(tokens)),
        "word_length": sum(lengths) / n,
        "long_words": sum(x > 20 for x in lengths) / n,
        "distinct_share": len(counts) / n,
        "top_share": max(counts.values(), default=0) / n,
        "adjacent_share": sum(a == b for a, b in zip(tokens, tokens[1:])) / n,
        "repeat_share": m["n_repeat_words"] / n,
        "dup_lines": m["n_dup_lines"] / m["n_lines"],
    }


def additive_score(model, x):
    """One document's probability, looked up entry by entry."""
    at = lambda edges, value: sum(value >= e for e in edges)
    total = model.intercept
    for edges, values, value in zip(model.edges, model.tables, x):
        total += values[at(edges, value)]
    for (a, b), values in zip(model.pairs, model.pair_tables):
        total += values[at(model.coarse[a], x[a])][at(model.coarse[b], x[b])]
    return 1 / (1 + math.exp(-min(max(total, -30), 30)))


def shingle_weights(text, size=5):
    tokens = tuple(words(text))
    if len(tokens) < size:
        return Counter([tokens]) if tokens else Counter()
    return Counter(tokens[i : i + size] for i in range(len(tokens) - size + 1))


def probability_jaccard(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    union = set(a) | set(b)
    return sum(
        1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in union) for i in set(a) & set(b)
    )


def near_classes(docs, threshold=0.8):
    """Class per row, as the index of some row in it."""
    weights = [shingle_weights(d["text"]) for d in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, w in enumerate(weights):
        for s in w or [()]:
            holders[s].append(i)
    pairs = {p for ids in holders.values() for p in itertools.combinations(ids, 2)}
    for i, j in pairs:
        if root(i) != root(j) and probability_jaccard(weights[i], weights[j]) >= threshold - 1e-12:
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(docs))]


def water_fill(children, budget):
    """{name: share} for {name: (weight, capacity)}: fill until none overflows."""
    out, open_, left = {}, dict(children), float(budget)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {n: c for n, (w, c) in open_.items() if c <= left / total * w}
        if not full:
            out.update({n: left / total * w for n, (w, _) in open_.items()})
            break
        for name, capacity in full.items():
            out[name] = float(capacity)
            left -= capacity
            del open_[name]
    return out


def mixing_copies(docs, domains, weights, max_epochs, seed, budget=None):
    """Copies per row; the tree is domain, lang, source."""
    leaves = defaultdict(list)
    for i, d in enumerate(docs):
        source, lang = d["source"] or "", d["lang"] or ""
        leaves[domains.get(source, "other"), lang, source].append(i)
    tokens = [len(words(d["text"])) for d in docs]
    have = {leaf: sum(tokens[i] for i in rows) for leaf, rows in leaves.items()}
    target = {}

    def descend(prefix, share):
        names = sorted({leaf[len(prefix)] for leaf in have if leaf[: len(prefix)] == prefix})
        children = {}
        for name in names:
            path = (*prefix, name)
            capacity = max_epochs * sum(n for leaf, n in have.items() if leaf[: len(path)] == path)
            children[name] = (weights.get("/".join(path), 1), capacity)
        for name, part in water_fill(children, share).items():
            path = (*prefix, name)
            if len(path) == 3:
                target[path] = math.floor(part + 1e-9)
            else:
                descend(path, part)

    descend((), sum(tokens) if budget is None else budget)
    copies = [0] * len(docs)
    for leaf, rows in leaves.items():
        epochs = target[leaf] // have[leaf] if have[leaf] else 0
        rest = target[leaf] - epochs * have[leaf]

        def place(i):
            d = docs[i]
            name = "" if d["doc_id"] is None else str(d["doc_id"])
            return hashlib.md5(f"{seed}:{epochs}:{name}".encode()).hexdigest(), d["doc_id"] or -1

        total = 0
        for _, group in itertools.groupby(sorted(rows, key=place), key=place):
            group = list(group)
            total += sum(tokens[i] for i in group)
            for i in group:
                copies[i] = min(epochs + (total <= rest), max_epochs)
    return copies
