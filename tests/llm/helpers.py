"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return _WORD.findall((text or "").encode())


def groups(rows, size=5, percent=75):
    """(id, set size, component) of rows (id, text)."""
    sets = []
    for _, text in rows:
        w = [x.lower() for x in words(text)]
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted((i, len(s), top(i)) for (i, _), s in zip(rows, sets, strict=True))


def repeats(rows, window=50):
    """(id, words, removed, hash of the rest) of rows (id, text)."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=5, n=60):
    """Documents with copies, near copies in chains, shared passages, empty and long ones."""
    r = random.Random(seed)
    passage = prose(99, 70)
    texts = []
    for k in range(n):
        kind = r.randrange(6)
        if kind == 0 and texts:
            texts.append(r.choice(texts))
        elif kind in (1, 2) and texts:
            w = (r.choice(texts) or "x").split()
            for _ in range(1 + len(w) // 60):
                w[r.randrange(len(w))] = f"new{r.randrange(1000)}"
            texts.append(" ".join(w))
        elif kind == 3:
            w = prose(k + 1000, r.randrange(1, 150))
            at = r.randrange(len(w))
            cut = r.randrange(0, 25)
            texts.append("\t".join([*w[:at], *passage[cut:], *w[at:]]))
        else:
            texts.append(" \n".join(prose(k + 2000, r.randrange(1, 200))))
    texts += ["", None, "   \n ", "one", "One", "two words", "a b c d", " ".join(prose(7, 30_000, 5000))]
    return [(i, t) for i, t in enumerate(texts)]
