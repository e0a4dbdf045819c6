"""Plain versions of the operators, one document at a time."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256

LETTER_DIGIT = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def low(text: str | None) -> bytes:
    return (text or "").encode().lower()  # bytes: A-Z only


def contamination(docs, items, length=13):
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = LETTER_DIGIT.findall(low(text))
        for k in range(max(1, len(words) - length + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + length]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = LETTER_DIGIT.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                got = windows.get(tuple(words[k : k + n]))
                if got:
                    hit.update(range(k, k + n))
                    found |= got
        names = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len([i for i in found if i is not None])
        out.append((doc, len(words), len(hit), n_items, sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def near_components(docs, words=4, percent=85):
    sets = []
    for doc, text in docs:
        w = NOT_SPACE.findall(low(text))
        sets.append((doc, {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()))
    root = {i: i for i in range(len(sets))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    best: dict[int, int] = {}
    for i, (doc, _) in enumerate(sets):
        best[find(i)] = min(best.get(find(i), doc), doc)
    return sorted((doc, len(s), best[find(i)]) for i, (doc, s) in enumerate(sets))


def without_repeats(docs, length=400):
    raw = [(doc, (text or "").encode()) for doc, text in docs]
    seen = Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = []
    for doc, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, sha256(left).hexdigest()))
    return sorted(out, key=repr)


def without_passages(docs, length=51):
    """(doc, what is left of the text) without the windows of ``length`` words that occur twice."""
    texts = [(doc, (text or "").encode()) for doc, text in docs]
    places = [[m.start() for m in NOT_SPACE.finditer(t)] for _, t in texts]
    words = [NOT_SPACE.findall(t) for _, t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, t), w, at in zip(texts, words, places):
        gone = {k for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for k in range(i, i + length)}
        edges = [0, *at[1:], len(t)] if w else [0]
        left = t[:0] if w else t
        left += b"".join(t[edges[k] : edges[k + 1]] for k in range(len(w)) if k not in gone)
        out.append((doc, left.decode()))
    return sorted(out, key=repr)


def without_both(docs, words=51, length=400):
    """(doc, what is left) without the windows of words and the strings of bytes that occur twice; bytes left
    of a character that was cut through go too."""
    raw = [(doc, (text or "").encode()) for doc, text in docs]
    seen = Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    split = [[(m.start(), m.group()) for m in NOT_SPACE.finditer(t)] for _, t in raw]
    passages = Counter(tuple(w for _, w in s[i : i + words]) for s in split for i in range(len(s) - words + 1))
    out = []
    for (doc, t), s in zip(raw, split):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = [0, *[at for at, _ in s[1:]], len(t)]
        for i in range(len(s) - words + 1):
            if passages[tuple(w for _, w in s[i : i + words])] > 1:
                gone[edges[i] : edges[i + words]] = b"\1" * (edges[i + words] - edges[i])
        out.append((doc, bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")))
    return sorted(out, key=repr)


def base_counts(docs):
    out = []
    for doc, text in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        many = Counter(grams)
        covered = {k for i, g in enumerate(grams) if many[g] > 1 for k in range(i, i + 5)}
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        out.append((doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed))
    return sorted(out, key=repr)
