"""Plain versions of the corpus operators, for small tables."""

import collections
import hashlib
import re

from daystrata.llm import fingerprints

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def without_repeats(rows, window=35):
    split = [words(text) for _, text in rows]
    seen = collections.Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    out = collections.Counter()
    for (doc_id, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def groups(rows):
    """``(id, least id of the group, links)`` by all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = words(text)
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in where[x] if j != i)
        for j, k in shared.items():
            if 9 * k >= 4 * (len(s) + len(sets[j])):
                links[i] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return collections.Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def edited(rows):
    """``id: (n_chars, sha of the edited text, near_edited, near_next)``."""
    pieces = re.compile(fingerprints._PIECES.replace("$", r"\Z"))
    order = sorted(rows, reverse=True)

    def alike(a, b):
        a, b = set(pieces.findall(a)), set(pieces.findall(b))
        return round(len(a & b) / len(a | b), 9) if a | b else 1.0

    out = {}
    for i, (doc_id, text) in enumerate(order):
        following, third = order[(i + 1) % len(order)][1], len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        out[doc_id] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), alike(text, changed),
            alike(text, following),
        )
    return out
