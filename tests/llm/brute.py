"""Plain restatements of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lower(text):
    return (text or "").translate(LOWER)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs, min_documents=5, min_length=40):
    """[(doc_id, text)] -> sorted [(doc_id, n_lines, n_dropped, sha256)]."""
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= min_length:
                holders[key].add(doc)
    keeper = {k: max((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_documents}
    result = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (k := lower(x.strip(BLANKS))) not in keeper or keeper[k] == doc]
        result.append((doc, len(lines), len(lines) - len(kept), sha256("\n".join(kept))))
    return sorted(result, key=str)


def licence_places(text, phrases):
    """n_words, places of phrases, labels."""
    words = LICENCE_WORD.findall(lower(text))
    places, labels = [], set()
    for phrase, label in phrases.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        if at:
            labels.add(label)
    return words, places, labels


def licence_blocks(words, templates, threshold=0.9):
    """Labels met by a block, and the largest containment."""
    labels, best = set(), 0.0
    for label, text in templates:
        parts = LICENCE_WORD.findall(lower(text))
        reach = 4
        while reach < len(parts):
            reach *= 2
        for start in range(0, max(len(words) - reach - 1, 0) + 1, reach):
            shared = len(set(words[start : start + 2 * reach]) & set(parts))
            if shared >= threshold * len(set(parts)) - 1e-9:
                labels.add(label)
                best = max(best, shared / len(set(parts)))
    return labels, best


def licences(docs, phrases, templates, threshold=0.9):
    result = []
    for doc, text in docs:
        words, places, base = licence_places(text, phrases)
        labels, best = licence_blocks(words, templates, threshold)
        result.append(
            (doc, len(words), len(places), min(places, default=None), max(places, default=None),
             ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best)
        )
    return sorted(result, key=str)


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """{source: size} -> {source: target}, by dealing the excess out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def crc(text):
    return zlib.crc32((text or "").encode())


def shingles(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(nodes, links):
    """{node: smallest node reachable}."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(docs, width=3, percent=90):
    """[(doc_id, text)] -> {doc_id: (set size, component)}; only sets that share a shingle are compared."""
    sets = {d: shingles(t, width) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter()
    for members in holders.values():
        members.sort()
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                shared[a, b] += 1
    links = [
        (a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    found = components(sets, links)
    return {d: (len(s), found[d]) for d, s in sets.items()}
