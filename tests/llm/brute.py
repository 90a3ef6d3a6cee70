"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def shingle_set(text: str | None, width: int) -> set:
    low = bytes((text or "").encode()).translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    found = WORD.findall(low)
    if not found:
        return set()
    if len(found) < width:
        return {tuple(found)}
    return {tuple(found[k:k + width]) for k in range(len(found) - width + 1)}


def jaccard_components(texts: list[tuple[int, str | None]], width: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    sets = [(doc_id, shingle_set(text, width)) for doc_id, text in texts]
    least = {doc_id: doc_id for doc_id, _ in sets}

    def find(a):
        while least[a] != a:
            a = least[a]
        return a

    owners = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for token in s:
            owners[token].append(k)
    common = Counter()
    for rows in owners.values():
        for i in range(len(rows)):
            for j in rows[i + 1:]:
                common[rows[i], j] += 1
    for (i, j), n in common.items():
        (a, x), (b, y) = sets[i], sets[j]
        if den * n >= num * (len(x) + len(y) - n):
            a, b = find(a), find(b)
            least[max(a, b)] = min(a, b)
    return {doc_id: (len(s), find(doc_id)) for doc_id, s in sets}


def removed_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + length] for b in bodies for k in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cut_passages(texts: list[str | None], length: int, size: int) -> list[bytes]:
    """The texts without repeated strings of ``length`` bytes and runs of ``size`` words that two rows have."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + length] for b in bodies for k in range(len(b) - length + 1))
    places = [[m.span() for m in WORD.finditer(b)] for b in bodies]
    owners = defaultdict(set)
    for row, b in enumerate(bodies):
        found = WORD.findall(b)
        for k in range(len(found) - size + 1):
            owners[tuple(found[k:k + size])].add(row)
    out = []
    for b, place in zip(bodies, places):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        found = WORD.findall(b)
        for k in range(len(found) - size + 1):
            if len(owners[tuple(found[k:k + size])]) > 1:
                first, last = place[k][0], place[k + size - 1][1]
                gone[first:last] = b"\1" * (last - first)
        out.append(bytes(x for x, g in zip(b, gone) if not g))
    return out


def rule_stats(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    found = [w.decode() for w in words(text)]
    lines = [line for line in text.split("\n") if words(line)]
    windows = Counter(tuple(found[k:k + 8]) for k in range(len(found) - 7))
    hit = set()
    for k in range(len(found) - 7):
        if windows[tuple(found[k:k + 8])] > 1:
            hit.update(range(k, k + 8))
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))
