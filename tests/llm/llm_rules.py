"""Step-by-step rules that the operators are held against."""

from __future__ import annotations

import collections
import hashlib
import re

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower(text: str | None) -> str:
    return (text or "").translate(ASCII_LOWER)


def contamination(text, items):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, raw in items:
        own = WORD.findall(lower(raw))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def removed_bytes(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, sha(bytes(b for b, x in zip(r, gone, strict=True) if not x))))
    return out


def shingles(text, size):
    words = SOLID.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_components(rows, size, percent=80):
    """Least doc_id reachable over links, by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    best = {i: i for i in sets}

    def top(i):
        while best[i] != i:
            i = best[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                best[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def base_quality(text):
    text = text or ""
    words = SOLID.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SOLID.search(x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed
