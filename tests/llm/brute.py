"""Plain versions of the operators for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def unigram_base(docs):
    """doc_id -> (held_out, n_tokens, n_known, N, base)."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    counts, ends = Counter(), 0
    for d, t in docs:
        if not held[d]:
            counts.update(ASCII_WORD.findall(fold(t)))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    p = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    out = {}
    for d, t in docs:
        w = ASCII_WORD.findall(fold(t))
        out[d] = (held[d], len(w) + 1, sum(x in counts for x in w) + (ends > 0), n, sum(p(counts[x]) for x in w) + p(ends))
    return out


def contamination(docs, items, size=13):
    windows = {}
    for key, text in items:
        w = BENCH_WORD.findall(fold(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add("" if key is None else str(key))
    lengths = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w, hit, found = BENCH_WORD.findall(fold(t)), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[k:k + n]))):
                    hit.update(range(k, k + n))
                    found |= x
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def repeats(docs, length):
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def quality(text):
    w = ASCII_WORD.findall(text or "")
    three = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if three[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if ASCII_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def base_secrets(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def shingle_set(text, width=5):
    w = ASCII_WORD.findall(fold(text))
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def near_components(docs, percent=75):
    """Row by row: (doc_id, set size, component)."""
    sets = [(d, shingle_set(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return [(d, len(s), root(d)) for d, s in sets]
