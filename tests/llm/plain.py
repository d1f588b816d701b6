"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def remainder(i, n: int) -> int:
    return 0 if i is None else zlib.crc32(str(i).encode()) % n


def base_scores(docs, modulus=10):
    """(doc_id, n_tokens, n_known, train_tokens, base_score)"""
    tokens = [(i, WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in docs]
    count = Counter()
    for i, words in tokens:
        if remainder(i, modulus):
            count.update(words)
    total, distinct = sum(count.values()), len(count)
    return [(i, len(w), sum(count[x] > 0 for x in w), total,
             sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)) for i, w in tokens]


def repeats(docs, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)"""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[p:p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    k = min(width, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if k else frozenset()


def near_copies(docs, percent=75):
    """(doc_id, n_shingles, component_id)"""
    sets = [(i, shingles(t)) for i, t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[root(a)] = root(b)
    first = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        if i is not None:
            first[root(k)].append(i)
    return [(i, len(s), min(first[root(k)], default=None)) for k, (i, s) in enumerate(sets)]


def contamination(docs, items, window=13):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)"""
    windows = defaultdict(set)
    for i, t in items:
        words = ALNUM.findall((t or "").translate(LOWER))
        size = min(window, len(words))
        for a in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[a:a + size])].add(i)
    out = []
    for i, t in docs:
        words = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for a in range(len(words) - size + 1):
                ids = windows.get(tuple(words[a:a + size]))
                if ids:
                    hit.update(range(a, a + size))
                    found |= {str(x) for x in ids if x is not None}
        out.append((i, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return out


PERSONAL = (("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
            ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
            ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
            ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")))
SECRETS = (("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
           ("access", re.compile(r"AKIA[A-Z0-9]+")), ("hex", re.compile(r"[0-9a-f]+")))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    """(kind, start, end) by kind, then start."""
    out = []
    for kind, pattern in PERSONAL:
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def secrets(text):
    """(kind, start, end) by start, then kind."""
    out = []
    for rank, (kind, pattern) in enumerate(SECRETS):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def top_k(vectors, k=10):
    """(query_id, rank, vec_id, score)"""
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, a) in enumerate(rows):
        if q % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for n, (i, b) in enumerate(rows) if n != own and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out
