"""Plain versions of the operators for small inputs."""

import re

import numpy as np
import xxhash

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 69),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "en", "a", 4),
    (5, "word " * 20_000, "en", "hot", 100_000),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today", "de", "b", 69),
    (7, "mail a@b.co or +1 234 567 8901, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a", 70),
    (7, "mail a@b.co or +1 234 567 8901, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a", 70),
    (None, "no id at all", "en", "a", 12),
    (8, "x" * 50_000, "en", "a", 50_000),
    (9, "é日本😀 <|endoftext|> \\ <|im_end|>", "fr", "c", 30),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def roots(pairs, nodes):
    """Smallest node that each one reaches."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text, shingle=4):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def repeats(texts, width):
    """Bytes covered by a string of ``width`` bytes that also starts elsewhere."""
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - width + 1):
            seen.setdefault(t[p : p + width], []).append((i, p))
    out = [np.zeros(len(t), dtype=bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                out[i][p : p + width] = True
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(twice) % 10 == 0


def private(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
