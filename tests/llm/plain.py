"""Slow versions of the operators, straight from their definitions."""

import math
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def components(sets, percent=90):
    """{id: smallest id reachable}, comparing all pairs."""
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            n, m = len(sets[a]), len(sets[b])
            if n and m and 100 * min(n, m) >= percent * max(n, m):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (n + m - both):
                    x, y = root(a), root(b)
                    label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def luhn(d):
        d = d[::-1]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


SYMBOLS = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")


def bm25_passages(docs, items, passage=64, half=32, k1=1.2, b=0.75):
    """{(doc, item): best share of the item's own BM25 score over all passages}."""
    terms = {i: SYMBOLS.findall((t or "").lower()) for i, t in items.items()}
    terms = {i: t for i, t in terms.items() if t}
    mean = sum(map(len, terms.values())) / max(1, len(terms))
    df = {}
    for t in terms.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    weights = {}
    for i, t in terms.items():
        own = {w: math.log(1 + (len(terms) - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * (k1 + 1) / (
            t.count(w) + k1 * (1 - b + b * len(t) / mean)) for w in set(t)}
        total = sum(own.values())
        weights[i] = {w: x / total for w, x in own.items()}
    best = {}
    for d, text in docs.items():
        words = SYMBOLS.findall((text or "").lower())
        starts = [s for s in range(0, len(words), half) if s == 0 or s + half < len(words)]
        for s in starts:
            there = set(words[s:s + passage])
            for i, own in weights.items():
                score = sum(x for w, x in own.items() if w in there)
                best[d, i] = max(best.get((d, i), 0.0), score)
    return best
