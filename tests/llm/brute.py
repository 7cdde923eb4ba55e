"""Plain versions of the text operators' rules, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contamination(docs, items, width=10):
    out = []
    windows = []
    for item, text in items:
        w = words(text)
        size = min(len(w), width)
        for k in range(len(w) - size + 1 if w else 0):
            windows.append((item, tuple(w[k : k + size])))
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        places = {}
        for size in {len(x) for _, x in windows}:
            for k in range(len(w) - size + 1):
                places.setdefault(tuple(w[k : k + size]), []).append(k)
        for item, window in windows:
            for k in places.get(window, ()):
                hit.update(range(k, k + len(window)))
                found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def near_classes(docs, least=0.8, width=5):
    """Class id of every document by comparing all pairs that share a shingle."""
    from collections import Counter, defaultdict

    bags, texts = {}, {}
    for doc, text in docs:
        w = words(text)
        bags[doc] = Counter(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else Counter()
        texts[doc] = text or ""
    parent = {doc: doc for doc in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    same, holders = {}, defaultdict(list)
    for doc in sorted(bags):
        if texts[doc] in same:
            join(doc, same[texts[doc]])
            continue
        same[texts[doc]] = doc
        for x in bags[doc]:
            holders[x].append(doc)
    seen = set()
    for ids in holders.values():
        for i, x in enumerate(ids):
            for y in ids[i + 1 :]:
                if (x, y) not in seen:
                    seen.add((x, y))
                    both = sum((bags[x] & bags[y]).values())
                    if both / (sum(bags[x].values()) + sum(bags[y].values()) - both) >= least:
                        join(x, y)
    return {doc: find(doc) for doc in bags}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            value = m[0]
            digits = re.sub("[^0-9]", "", value)
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def near_items(text, items, width=10, least=8, slop=2):
    """Items of which some full window stands nearly in the text."""
    w = words(text)
    at = {}
    for k, x in enumerate(w):
        at.setdefault(x, []).append(k)
    found = set()
    for item, said in items:
        q = words(said)
        for k in range(len(q) - width + 1):
            votes = {}
            for j, x in enumerate(q[k : k + width]):
                for p in at.get(x, ()):
                    for s in range(-slop, slop + 1):
                        votes.setdefault(p - j + s, set()).add(j)
            if any(len(v) >= least for v in votes.values()):
                found.add(str(item))
    return found
