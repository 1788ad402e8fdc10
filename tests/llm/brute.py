"""Plain-Python versions of the operators' results, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WS = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def shingles(text):
    w = WS.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_classes(docs, threshold=0.8):
    """Class of each doc_id by plain Jaccard, over all pairs."""
    sets, root = [(i, shingles(t)) for i, t in docs], {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(k)
    common = Counter()
    for ks in holders.values():
        for a in range(len(ks)):
            for b in range(a):
                common[ks[b], ks[a]] += 1
    for (a, b), n in common.items():
        if n / (len(sets[a][1]) + len(sets[b][1]) - n) >= threshold:
            x, y = find(sets[a][0]), find(sets[b][0])
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in docs}


def licenses(text):
    phrases = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for p, label in phrases:
        p = p.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def pii(text):
    text = text or ""

    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    tests = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in tests for m in re.finditer(p, text) if ok(m[0])]


def secrets(text):
    text = text or ""
    a = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [("assign", *m.span()) for m in re.finditer(a, text, re.I | re.A) if len(m[2]) >= 12]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def quality(text):
    text = text or ""
    words = WS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def substrings(docs, k=20):
    """(n_words, n_removed, digest) of each (doc_id, text), in order."""
    first, out = {}, []
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    for i in order:
        w = WS.findall(docs[i][1] or "")
        for s in range(len(w) - k + 1):
            first.setdefault(tuple(w[s : s + k]), (docs[i][0], s))
    for i, (doc, text) in enumerate(docs):
        w, gone = WS.findall(text or ""), set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s : s + k])] < (doc, s):
                gone |= set(range(s, s + k))
        out.append((len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def spans(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)
