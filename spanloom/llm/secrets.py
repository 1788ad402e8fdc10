"""Secret scans: named patterns, then sliding-window entropy over long tokens.

Candidates of the second step are maximal runs of token characters that hold a
digit and a letter.  For each character class (hex, alphanumeric, base64) whose
alphabet covers the run, Shannon entropy of every window of ``WINDOW``
characters is kept by incremental counts; windows over the class threshold merge
into one span of kind ``entropy``, unless an allow-list form or a base span
covers it.

Defined cases: a null or empty text has no spans (the digest is that of the
empty string); offsets count code points, ends are exclusive; repeated rows each
give a row.  An added span runs from the first to the last hot window of its run,
cold ones between them included; one that overlaps a base span is left out, base
spans that overlap all stay.  An empty table gives none; very long texts are read
whole; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import map_texts

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "entropy")
KEYWORDS = (b"passw", b"secret", b"token", b"api")
WINDOW = 20
#: class name, alphabet, bits per character that a window must reach
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+\Z"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+\Z"), 3.7),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+\Z"), 3.9),
)
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z"),
    re.compile(r"[0-9+/_=-]+\Z"),
    re.compile(r"(?i).*(example|sample|placeholder|0123456789|abcdefghij)"),
    re.compile(r"(?:[A-Za-z]+[-_/=+]+)*[A-Za-z]+[-_/=+]*[0-9]{0,4}\Z"),
)
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
_TERM = [0.0] + [n / WINDOW * math.log2(n / WINDOW) for n in range(1, WINDOW + 1)]


def hot_windows(token: str, least: float) -> tuple[int, int] | None:
    """First and last character of the windows of a token whose entropy reaches ``least``."""
    counts: dict[str, int] = {}
    for c in token[:WINDOW]:
        counts[c] = counts.get(c, 0) + 1
    total, span = -sum(_TERM[n] for n in counts.values()), None
    for i in range(len(token) - WINDOW + 1):
        if i:
            out, new = token[i - 1], token[i + WINDOW - 1]
            n = counts[out]
            total += _TERM[n] - _TERM[n - 1]
            counts[out] = n - 1
            n = counts.get(new, 0)
            total += _TERM[n] - _TERM[n + 1]
            counts[new] = n + 1
        if total >= least - 1e-9:
            span = (span[0] if span else i, i + WINDOW)
    return span


def entropy_spans(text: str) -> list[tuple[int, int]]:
    found = []
    for m in RUN.finditer(text):
        token = m[0]
        if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)) or any(a.match(token) for a in ALLOWED):
            continue
        for _, alphabet, least in CLASSES:
            if alphabet.match(token):
                if span := hot_windows(token, least):
                    found.append((m.start() + span[0], m.start() + span[1]))
                break
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[False, member, False].astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = b - a >= least
    return a[keep], b[keep]


_HEX, _RUN, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_HEX[list(b"0123456789abcdef")] = True
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT[list(b"0123456789")] = True


def promising(texts: list[bytes]) -> np.ndarray:
    """Texts in which any pattern can match: by keyword, or by a long enough run of the right bytes."""
    hit = np.array([b"AKIA" in t or any(k in (low := t.lower()) for k in KEYWORDS) for t in texts], bool)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, int)
    a, _ = runs(_HEX[buf], 16)
    hit[np.searchsorted(starts, a, "right") - 1] = True
    a, b = runs(_RUN[buf], WINDOW)
    digits = np.r_[0, np.cumsum(_DIGIT[buf])]
    a = a[digits[b] > digits[a]]
    hit[np.searchsorted(starts, a, "right") - 1] = True
    return hit


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those that the entropy step adds."""
    base = base_spans(text)
    added = [("entropy", a, b) for a, b in entropy_spans(text) if not any(x < b and a < y for _, x, y in base)]
    return base, added


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its spans."""
    none = hashlib.sha256(b"").hexdigest()

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        counts, digests, spans = np.zeros((4, len(texts)), np.int64), [none] * len(texts), [""] * len(texts)
        for i in np.flatnonzero(promising(texts)):
            base, added = find_spans(texts[i].decode())
            for kind, _, _ in base + added:
                counts[KINDS.index(kind), i] += 1
            digests[i], spans[i] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added)
        out = [rows.column(0), *map(pa.array, counts[:3]), pa.array(digests), pa.array(spans), pa.array(counts[3])]
        return pa.RecordBatch.from_arrays(out, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    return map_texts(docs, work, SCHEMA)
