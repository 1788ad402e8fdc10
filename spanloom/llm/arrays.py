"""Batch helpers shared by the Arrow-batched operators.

Texts of a batch are laid end to end as UTF-8 bytes and handled with numpy, in
slices of bounded size, so memory follows ``SLICE_BYTES`` (or the longest single
text), never the table.  Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
BATCH_ROWS = 512
U64 = np.uint64
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])


def bounded_batches(spark) -> None:
    """Arrow batches of few rows: very long texts then still fit an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def word_table(separators: bytes | None = None, members: bytes | None = None) -> np.ndarray:
    """Boolean table over byte values: which of them belong to words."""
    table = np.ones(256, bool) if separators is not None else np.zeros(256, bool)
    table[list(separators if separators is not None else members)] = separators is None
    return table


WHITESPACE_WORDS = word_table(separators=SPACE_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _powers(n: int, base: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006
    have = _kept.get(base)
    if have is None or len(have) < n:
        size = max(256, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.cumprod(np.r_[U64(1), np.full(size - 1, base, U64)], dtype=U64)
        _kept[base] = have
    return have


class Words:
    """Words of several texts: byte ranges, text of each word, hashes."""

    def __init__(self, texts: list[bytes], table: np.ndarray = WHITESPACE_WORDS):
        # every text is followed by one separator byte, so that no word crosses texts
        self.raw = b"\n".join(texts) + b"\n"
        self.buf = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.cumsum(sizes) - sizes
        self.inside = table[self.buf]
        edge = np.diff(np.r_[False, self.inside, False].astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, np.r_[self.text_start, len(self.buf)])
        self.count = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.count)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of per-byte values over each text."""
        total = np.r_[0, np.cumsum(values, dtype=np.int64)]
        ends = np.r_[self.text_start[1:], len(self.buf)] if len(self.text_start) else self.text_start
        return total[ends] - total[self.text_start]

    def hashes(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, U64)
        size = self.end - self.start
        data = self.buf[self.inside]
        lut = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        if lower:
            lut[65:91] = lut[97:123]
        at = np.cumsum(size) - size
        place = np.arange(len(data)) - np.repeat(at, size)
        with np.errstate(over="ignore"):
            values = lut[data] * _powers(int(size.max()), 0x5851F42D4C957F2D + 2 * seed)[place]
            return mix(np.add.reduceat(values, at) + size.astype(U64))


def windows(words: Words, hashed: np.ndarray, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Start words of all k-word windows that stay in one text, and their hashes."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    ok = words.text_of[:n] == words.text_of[k - 1 :]
    with np.errstate(over="ignore"):
        out = np.zeros(n, U64)
        for i in range(k):
            out = out * U64(0xD6E8FEB86659FD93 + 2 * seed) + hashed[i : i + n]
    at = np.flatnonzero(ok)
    return at, mix(out[at])


def slices(sizes, limit: int = SLICE_BYTES):
    """Ranges of consecutive rows whose sizes sum to at most ``limit``; a larger row stands alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def texts_of(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in column.to_pylist()]


def map_texts(df, fn, schema: str, columns=("doc_id", "text"), limit: int = SLICE_BYTES):
    """``fn(rows: RecordBatch, texts: list[bytes]) -> RecordBatch`` over bounded slices; the text is the last column."""
    bounded_batches(df.sparkSession)
    width = len(columns) - 1

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(width))
            for a, b in slices([len(t) for t in texts], limit):
                yield fn(batch.slice(a, b - a), texts[a:b])

    return df.select(*columns).mapInArrow(run, schema)
