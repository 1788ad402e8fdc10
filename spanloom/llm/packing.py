"""Packing into sequences by minimum bin slack.

A document's ids (and the separator id) fill whole sequences; what remains, less
than one sequence, joins the multiset of remaining lengths.  For each window a
dynamic program over bitsets finds the reachable sums of that multiset; the
largest sum gives a multiset by backtracking, which is repeated as long as the
counts allow.  If no multiset fills a window, one more piece is cut to fill it.

Each input partition packs its own documents, ``GROUP`` remainders at a time, so
there is no shuffle; one sequence per group may stay open, and it is cut into
powers of two when that needs at most ``TAIL`` pieces.  Sequence ids combine partition and place,
so a repeated task gives the same ids.  Defined cases: a null or empty text is
the separator alone; repeated rows are packed each.  An empty table gives none; very
long texts fill sequences of their own; other columns are not looked at, whatever
their names.  Ids follow input partition and order of rows, so the rows must come
from a table, not from a shuffle whose order a repeated task may change.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrays import bounded_batches
from .bpe import Encoder, pattern, vocabulary

CAPACITY = 1024
GROUP = 50_000
TAIL = 10
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pattern_of(counts: list[int], capacity: int) -> dict[int, int]:
    """Lengths (with how many of each) whose sum comes closest to ``capacity``; the longest length is among them."""
    lengths = [n for n in range(len(counts) - 1, 0, -1) if counts[n]]
    longest = lengths[0]
    rest, mask = capacity - longest, (1 << (capacity - longest + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        many = counts[n] - (n == longest)
        power = 1
        while many > 0 and n <= rest and not reach >> rest & 1:
            take = min(power, many)
            if n * take > rest:
                take = rest // n
                many = take
                if not take:
                    break
            before = reach
            reach |= reach << n * take & mask
            steps.append((n, take, before))
            many -= take
            power *= 2
        if reach >> rest & 1:
            break
    total, used = reach.bit_length() - 1, {longest: 1}
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            total -= n * take
            used[n] = used.get(n, 0) + take
    return used


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start in the item, length); each item is whole unless it is cut to fill a bin."""
    items: list[list[tuple[int, int]]] = [[] for _ in range(capacity)]
    for i, n in enumerate(lengths):
        items[n].append((i, 0))
    for x in items:
        x.reverse()
    counts, bins, left = [len(x) for x in items], [], len(lengths)
    while left:
        used = pattern_of(counts, capacity)
        total = sum(n * k for n, k in used.items())
        times = min(counts[n] // k for n, k in used.items()) if total == capacity else 1
        for _ in range(times):
            rows = [(*items[n].pop(), n) for n, k in used.items() for _ in range(k)]
            bins.append(rows)
        for n, k in used.items():
            counts[n] -= k * times
            left -= k * times
        if total < capacity and left:
            gap = capacity - total
            n = next(n for n in range(gap + 1, capacity) if counts[n])  # a shorter one would have fitted
            item, start = items[n].pop()
            bins[-1].append((item, start, gap))
            counts[n] -= 1
            items[n - gap].append((item, start + gap))
            counts[n - gap] += 1
    return bins


def power_cuts(rows: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """An open bin as bins of lengths that are powers of two."""
    out, rows = [], list(rows)
    total = sum(r[2] for r in rows)
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        now = []
        while room:
            item, start, n = rows.pop()
            if n > room:
                rows.append((item, start + room, n - room))
                n = room
            now.append((item, start, n))
            room -= n
        out.append(now)
    return out


def sequences(docs: DataFrame, path: str | None = None, pat: str | None = None, special: tuple[str, int] = ("<|endoftext|>", 50256), end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece; ``special`` is the one added token of the vocabulary, whose string in a text is that id."""
    path, pat = path or vocabulary("byte_bpe_50k.tiktoken"), pat or pattern()
    bounded_batches(docs.sparkSession)
    stop, token = end_id.to_bytes(4, "little"), special[1].to_bytes(4, "little")

    def run(batches):
        encoder, base, n = Encoder.get(path, pat), TaskContext.get().partitionId() << 36, 0
        rest: list[tuple[int | None, bytes, int, int]] = []
        out: list[tuple] = []

        def emitted():
            kinds = [pa.int64()] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        def settle():
            nonlocal n
            bins = pack([len(x[1]) // 4 for x in rest], capacity)
            if bins and (short := sum(r[2] for r in bins[-1])) < capacity and short.bit_count() <= TAIL:
                bins[-1:] = power_cuts(bins[-1])
            for rows in bins:
                at = 0
                for item, start, length in rows:
                    doc, ids, begin, total = rest[item]
                    out.append((doc, begin + start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, base + n, at))
                    at += length
                n += 1
            rest.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                ids = (token.join(map(encoder.ids, text.split(special[0]))) if special[0] in text else encoder.ids(text)) + stop
                total = len(ids) // 4
                full = total // capacity * capacity
                for start in range(0, full, capacity):
                    out.append((doc, start, capacity, zlib.crc32(ids[4 * start : 4 * (start + capacity)]), total, base + n, 0))
                    n += 1
                if full < total:
                    rest.append((doc, ids[4 * full :], full, total))
                if len(rest) >= GROUP:
                    settle()
            if out:
                yield emitted()
                out.clear()
        settle()
        if out:
            yield emitted()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
