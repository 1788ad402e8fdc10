"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Each batch of texts is split into pre-tokens; the batch keeps one layout (the
   sequence of local word numbers, in order) and its distinct words.
2. Words travel to the bucket of their hash, packed by (batch, bucket).  There
   each distinct word is encoded once, and its ids go back to the batches.
3. Layout and ids meet again at the batch, where ids are put in place by
   position.  Decoding looks each id up in the token-byte table (bounded by the
   vocabulary) and joins the bytes.

A batch holds ``BATCH_BYTES`` of text or one longer text; no row is larger.
Defined cases: a null or empty text has no tokens; repeated rows each give a
row; special-token strings are ordinary text in ``encode`` here.  An empty table
gives none; other columns are not looked at, whatever their names.  Batches are
numbered by input partition and order of rows, so the rows must come from a table,
not from a shuffle whose order a repeated task may change.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .arrays import bounded_batches

BATCH_BYTES = 8 << 20
CACHE = 300_000  #: words that a worker remembers
#: whitespace besides U+0020 and line feed: such texts take the plain path
ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_pretokens long"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Encoder:
    """Ranks of one file; remembers what it has encoded."""

    _made: dict = {}

    def __init__(self, path: str, pat: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.table = {i: b for b, i in ranks.items()}
        self.core = tiktoken.Encoding("own", pat_str=pat, mergeable_ranks=ranks, special_tokens={})
        self.findall = regex.compile(pat).findall
        self.pieces: dict[str, list[str]] = {}
        self.packed: dict[str, bytes] = {}

    @classmethod
    def get(cls, path: str, pat: str) -> Encoder:
        if (path, pat) not in cls._made:
            cls._made[path, pat] = cls(path, pat)
        return cls._made[path, pat]

    def chunks(self, text: str) -> list[str] | None:
        """The text cut before each single space, where pre-tokens always begin; None if spaces stand together."""
        if "  " in text or " \n" in text or "\n " in text or ODD.search(text):
            return None
        return text.split(" ")

    def split(self, chunk: str) -> list[str]:
        got = self.pieces.get(chunk)
        if got is None:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            got = self.pieces[chunk] = self.findall(chunk)
        return got

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit values."""
        parts = self.chunks(text)
        if parts is None:
            return np.array(self.core.encode_ordinary(text), "<u4").tobytes()
        out = list(map(self.packed.get, parts))
        out[0] = np.array(self.core.encode_ordinary(parts[0]), "<u4").tobytes()
        if None in out:
            encode, known = self.core.encode_ordinary, self.packed
            if len(known) >= CACHE:
                known.clear()
            for i, x in enumerate(out):
                if x is None:
                    w = parts[i]
                    x = known.get(w)
                    if x is None:
                        x = known[w] = np.array(encode(" " + w), "<u4").tobytes()
                    out[i] = x
        return b"".join(out)


def _pack(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in map(zstandard.ZstdCompressor(level=3).compress, parts))


def _unpack(blob: bytes) -> list[bytes]:
    out, at, un = [], 0, zstandard.ZstdDecompressor()
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(un.decompress(blob[at + 4 : at + 4 + n]))
        at += 4 + n
    return out


def _planes(values: np.ndarray) -> list[bytes]:
    return [p.tobytes() for p in values.astype("<u4").view(np.uint8).reshape(-1, 4).T]


def _values(planes: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").ravel()


def _layout(encoder: Encoder, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens by falling frequency, their numbers in order of place, and how many each text has."""
    number: dict[str, int] = {}
    known: dict[str, np.ndarray | bytes] = {}
    rows, sizes = [], []

    def coded(pieces: list[str]) -> bytes:
        return np.array([number.setdefault(p, len(number)) for p in pieces], "<u4").tobytes()

    for text in texts:
        parts = encoder.chunks(text)
        if parts is None:
            row = coded(encoder.findall(text))
        else:
            out = list(map(known.get, parts))
            out[0] = coded(encoder.split(parts[0])) if parts[0] else b""
            for i, x in enumerate(out):
                if x is None:
                    w = parts[i]
                    x = known.get(w)
                    if x is None:
                        x = known[w] = coded(encoder.split(" " + w))
                    out[i] = x
            row = b"".join(out)
        rows.append(row)
        sizes.append(len(row) // 4)
    codes = np.frombuffer(b"".join(rows), "<u4")
    order = np.argsort(-np.bincount(codes, minlength=len(number)), kind="stable")
    rank = np.empty(len(order), "<u4")
    rank[order] = np.arange(len(order), dtype="<u4")
    names = list(number)
    return [names[i] for i in order], rank[codes], np.array(sizes, np.int64)


def encode(docs: DataFrame, path: str | None = None, pat: str | None = None) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the bytes that they decode to."""
    spark = docs.sparkSession
    path, pat = path or vocabulary("byte_bpe_50k.tiktoken"), pat or pattern()
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounded_batches(spark)
    kinds = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])

    def explode(batches):
        encoder, held, n = Encoder.get(path, pat), [], 0
        base = TaskContext.get().partitionId() << 32

        def flush():
            nonlocal held, n
            ids, texts = [x for x, _ in held], [t for _, t in held]
            words, codes, sizes = _layout(encoder, texts)
            mask = np.array([x is not None for x in ids], bool)
            whole = np.array([x or 0 for x in ids], "<i8")
            yield base + n, -1, _pack(whole.tobytes(), mask.tobytes(), sizes.tobytes(), *_planes(codes))
            raw = [w.encode() for w in words]
            home = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int64, len(raw))
            order = np.argsort(home, kind="stable")
            cuts = np.searchsorted(home[order], np.arange(buckets + 1))
            for k in range(buckets):
                mine = order[cuts[k] : cuts[k + 1]]  # ascending numbers: their steps are small
                if len(mine):
                    own = [raw[i] for i in mine.tolist()]
                    lengths = np.fromiter(map(len, own), "<u4", len(own))
                    yield base + n, k, _pack(b"".join(own), *_planes(lengths), *_planes(np.diff(mine, prepend=0)))
            held, n = [], n + 1

        size = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, t in zip(ids, texts):
                t = t or ""
                if held and size + len(t) > BATCH_BYTES:
                    yield from _batches(flush(), kinds)
                    size = 0
                held.append((i, t))
                size += len(t)
        if held:
            yield from _batches(flush(), kinds)

    def encode_words(batches):
        encoder, known = Encoder.get(path, pat), {}
        one = encoder.core._encode_single_piece
        for batch in batches:
            rows = []
            for number, bucket, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket >= 0:
                    raw, *planes = _unpack(blob)
                    lengths, codes = _values(planes[:4]).tolist(), planes[4:]
                    out, at = [], 0
                    if len(known) > CACHE:  # a bucket's words come again; encoding is a pure function
                        known.clear()
                    for n in lengths:
                        w = raw[at : at + n]
                        at += n
                        x = known.get(w)
                        if x is None:
                            x = known[w] = np.array(one(w), "<u4").tobytes()
                        out.append(x)
                    sizes = np.fromiter(map(len, out), "<u4", len(out)) // 4
                    blob = _pack(*_planes(np.frombuffer(b"".join(out), "<u4")), *_planes(sizes), *codes)
                rows.append((number, bucket, blob))
                if sum(len(r[2]) for r in rows) > BATCH_BYTES:
                    yield from _batches(rows, kinds)
                    rows = []
            yield from _batches(rows, kinds)

    def reassemble(batches):
        encoder, layout, text, raw, at = Encoder.get(path, pat), None, [], [], None

        def finish():
            whole, mask, sizes, *planes = _unpack(layout)
            codes, ends = _values(planes).tolist(), np.cumsum(np.frombuffer(sizes, np.int64))
            ids = [x if m else None for x, m in zip(np.frombuffer(whole, "<i8").tolist(), np.frombuffer(mask, bool))]
            out, begin = [], 0
            for i, end in zip(ids, ends.tolist()):
                mine = codes[begin:end]
                begin = end
                count = sum(map(many.__getitem__, mine))
                out.append((i, count, hashlib.sha256(" ".join(map(text.__getitem__, mine)).encode()).hexdigest(), hashlib.sha256(b"".join(map(raw.__getitem__, mine))).hexdigest(), len(mine)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pretokens"])

        many: dict[int, int] = {}
        for batch in batches:
            for number, bucket, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if number != at:
                    if layout is not None:
                        yield finish()
                    at, layout, text, raw, many = number, None, {}, {}, {}
                if bucket < 0:
                    layout = blob
                    continue
                parts = _unpack(blob)
                values, sizes, codes = _values(parts[:4]).tolist(), _values(parts[4:8]).tolist(), np.cumsum(_values(parts[8:])).tolist()
                p, table = 0, encoder.table
                for code, n in zip(codes, sizes):
                    mine = values[p : p + n]
                    p += n
                    text[code], raw[code], many[code] = " ".join(map(str, mine)), b"".join([table[x] for x in mine]), n
        if layout is not None:
            yield finish()

    exploded = docs.select("doc_id", "text").mapInArrow(explode, "batch long, bucket int, blob binary")
    # layouts have no word to be encoded: they are dealt by batch, words by bucket
    home = F.when(F.col("bucket") < 0, F.xxhash64("batch")).otherwise(F.xxhash64("bucket"))
    encoded = exploded.repartition(buckets, home).mapInArrow(encode_words, "batch long, bucket int, blob binary")
    return encoded.repartition(buckets, "batch").sortWithinPartitions("batch", "bucket").mapInArrow(reassemble, SCHEMA)


def _batches(rows, schema: pa.Schema, limit: int = BATCH_BYTES):
    """Record batches of bounded size from tuples."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
