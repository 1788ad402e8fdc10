"""Quality rules with line sequence labelling.

Counts per text come from byte arrays.  A linear-chain conditional random field
with two labels (content, boilerplate) scores each line; Viterbi decoding marks
the lines, and the share of words in content lines decides retention.

The field is fitted on all lines of at most ``SAMPLE_ROWS`` labelled documents,
whose lines take their document's label.  Long chains are fitted in stretches of
``STRETCH`` lines: only the transitions between stretches are left out.

Defined cases: a null or empty text has no words and fails the base rule; an empty
table gives none.  Lines without a word take no part in the sequence; where both
labels of a line score the same, it counts as content.  Very long texts are
handled whole, one at a time.  Without labelled rows of both kinds the field keeps
``DEFAULT_WEIGHTS``; of repeated labels of a document the smallest counts, of
repeated rows with one id the greatest text.  Repeated rows each give a row;
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import WHITESPACE_WORDS, Words, map_texts, windows

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 2000  #: labelled documents the field is fitted on, at most
STRETCH = 64  #: lines that are fitted as one chain
MIN_CONTENT = 0.5
N_FEATURES = 9
#: emission weights (content minus boilerplate), then the two transition weights
DEFAULT_WEIGHTS = np.array([1.0, 0.0, -6.0, -4.0, -6.0, -2.0, -3.0, -3.0, 0.5, 1.0, 1.0])
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)


def line_features(words: Words, hashed: np.ndarray, texts: list[bytes]):
    """Per line with a word: features, number of words, text; and per text the number of repeated lines."""
    newline = words.buf == 10
    line_of_byte = np.cumsum(newline) - newline
    line_of_word = line_of_byte[words.start]
    lines, first, n = np.unique(line_of_word, return_index=True, return_counts=True)
    if not len(lines):
        return np.zeros((0, N_FEATURES)), n, np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    breaks = np.flatnonzero(newline)
    stop, begin = breaks[lines], np.r_[0, breaks + 1][lines]
    text_of = words.text_of[first]
    seen, repeated = set(), np.zeros(len(lines), bool)
    raw = words.raw
    for i in range(len(lines)):
        key = (int(text_of[i]), hashlib.blake2b(raw[begin[i] : stop[i]], digest_size=16).digest())
        repeated[i] = key in seen
        seen.add(key)
    dup = np.bincount(text_of[repeated], minlength=len(texts))
    total = lambda mask: (lambda c: c[stop] - c[begin])(np.r_[0, np.cumsum(mask, dtype=np.int64)])
    buf, size = words.buf, np.maximum(1, stop - begin)
    upper, alpha = (buf >= 65) & (buf <= 90), ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128)
    symbol = np.isin(buf, np.frombuffer(SYMBOLS, np.uint8))
    digit, bang = (buf >= 48) & (buf <= 57), buf == 33
    same = np.r_[False, (hashed[1:] == hashed[:-1]) & (line_of_word[1:] == line_of_word[:-1])]
    twice = np.add.reduceat(same.astype(np.int64), first)
    letters = np.maximum(1, total(alpha))
    f = np.stack(
        [
            np.ones(len(lines)),
            np.log1p(n) / 4,
            np.minimum(1, total(symbol) / np.maximum(1, n)),
            total(upper) / letters,
            np.minimum(1, total(bang) / np.maximum(1, n)),
            total(digit) / size,
            repeated.astype(float),
            twice / np.maximum(1, n),
            np.isin(buf[np.maximum(stop - 1, 0)], np.frombuffer(b".?!", np.uint8)).astype(float),
        ],
        axis=1,
    )
    return f, n, text_of, dup


def viterbi(emission: np.ndarray, stay_content: float, stay_boiler: float) -> list[bool]:
    """Best labels of a chain; ``emission`` is the score of content over boilerplate."""
    if not len(emission):
        return []
    first, *rest = emission.tolist()
    c, b = first, 0.0
    back = []
    for e in rest:
        from_c, from_b = c + stay_content >= b, c > b + stay_boiler
        back.append((from_c, from_b))
        c, b = (c + stay_content if from_c else b) + e, (c if from_b else b + stay_boiler)
    state = c >= b
    out = [state]
    for from_c, from_b in reversed(back):
        state = from_c if state else from_b
        out.append(state)
    return out[::-1]


def fit_field(chains: list[tuple[np.ndarray, int]], rounds: int = 150, rate: float = 0.5) -> np.ndarray:
    """Gradient ascent on the likelihood of the chains (features, label of all lines)."""
    # whole chains, cut into stretches; a stretch counts by its share of its document
    chains = [(f[a : a + STRETCH], y, len(f[a : a + STRETCH]) / len(f)) for f, y in chains for a in range(0, len(f), STRETCH)]
    part = np.array([p for _, _, p in chains])
    chains = [(f, y) for f, y, _ in chains]
    if not chains or len({y for _, y in chains}) < 2:
        return DEFAULT_WEIGHTS
    n, longest = len(chains), max(len(f) for f, _ in chains)
    x, mask, y = np.zeros((n, longest, N_FEATURES)), np.zeros((n, longest)), np.array([y for _, y in chains], float)
    for i, (f, _) in enumerate(chains):
        x[i, : len(f)], mask[i, : len(f)] = f, 1
    share = np.where(y == 1, 0.5 / max(1e-9, part[y == 1].sum()), 0.5 / max(1e-9, part[y == 0].sum()))
    share = share * part / np.maximum(1, mask.sum(1))
    pairs = mask[:, 1:]
    w = DEFAULT_WEIGHTS.copy()
    for _ in range(rounds):
        e, (tc, tb) = (x @ w[:N_FEATURES]) * mask, w[N_FEATURES:]
        t = np.array([[tb, 0.0], [0.0, tc]])
        unary = np.stack([np.zeros_like(e), e], axis=2)
        fwd, bwd = [unary[:, 0]], [np.zeros((n, 2))]
        for k in range(1, longest):
            step = np.logaddexp.reduce(fwd[-1][:, :, None] + t, axis=1) + unary[:, k]
            fwd.append(np.where(mask[:, k, None] > 0, step, fwd[-1]))
        for k in range(longest - 1, 0, -1):
            step = np.logaddexp.reduce(t + (unary[:, k] + bwd[-1])[:, None, :], axis=2)
            bwd.append(np.where(mask[:, k, None] > 0, step, bwd[-1]))
        bwd, z = bwd[::-1], np.logaddexp.reduce(fwd[-1], axis=1)
        p = np.exp(np.stack([fwd[k][:, 1] + bwd[k][:, 1] for k in range(longest)], 1) - z[:, None]) * mask
        g = np.einsum("nl,nlf->f", (y[:, None] - p) * mask * share[:, None], x)
        pc = pb = 0.0
        for k in range(1, longest):
            m = pairs[:, k - 1] * share
            pc += (m * np.exp(fwd[k - 1][:, 1] + tc + unary[:, k, 1] + bwd[k][:, 1] - z)).sum()
            pb += (m * np.exp(fwd[k - 1][:, 0] + tb + bwd[k][:, 0] - z)).sum()
        stay = pairs.sum(1) * share
        g = np.r_[g, (stay * y).sum() - pc, (stay * (1 - y)).sum() - pb]
        w = w + rate * 8 * g - 0.001 * w
    return w


def chains(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, int]]:
    """Features of all lines of at most ``rows`` labelled documents (smallest hashes of doc_id), with the label; for fitting only."""
    some = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").alias("_sl_id")).agg(F.min("quality").cast("int").alias("_sl_y"))
        .orderBy(F.xxhash64("_sl_id"), "_sl_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("_sl_doc"), F.col("text").alias("_sl_text"))
    got = texts.join(F.broadcast(some), F.col("_sl_doc") == F.col("_sl_id")).groupBy("_sl_id", "_sl_y").agg(F.max("_sl_text").alias("_sl_text"))

    def work(rows_: pa.RecordBatch, texts_: list[bytes]) -> pa.RecordBatch:
        words = Words(texts_, WHITESPACE_WORDS)
        f, _, text_of, _ = line_features(words, words.hashes(), texts_)
        packed = [f[text_of == i].astype("<f4").tobytes() for i in range(len(texts_))]
        return pa.RecordBatch.from_arrays([rows_.column(0), rows_.column(1), pa.array(packed, pa.binary())], ["id", "y", "f"])

    found = map_texts(got, work, "id long, y int, f binary", ("_sl_id", "_sl_y", "_sl_text")).orderBy("id").collect()
    return [(np.frombuffer(r[2], "<f4").reshape(-1, N_FEATURES).astype(float), r[1]) for r in found]


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights of the field: lines of good documents count as content, of bad ones as boilerplate."""
    return fit_field([(f, y) for f, y in chains(docs, labels) if len(f)])


def assess(docs: DataFrame, weights: np.ndarray = DEFAULT_WEIGHTS, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per document with counts, the base verdict and the field's verdict."""
    weights = np.asarray(weights, float)

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = Words(texts, WHITESPACE_WORDS)
        hashed = words.hashes()
        chars = words.per_text(words.inside & ((words.buf & 0xC0) != 0x80))
        symbols = words.per_text(np.isin(words.buf, np.frombuffer(SYMBOLS, np.uint8)))
        at, grams = windows(words, hashed, 3)
        keyed = grams ^ (words.text_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keyed, kind="stable")
        ordered = keyed[order]
        equal = np.r_[False, ordered[1:] == ordered[:-1]]
        often = np.zeros(len(at), bool)
        often[order] = equal | np.r_[equal[1:], np.zeros(min(1, len(equal)), bool)]
        covered = np.zeros(len(hashed) + 3, bool)
        for k in range(3):
            covered[at[often] + k] = True
        repeat = np.bincount(words.text_of[covered[: len(hashed)]], minlength=len(texts))
        f, n, text_of, dup = line_features(words, hashed, texts)
        emission = f @ weights[:N_FEATURES]
        content, good, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.bincount(text_of, minlength=len(texts))
        ends = np.cumsum(lines)
        for i in range(len(texts)):
            if lines[i]:
                a, b = ends[i] - lines[i], ends[i]
                marks = np.array(viterbi(emission[a:b], *weights[N_FEATURES:]))
                content[i], good[i] = n[a:b][marks].sum(), marks.sum()
        failed = (words.count < 50) | (100 * repeat > 50 * words.count)
        share = content / np.maximum(1, words.count)
        out = [words.count, chars, symbols, dup, repeat, failed, ~failed & (share >= min_content), lines, good, share]
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_content_lines", "content_share"]
        return pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, out)], names)

    return map_texts(docs, work, SCHEMA)
