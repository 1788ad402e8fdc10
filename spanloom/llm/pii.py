"""Personal data by candidates and boosted trees, in DataFrame and SQL expressions.

Four base patterns (leftmost, non-overlapping per kind, failing matches dropped)
always count.  High-recall generators propose further, overlapping spans; boosted
trees over format and context features score them, and a calibrated threshold
per kind selects.  Offsets come from the gaps between matches, so they count
code points.  Executors run no Python: trees are CASE expressions.

The trees are fitted on the driver on a seeded synthetic sample of
``FIT_ROWS`` candidates; half of it calibrates the thresholds.
Patterns use possessive loops and look-behinds that change no match but keep
the search linear on very long runs.

Defined cases: a null or empty text has no spans (the digest is that of the
empty string); equal or overlapping base spans of several kinds all stay; an
added span that overlaps a base span, or an added one before it, is dropped;
repeated rows each give a row; other columns are left alone by ``redact``, but their
names must not begin with ``_sl_``.  An empty table gives none; very long texts are
read whole.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

FIT_ROWS, ROUNDS, DEPTH, RATE = 3000, 40, 3, 0.3
PRECISION = 0.98
#: base kinds: pattern, cheap test of the text, test of a match m
BASE = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(t, '@')", "true"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "t rlike r'[0-9]\\.[0-9]'", r"m rlike r'^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$'"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "t rlike r'[0-9][0-9 -][0-9]'", "{luhn}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "t rlike r'\\+[0-9]'", "length(regexp_replace(m, '[^0-9]', '')) between 9 and 15"),
)
LUHN = """length(regexp_replace(m, '[^0-9]', '')) between 13 and 19 and aggregate(
  transform(sequence(1, least(19, length(regexp_replace(m, '[^0-9]', '')))),
    i -> (int(substring(reverse(regexp_replace(m, '[^0-9]', '')), i, 1)) * if(i % 2 = 0, 2, 1))),
  0, (s, x) -> s + if(x > 9, x - 9, x)) % 10 = 0"""
#: generators: kind, pattern, cheap test, words that speak for the kind in the text before
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++", "t rlike r'[\\[(]at[\\])]'", "mail contact write reach"),
    ("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", "t rlike r'[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:'", "ip host address server client"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[./_\x20-]{1,2}[0-9]{4}){3}(?![0-9])", "t rlike r'[0-9]{4}[./_ -]'", "card visa mastercard credit payment"),
    ("phone", r"(?<![0-9(])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "t rlike r'[0-9]{3}[ .-][0-9]{4}'", "phone tel call mobile fax"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "t rlike r'[0-9]-[0-9]{2}-[0-9]'", "ssn social security"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "t rlike r'[A-Z]{2}[0-9]{2}'", "iban account bank transfer"),
)
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
FEATURES = ("digits", "letters", "seps", "size", "context", "left_word", "right_word", "kinds", "sep_kinds", "first_digit", "against")
#: words before a span that speak for a plain number
AGAINST = "order|version|isbn|part|total|table|invoice|item"


def _q(pattern: str) -> str:
    return "r'" + pattern + "'"


def _feature_sql(kind: str, words: str) -> str:
    """A struct of features of a match x (m: match, l: text before, r: text after)."""
    context = "|".join(words.split())
    return f"""named_struct(
      'digits', length(regexp_replace(x.m, '[^0-9]', '')), 'letters', length(regexp_replace(x.m, '[^A-Za-z]', '')),
      'seps', length(regexp_replace(x.m, '[A-Za-z0-9]', '')), 'size', length(x.m),
      'context', int(lower(x.l) rlike '{context}'), 'left_word', int(x.l rlike '[A-Za-z0-9.,-]$'),
      'right_word', int(x.r rlike '^([A-Za-z0-9]|[.,-][0-9])'), 'kinds', {KINDS.index(kind)},
      'sep_kinds', size(array_distinct(regexp_extract_all(x.m, '[^A-Za-z0-9]', 0))),
      'first_digit', int(coalesce(try_cast(substring(regexp_extract(x.m, '[0-9]', 0), 1, 1) as int), -1)),
      'against', int(lower(x.l) rlike '{AGAINST}'))"""


def features(kind: str, m: str, left: str, right: str) -> list[float]:
    """The same features, for fitting."""
    words = next(w for k, _, _, w in GENERATORS if k == kind)
    d = re.sub("[^0-9]", "", m)
    return [
        len(d), len(re.sub("[^A-Za-z]", "", m)), len(re.sub("[A-Za-z0-9]", "", m)), len(m),
        bool(re.search("|".join(words.split()), left.lower())), bool(re.search("[A-Za-z0-9.,-]$", left)),
        bool(re.search("^([A-Za-z0-9]|[.,-][0-9])", right)), KINDS.index(kind),
        len(set(re.findall("[^A-Za-z0-9]", m))), int(d[0]) if d else -1, bool(re.search(AGAINST, left.lower())),
    ]


def synthetic(n: int = FIT_ROWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Seeded candidates of all kinds, personal or not, with the text around them."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    rows, labels = [], []
    for i in range(n):
        kind, _, _, words = GENERATORS[i % len(GENERATORS)]
        good = rng.random() < 0.5
        sep = rng.choice(" -.")
        m = {
            "email": lambda: f"{rng.choice(['ann', 'j.doe', 'info7'])}{rng.choice(['', ' '])}[at]{rng.choice(['', ' '])}mail{rng.choice(['.', '[dot]'])}com",
            "ip": lambda: ":".join("".join(rng.choices("0123456789abcdef", k=rng.randint(1, 4))) for _ in range(8)),
            "card": lambda: (sep if good else rng.choice("./_")).join(digits(4) for _ in range(4)),
            "phone": lambda: f"({digits(3)}) {digits(3)}-{digits(4)}" if rng.random() < 0.4 else f"{digits(3)}{sep}{digits(3)}{sep}{digits(4)}",
            "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
            "iban": lambda: "DE" + digits(2) + rng.choice(["", " "]).join([""] + [digits(4) for _ in range(4)]) + digits(2),
        }[kind]()
        if good:
            left = f"{rng.choice(['', 'my ', 'the '])}{rng.choice(words.split())}{rng.choice([': ', ' ', ' is '])}"
            if kind in ("email", "ip", "iban") and rng.random() < 0.4:
                left = "so "
            right = rng.choice([" ", ". ", "", ", and"])
        else:
            left = rng.choice(["order ", "version ", "isbn ", "part no ", "total ", "id-", "x", "1.", "table "])
            right = rng.choice(["", " ", "7", "-1", ".5", " units"])
        rows.append(features(kind, m, left, right))
        labels.append(good)
    return np.array(rows, float), np.array(labels, float)


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    """Nested (feature, threshold, below, over) or a leaf value."""
    leaf = float(grad.sum() / (hess.sum() + 1.0))
    if not depth or len(x) < 20:
        return leaf
    best, base = None, grad.sum() ** 2 / (hess.sum() + 1.0)
    for f in range(x.shape[1]):
        for cut in (np.unique(x[:, f])[:-1] + np.unique(x[:, f])[1:]) / 2:
            low = x[:, f] < cut
            gl, hl, gh, hh = grad[low].sum(), hess[low].sum(), grad[~low].sum(), hess[~low].sum()
            gain = gl * gl / (hl + 1.0) + gh * gh / (hh + 1.0) - base
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, f, float(cut))
    if best is None:
        return leaf
    _, f, cut = best
    low = x[:, f] < cut
    return f, cut, _tree(x[low], grad[low], hess[low], depth - 1), _tree(x[~low], grad[~low], hess[~low], depth - 1)


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] < cut, _value(low, x), _value(high, x))


@lru_cache
def fitted(rounds: int = ROUNDS, depth: int = DEPTH, precision: float = PRECISION):
    """Trees, and for each kind the least score whose calibrated precision is high enough."""
    x, y = synthetic()
    half = np.arange(len(x)) // len(GENERATORS) % 2 == 0
    score, trees = np.zeros(len(x)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _tree(x[half], (y - p)[half], (p * (1 - p))[half], depth)
        trees.append(tree)
        score += RATE * _value(tree, x)
    cuts = {}
    for i, kind in enumerate(KINDS):
        rest = ~half & (x[:, 7] == i)
        order = np.argsort(-score[rest])
        s, hit = score[rest][order], np.cumsum(y[rest][order]) / np.arange(1, rest.sum() + 1)
        ok = np.flatnonzero(hit >= precision)
        cuts[kind] = float(s[ok[-1]]) if len(ok) else float("inf")
    return tuple(trees), cuts, score, y, half


def _tree_sql(tree) -> str:
    if isinstance(tree, float):
        return f"double('{tree!r}')"
    f, cut, low, high = tree
    return f"if(f.{FEATURES[f]} < {cut!r}D, {_tree_sql(low)}, {_tree_sql(high)})"


def _matches(pattern: str, test: str) -> str:
    """Matches in order with offsets: array of (s, e, m, l, r)."""
    p = _q(pattern)
    return f"""if(not ({test}), cast(array() as array<struct<s:int,e:int,m:string,l:string,r:string>>), aggregate(
      zip_with(zip_with(split(t, {p}, -1), regexp_extract_all(t, {p}, 0), (g, m) -> named_struct('g', g, 'm', m)),
               slice(split(t, {p}, -1), 2, greatest(1, length(t))), (x, n) -> named_struct('g', x.g, 'm', x.m, 'n', n)),
      named_struct('at', 0, 'out', cast(array() as array<struct<s:int,e:int,m:string,l:string,r:string>>)),
      (a, x) -> named_struct('at', a.at + length(x.g) + coalesce(length(x.m), 0),
        'out', if(x.m is null, a.out, concat(a.out, array(named_struct('s', a.at + length(x.g),
          'e', a.at + length(x.g) + length(x.m), 'm', x.m, 'l', right(x.g, 32), 'r', left(coalesce(x.n, ''), 8)))))),
      a -> a.out))"""


def _base_sql(kind: str) -> str:
    _, pattern, test, valid = next(b for b in BASE if b[0] == kind)
    valid = re.sub(r"\bm\b(?!')", "x.m", valid.format(luhn=LUHN) if "{luhn}" in valid else valid)
    return f"filter({_matches(pattern, test)}, x -> {valid})"


def _added_sql(kind: str) -> str:
    _, pattern, test, words = next(g for g in GENERATORS if g[0] == kind)
    trees, cuts, *_ = fitted()
    score = " + ".join(_tree_sql(t) for t in trees)
    cut = cuts[kind] / RATE
    if not np.isfinite(cut):
        return "cast(array() as array<struct<s:int,e:int,m:string,l:string,r:string>>)"
    flags = f"transform(transform({_matches(pattern, test)}, x -> named_struct('x', x, 'f', {_feature_sql(kind, words)})), y -> named_struct('x', y.x, 'z', exists(array(y.f), f -> {score} >= double('{cut - 1e-9!r}'))))"
    return f"transform(filter({flags}, y -> y.z), y -> y.x)"


SPANS = "array<struct<s:int,e:int,k:int,base:boolean>>"


def detect(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """``docs`` with the array of spans (s, e, k: place in KINDS, base) by kind, then start; ends exclusive."""
    plain = docs.withColumn("_sl_t", F.coalesce(F.col(text), F.lit("")))
    name = lambda sql: re.sub(r"\bt\b(?=[, )]| rlike)", "_sl_t", sql)
    for kind, *_ in BASE:
        plain = plain.withColumn(f"_sl_b_{kind}", F.expr(name(_base_sql(kind))))
    for kind, *_ in GENERATORS:
        plain = plain.withColumn(f"_sl_a_{kind}", F.expr(name(_added_sql(kind))))
    tag = lambda column, k, base: f"transform({column}, x -> named_struct('s', x.s, 'e', x.e, 'k', {k}, 'base', {base}))"
    every = ", ".join([tag(f"_sl_b_{k}", KINDS.index(k), "true") for k, *_ in BASE] + [tag(f"_sl_a_{k}", KINDS.index(k), "false") for k, *_ in GENERATORS])
    # by start, base first: an added span that overlaps what is kept is left out
    order = "(a, b) -> case when a.s <> b.s then a.s - b.s when a.base <> b.base then if(a.base, -1, 1) when a.e <> b.e then b.e - a.e else a.k - b.k end"
    sweep = f"""aggregate(array_sort(concat({every}), {order}),
      named_struct('top', 0, 'out', cast(array() as {SPANS})),
      (a, x) -> if(x.base,
        named_struct('top', greatest(a.top, x.e), 'out', concat(
          if(size(a.out) > 0 and not try_element_at(a.out, -1).base and try_element_at(a.out, -1).e > x.s, slice(a.out, 1, greatest(0, size(a.out) - 1)), a.out), array(x))),
        if(x.s < a.top, a, named_struct('top', greatest(a.top, x.e), 'out', concat(a.out, array(x))))),
      a -> a.out)"""
    by_kind = "array_sort(_sl_all, (a, b) -> case when a.k <> b.k then a.k - b.k when a.s <> b.s then a.s - b.s else a.e - b.e end)"
    quiet = " + ".join(f"size(_sl_b_{k})" for k, *_ in BASE) + " + " + " + ".join(f"size(_sl_a_{k})" for k, *_ in GENERATORS)
    plain = plain.withColumn("_sl_all", F.expr(f"if({quiet} = 0, cast(array() as {SPANS}), {sweep})"))
    return plain.withColumn(out, F.expr(by_kind)).drop("_sl_t", "_sl_all", *[f"_sl_b_{k}" for k, *_ in BASE], *[f"_sl_a_{k}" for k, *_ in GENERATORS])


def listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat(element_at({names}, x.k + 1), ':', x.s, ':', x.e)), ',')"


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in square brackets; other columns unchanged."""
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    # array_sort, not sort_array: by start, longest first, so that a span inside another goes with it
    order = "(a, b) -> case when a.s <> b.s then a.s - b.s when a.e <> b.e then b.e - a.e else a.k - b.k end"
    clean = f"""if(size(_sl_spans) = 0, `{text}`, aggregate(array_sort(_sl_spans, {order}), named_struct('at', 0, 'out', ''),
      (a, x) -> if(x.s < a.at, named_struct('at', greatest(a.at, x.e), 'out', a.out),
        named_struct('at', x.e, 'out', concat(a.out, substring(`{text}`, a.at + 1, x.s - a.at), element_at({names}, x.k + 1)))),
      a -> concat(a.out, substring(`{text}`, a.at + 1, length(`{text}`)))))"""
    return detect(docs, text, "_sl_spans").withColumn(text, F.expr(clean)).drop("_sl_spans")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans."""
    found = detect(docs.select("doc_id", "text")).drop("text")
    counts: list[Column] = [F.expr(f"bigint(size(filter(pii_spans, x -> x.base and x.k = {KINDS.index(k)})))").alias(f"n_{k}") for k, *_ in BASE]
    base = F.expr(f"sha2({listed('filter(pii_spans, x -> x.base)')}, 256)").alias("base_sha256")
    added = F.expr("bigint(size(filter(pii_spans, x -> not x.base)))").alias("n_added")
    return found.select("doc_id", *counts, base, F.expr(listed("pii_spans")).alias("spans"), added)
