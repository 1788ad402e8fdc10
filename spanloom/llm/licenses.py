"""License scans: phrases, and templates compiled to token automata.

A template is a line of words with two kinds of markup: ``{{...}}`` marks an
optional region, ``<<n>>`` a replaceable one of at most n words.  It compiles to
a nondeterministic automaton over words; a text is accepted where all mandatory
words stand exactly, in order, with nothing else between them.

Defined cases: a null or empty text has no words, no labels and score 0; the
score is 1 if an automaton accepts, 0.5 if only a phrase stands there, else 0.
Of templates that begin
at one place all that accept count, each by its shortest run.  An empty table gives
none; very long texts are read whole; other columns are not looked at, whatever their
names.  Repeated rows each give a row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import Words, map_texts, word_table

#: fixed values: phrases and their labels
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: own templates of license lines and notices, by label
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license {{version}} 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license {{v}} {{version}} 3 {{0}}"),
    ("gpl-2.0", "licensed under the gnu general public license {{v}} {{version}} 2 {{0}}"),
    ("gpl-3.0", "gnu general public license as published by the free software foundation {{either}} version 3"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation {{either}} version 2"),
    ("cc-by-4.0", "licensed under {{a}} {{the}} cc by {{license}} 4 0"),
    ("cc-by-sa-4.0", "licensed under {{a}} {{the}} cc by sa {{license}} 4 0"),
    ("cc-by-nc-4.0", "licensed under {{a}} {{the}} cc by nc {{license}} 4 0"),
    ("cc-by-nd-4.0", "licensed under {{a}} {{the}} cc by nd {{license}} 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under {{a}} {{the}} cc by nc sa {{license}} 4 0"),
    ("cc-by-nc-nd-4.0", "licensed under {{a}} {{the}} cc by nc nd {{license}} 4 0"),
    ("mit-line", "released under the {{terms of the}} mit license"),
    ("mit-line", "licensed under the {{terms of the}} mit license"),
    ("mit-line", "distributed under the {{terms of the}} mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("copyright-line", "copyright {{c}} <<6>> all rights reserved"),
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MEMBERS = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(0x80, 0x100))
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_accepted long"
)


class Automaton:
    """States 0..n; ``step[s]`` lists (word or None for any, next state), ``skip[s]`` moves without a word."""

    def __init__(self, template: str):
        self.step: list[list[tuple[bytes | None, int]]] = [[]]
        self.skip: list[list[int]] = [[]]
        for part in re.findall(r"\{\{.*?\}\}|<<\d+>>|[^{}<>]+", template):
            begin = len(self.step) - 1
            if part.startswith("<<"):
                for _ in range(int(part[2:-2])):
                    self._add(None)
                for s in range(begin, len(self.step) - 1):
                    self.skip[s].append(len(self.step) - 1)
            else:
                for word in WORD.findall(part.encode()):
                    self._add(word)
                if part.startswith("{{"):
                    self.skip[begin].append(len(self.step) - 1)
        self.final = len(self.step) - 1
        self.closed = [self._closure(s) for s in range(len(self.step))]
        self.firsts = {w for s in self.closed[0] for w, _ in self.step[s]}

    def _add(self, word: bytes | None) -> None:
        self.step[-1].append((word, len(self.step)))
        self.step.append([])
        self.skip.append([])

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = set(), [s]
        while todo:
            if (x := todo.pop()) not in seen:
                seen.add(x)
                todo += self.skip[x]
        return frozenset(seen)

    def accepts(self, words: list[bytes], at: int) -> int | None:
        """End of the shortest accepted run of words that begins at ``at``."""
        states = self.closed[0]
        for i in range(at, len(words) + 1):
            if self.final in states:
                return i
            if i == len(words) or not states:
                return None
            states = frozenset(x for s in states for w, t in self.step[s] if w is None or w == words[i] for x in self.closed[t])
        return None


AUTOMATA = tuple((label, Automaton(t)) for label, t in TEMPLATES)
_PHRASES = tuple((tuple(p.encode().split()), label) for p, label in PHRASES)
_FIRSTS = {w for p, _ in _PHRASES for w in p[:1]} | {w for _, a in AUTOMATA for w in a.firsts}


def find(words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str]]]:
    """Places of phrases, and (start, end, label) of accepted templates."""
    base, accepted = [], []
    for i, w in enumerate(words):
        if w in _FIRSTS:
            base += [(i, label) for p, label in _PHRASES if w == p[0] and tuple(words[i : i + len(p)]) == p]
            accepted += [(i, e, label) for label, a in AUTOMATA if w in a.firsts and (e := a.accepts(words, i)) is not None]
    return base, accepted


#: words without one of which neither a phrase nor a template can stand
NEEDED = (b"license", b"permission", b"redistribution", b"copyright", b"cc")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with the places of phrases and the labels."""

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        n = Words(texts, word_table(members=MEMBERS)).count
        out = []
        for t in texts:
            low = t.lower()  # of bytes: A-Z only
            base, accepted = find(WORD.findall(low)) if any(k in low for k in NEEDED) else ([], [])
            at = [i for i, _ in base]
            kept = {label for _, label in base}
            out.append((len(base), min(at, default=None), max(at, default=None), ",".join(sorted(kept)), ",".join(sorted(kept | {x[2] for x in accepted})), 1.0 if accepted else 0.5 if base else 0.0, len(accepted)))
        cols = list(zip(*out)) if out else [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_accepted"]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return map_texts(docs, work, SCHEMA)
