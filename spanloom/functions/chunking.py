"""Long texts as tiles that fit a model: sentences, then words, then halves of words.

Tiles are slices of the text with their place, so a span found in a tile is moved
back by adding that place.  Counting tokens is up to the caller; words between
white space are the default.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column

from .rowwise import rowwise

#: fixed values: marks that close a sentence (an ASCII full stop does not), and what cannot begin one
PIECE = re.compile(r"[^。．！？!?\n]*(?:[。．！？!?\n]+|$)")
OPENING = frozenset("([{（［｛")
TILES = "array<struct<chunk:string,base:int>>"
Count = Callable[[str], int]
_INK = re.compile(r"\S")
_WORD = re.compile(r"\S+\s*")


def word_count(text: str) -> int:
    return len(text.split())


def closes(text: str, end: int) -> bool:
    """Whether a sentence can end at ``end``: what follows is neither an opening bracket nor a small letter."""
    after = _INK.search(text, end)
    return after is None or not (after[0] in OPENING or after[0].islower())


def sentence_places(text: str) -> list[tuple[int, int]]:
    """(start, end) of sentences; pieces of white space alone are no sentence, nor do they close one."""
    out, start, end = [], None, 0
    for m in PIECE.finditer(text):
        if not m[0].strip():
            continue
        start, end = m.start() if start is None else start, m.end()
        if closes(text, end):
            out.append((start, end))
            start = None
    return out if start is None else [*out, (start, end)]


def halves(text: str, start: int, end: int, budget: int, count: Count) -> Iterator[tuple[int, int]]:
    """A word cut in two until every part fits."""
    if count(text[start:end]) <= budget:
        yield start, end
    elif end - start < 2:
        raise ValueError("the token budget does not hold one character")
    else:
        middle = start + (end - start) // 2
        yield from halves(text, start, middle, budget, count)
        yield from halves(text, middle, end, budget, count)


def packed(text: str, units: list[tuple[int, int]], budget: int, count: Count, finer) -> Iterator[tuple[int, int]]:
    """Consecutive units joined while they fit; a unit that does not fit by itself is cut by ``finer``."""
    held = None
    for start, end in units:
        if count(text[start:end]) > budget:
            if held:
                yield held
            held = None
            yield from finer(start, end)
        elif held and count(text[held[0] : end]) > budget:
            yield held
            held = start, end
        else:
            held = (held[0] if held else start), end
    if held:
        yield held


def tile(text: str, max_length: int, count: Count = word_count) -> list[tuple[str, int]]:
    """Tiles (slice, place) of at most ``max_length`` tokens, two of them kept for a model's marks; a text that fits is one tile."""
    budget = max(1, max_length - 2)
    if count(text) <= budget:
        return [(text, 0)]

    def words(start: int, end: int):
        units = [(start + m.start(), start + m.end()) for m in _WORD.finditer(text[start:end])]
        return packed(text, units, budget, count, lambda a, b: halves(text, a, b, budget, count))

    return [(text[a:b], a) for a, b in packed(text, sentence_places(text), budget, count, words)]


def sentence_tiles(text: Column) -> Column:
    """Sentences of a text with their places; null gives none."""
    return rowwise(lambda t: [{"chunk": t[a:b], "base": a} for a, b in sentence_places(t or "")], TILES)(text)


def tiles(text: Column, max_length: int, count: Count = word_count) -> Column:
    """``tile`` of each text; null counts as empty."""
    return rowwise(lambda t: [{"chunk": c, "base": a} for c, a in tile(t or "", max_length, count)], TILES)(text)
