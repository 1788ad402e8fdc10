"""Surfaces to places, and tags between token grids.

Each rule is sequential within one text (what was taken before decides what is
free), so it is a function of a row; the wrappers at the end run them over Arrow
batches.  Null texts and null lists count as empty.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

from pyspark.sql import Column

from .rowwise import rowwise
from .text import JA_HONORIFICS, JA_PARTICLES, TAG_MAPS

PLACED = "array<struct<text:string,type:string,start:int,end:int>>"
TAGS = "array<string>"


def spelled(tag: str, lang: str) -> str:
    """A tag in a language's spelling, as ``text.normalize_tag``."""
    prefix, hyphen, entity = (tag or "O").partition("-")
    return f"{prefix}-{TAG_MAPS.get(lang, TAG_MAPS['ko']).get(entity.upper(), entity)}" if hyphen else prefix


class Taken:
    """Disjoint half-open stretches of a text that are used up."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.ends, start + 1)
        return i == len(self.starts) or self.starts[i] >= end

    def take(self, start: int, end: int) -> None:
        insort(self.starts, start)
        insort(self.ends, end)


def first_free(text: str, needle: str, taken: Taken) -> int:
    """The first place of ``needle`` that is free, else -1."""
    at = text.find(needle)
    while at >= 0 and not taken.free(at, at + len(needle)):
        at = text.find(needle, at + 1)
    return at


def without_endings(surface: str) -> str:
    for endings in (JA_PARTICLES, JA_HONORIFICS):
        fit = [e for e in endings if surface.endswith(e) and len(surface) > len(e)]
        surface = surface[: len(surface) - max(map(len, fit))] if fit else surface
    return surface


def place_surfaces(text: str, spans: list[dict]) -> list[dict]:
    """Places of surfaces: the longest first, each at its first free place; kept in the order given.

    A surface that stands nowhere is tried without white space, then without
    Japanese endings; which form is used is settled before places are looked at.
    """
    taken, out = Taken(), []
    for i in sorted(range(len(spans)), key=lambda i: -len(spans[i].get("text") or "")):
        surface, kind = ((spans[i].get(c) or "").strip() for c in ("text", "type"))
        if not (surface and kind):
            continue
        forms = (surface, re.sub(r"\s+", "", surface), without_endings(surface))
        form = next((f for f in forms if f and f in text), None)
        at = -1 if form is None else first_free(text, form, taken)
        if at >= 0:
            taken.take(at, at + len(form))
            out.append((i, {"text": form, "type": kind, "start": at, "end": at + len(form)}))
    return [x for _, x in sorted(out, key=lambda p: p[0])]


def reextract(text: str, values: list[dict], entities: list[dict]) -> list[dict] | None:
    """Places of injected values, then of the entities that were there before, without overlap.

    A value that is found nowhere, not even with other white space, makes the whole
    record fail (None); an entity that is found nowhere goes.
    """
    taken, out = Taken(), []

    def place(needle: str):
        at = first_free(text, needle, taken)
        if at >= 0:
            return at, at + len(needle)
        parts = needle.split()
        loose = re.finditer(r"\s+".join(map(re.escape, parts)), text) if len(parts) > 1 else ()
        return next((m.span() for m in loose if taken.free(*m.span())), None)

    for needed, spans in ((True, values), (False, entities)):
        for s in spans:
            found = place(s["text"]) if s["text"] else None
            if found:
                taken.take(*found)
                out.append({"text": text[found[0] : found[1]], "type": s["type"], "start": found[0], "end": found[1]})
            elif needed:
                return None
    return out


def word_tags(tokens: list[str], spans: list[dict]) -> list[str]:
    """Tags of words: a span takes the first run of equal words, else the first run that holds its words or is held by them; later spans overwrite."""
    tags = ["O"] * len(tokens)
    for s in spans:
        words, kind = (s.get("text") or "").split(), (s.get("type") or "").strip()
        runs = range(len(tokens) - len(words) + 1) if words and kind else ()
        like = lambda i: all(a in b or b in a for a, b in zip(words, tokens[i : i + len(words)]))  # noqa: B023, E731
        at = next((i for i in runs if tokens[i : i + len(words)] == words), None)
        at = next(filter(like, runs), None) if at is None else at
        if at is not None:
            tags[at : at + len(words)] = [f"B-{kind}"] + [f"I-{kind}"] * (len(words) - 1)
    return tags


def find_spaceless(text: str, needle: str, start: int = 0) -> tuple[int, int] | None:
    """The needle from ``start`` with spaces ignored on both sides; after a partial match the search goes on behind it."""
    wanted = needle.replace(" ", "")
    if not wanted:
        return None
    n, begin = 0, 0
    for i in range(start, len(text)):
        if text[i] == " ":
            continue
        if text[i] != wanted[n]:
            n = 0
            continue
        begin = i if n == 0 else begin
        n += 1
        if n == len(wanted):
            return begin, i + 1
    return None


def token_places(text: str, tokens: list[str]) -> list[tuple[int, int] | None]:
    """Where each token stands, from left to right; a blank token passes one space."""
    out, at = [], 0
    for t in tokens:
        if not t.strip():
            at += at < len(text) and text[at] == " "
            out.append(None)
            continue
        found = text.find(t, at)
        out.append((found, found + len(t)) if found >= 0 else None)
        at = found + len(t) if found >= 0 else at
    return out


def owners(text: str, tokens: list[str]) -> dict[int, int]:
    """The token of each character."""
    return {c: i for i, place in enumerate(token_places(text, tokens)) if place for c in range(*place)}


def syllable_tags(text: str, tokens: list[str], spans: list[dict], lang: str = "ko") -> list[str]:
    """Tags of syllables: equal surfaces take one place after another, then any place; tagged syllables stay."""
    owner, tags, passed = owners(text, tokens), ["O"] * len(tokens), {}
    for s in spans:
        surface, kind = ((s.get(c) or "").strip() for c in ("text", "type"))
        if not (surface and kind):
            continue
        for begin in dict.fromkeys((passed.get(surface, 0), 0)):
            at = text.find(surface, begin)
            found = (at, at + len(surface)) if at >= 0 else find_spaceless(text, surface, begin)
            if found:
                break
        else:
            continue
        passed[surface] = found[1]
        held = list(dict.fromkeys(owner[c] for c in range(*found) if c in owner))
        for n, i in enumerate(held):
            if tags[i] == "O":
                tags[i] = f"{'I' if n else 'B'}-{kind}"
    return [spelled(t, lang) for t in tags]


def aligned_tags(gold: list[str], pred: list[str], tags: list[str]) -> list[str]:
    """Predicted tags on the gold tokens: by the character in a token's middle, else by its first character; blank ones get O."""
    text, owner = " ".join(pred), {}
    at = 0
    for i, t in enumerate(pred):
        owner |= dict.fromkeys(range(at, at + len(t)), i)
        at += len(t) + 1
    out, at = [], 0
    for t in gold:
        found, size = (text.find(t, at), len(t)) if t.strip() else (-1, 0)
        if found < 0 and t.strip():
            found, size = text.find(t[0], at), 1
        i = owner.get(found + size // 2) if found >= 0 else None
        out.append(tags[i] if i is not None and i < len(tags) else "O")
        at = found + size if found >= 0 else at
    return out


def align(gold: list[str], pred: list[str], tags: list[str], lang: str = "ko") -> list[str]:
    """Predicted tags, spelled for the language, on the gold tokens."""
    tags = [spelled(t, lang) for t in tags]
    return tags if gold == pred else aligned_tags(gold, pred, tags)


def voted_tags(text: str, tokens: list[str], found: list[dict], lang: str = "ko") -> list[str]:
    """Tags by the highest score of any prediction on a token; the first of equal scores stays; runs of one type begin once."""
    if not text.strip():
        return ["O"] * len(tokens)
    owner, tags, best = owners(text, tokens), ["O"] * len(tokens), [0.0] * len(tokens)
    for f in found:
        if f["entity"] in (None, "", "O", "PAD"):
            continue
        for i in dict.fromkeys(owner[c] for c in range(f["start"], f["end"]) if c in owner):
            if f["score"] > best[i]:
                best[i], tags[i] = f["score"], spelled(f["entity"], lang)
    last = None
    for i, tag in enumerate(tags):
        prefix, hyphen, kind = tag.partition("-")
        if hyphen and prefix == "B" and kind == last:
            tags[i] = f"I-{kind}"
        last = kind if hyphen and prefix in ("B", "I") else None
    return tags


def word_places(text: str, words: list[str]) -> list[dict]:
    """Places of segmented words, whose syllables are joined by underscores, by a cursor that never goes back.

    A syllable that is not found is passed over; a word without any found goes.
    """
    out, at = [], 0
    for w in words:
        held = []
        for part in filter(None, w.split("_")):
            found = text.find(part, at)
            if found >= 0:
                at = found + len(part)
                held += [found, at]
        if held:
            out.append({"text": w, "start": held[0], "end": held[-1]})
    return out


def spread_tags(syllables: list[str], tags: list[str]) -> list[str]:
    """Tags of words on their syllables: blank ones part the words and get O; after a word's first syllable B- becomes I-."""
    out, word, first = [], 0, True
    for s in syllables:
        if not s.strip():
            out.append("O")
            word, first = word + 1, True
            continue
        tag = tags[word] if word < len(tags) else "O"
        out.append(tag if first or not tag.startswith("B-") else f"I-{tag[2:]}")
        first = False
    return out


def _safe(fn):
    return lambda *values: fn(*[("" if i == 0 else []) if v is None else v for i, v in enumerate(values)])


def placed(text: Column, spans: Column) -> Column:
    return rowwise(_safe(place_surfaces), PLACED)(text, spans)


def reextracted(text: Column, values: Column, entities: Column) -> Column:
    return rowwise(_safe(reextract), PLACED)(text, values, entities)


def tagged_words(tokens: Column, spans: Column) -> Column:
    return rowwise(lambda t, s: word_tags(t or [], s or []), TAGS)(tokens, spans)


def tagged_syllables(text: Column, tokens: Column, spans: Column, lang: str = "ko") -> Column:
    return rowwise(_safe(lambda t, k, s: syllable_tags(t, k, s, lang)), TAGS)(text, tokens, spans)


def tags_on(gold: Column, pred: Column, tags: Column, lang: str = "ko") -> Column:
    return rowwise(lambda g, p, t: align(g or [], p or [], t or [], lang), TAGS)(gold, pred, tags)


def tags_by_vote(text: Column, tokens: Column, found: Column, lang: str = "ko") -> Column:
    return rowwise(_safe(lambda t, k, f: voted_tags(t, k, f, lang)), TAGS)(text, tokens, found)


def placed_words(text: Column, words: Column) -> Column:
    return rowwise(_safe(word_places), "array<struct<text:string,start:int,end:int>>")(text, words)


def word_tags_on_syllables(syllables: Column, tags: Column, lang: str = "ko") -> Column:
    return rowwise(lambda s, t: spread_tags(s or [], [spelled(x, lang) for x in t or []]), TAGS)(syllables, tags)
