"""Column builders over text: languages, sentences, cleaning, occurrences.  Offsets count code points."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

from .rowwise import rowwise

#: fixed values: script ranges, in order of precedence
KANA_RANGES = ((0x3040, 0x309F), (0x30A0, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D))
HANGUL_RANGES = ((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7A3), (0xD7B0, 0xD7FF), (0xFFA0, 0xFFDC))
LATIN_RANGES = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0xFF), (0x100, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A))
VI_SIGNS = "\u031b\u0309\u0323\u0111\u0110"  #: horn, hook above, dot below, and the letters that do not decompose


def ranges_of(chars) -> tuple[tuple[int, int], ...]:
    """Code points as inclusive ranges."""
    out: list[list[int]] = []
    for c in sorted(chars):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return tuple(map(tuple, out))


#: every character whose canonical decomposition holds one of the signs
VI_RANGES = ranges_of(c for c in range(0x80, 0x3000) if set(unicodedata.normalize("NFD", chr(c))) & set(VI_SIGNS))


def in_ranges(ranges) -> str:
    """Pattern of one character in any of the ranges."""
    return "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges) + "]"


KANA, HANGUL, VI_MARKS, LATIN = map(in_ranges, (KANA_RANGES, HANGUL_RANGES, VI_RANGES, LATIN_RANGES))
DETECTORS: tuple[tuple[str, str], ...] = ((KANA, "ja"), (HANGUL, "ko"), (VI_MARKS, "vi"))


def detect_lang(text: Column, detectors=DETECTORS, fallback: tuple[str, str] = (LATIN, "en")) -> Column:
    """The first language in order whose script occurs, then the fallback, else ``unsupported``."""
    found = [F.when(text.rlike(p), F.lit(lang)) for p, lang in (*detectors, fallback)]
    return F.coalesce(*found, F.lit("unsupported"))


def trim_all(text: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def fold_space(text: Column) -> Column:
    return F.regexp_replace(trim_all(text), r"(?U)\s+", " ")


def strip_thinking(text: Column) -> Column:
    return trim_all(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def strip_fence(text: Column) -> Column:
    """A model's answer without its thinking and without the first and last line of a fence around it."""
    plain = strip_thinking(text)
    lines = F.split(plain, "\n")
    inner = trim_all(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n"))
    return F.when(plain.startswith("```") & plain.endswith("```"), inner).otherwise(plain)


def sentences(text: Column, lang: str = "en", least: int = 10) -> Column:
    """Sentences of a text; pieces under ``least`` characters join the next one with a space; empty gives ['']."""
    cut = r"(?<=[.!?])\s+|\n+" if lang != "ja" else r"(?<=[.!?])\s+|(?<=[。！？])|\n+"
    parts = F.filter(F.transform(F.split(text, cut), trim_all), lambda p: F.length(p) > 0)
    state = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("held"))

    def step(a: Column, p: Column) -> Column:
        joined = F.when(a["held"] == "", p).otherwise(F.concat(a["held"], F.lit(" "), p))
        full = F.length(joined) >= least
        return F.struct(
            F.when(full, F.concat(a["out"], F.array(joined))).otherwise(a["out"]).alias("out"),
            F.when(full, F.lit("")).otherwise(joined).alias("held"),
        )

    done = F.aggregate(parts, state, step, lambda a: F.when(a["held"] == "", a["out"]).otherwise(F.concat(a["out"], F.array(a["held"]))))
    return F.when(F.size(done) == 0, F.array(F.lit(""))).otherwise(done)


def regex_spans(text: Column, pattern: str) -> Column:
    """Matches with offsets, from the gaps between them: array of (s, e, m)."""
    kind = "array<struct<s:int,e:int,m:string>>"
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + F.length(x["g"])
        e = s + F.coalesce(F.length(x["m"]), F.lit(0))
        return F.struct(e.alias("at"), F.when(x["m"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))))).alias("out"))

    return F.aggregate(pairs, state, step, lambda a: a["out"])


def occurrences(text: Column, surface: Column) -> Column:
    """Start offsets of a surface in a text, overlapping ones too."""
    last = F.length(text) - F.length(surface)
    none = F.array().cast("array<int>")
    at = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.substr(text, i + 1, F.length(surface)) == surface)
    return F.when((F.length(surface) > 0) & (last >= 0) & F.contains(text, surface), at).otherwise(none)


def parse_spans(raw: Column) -> Column:
    """Surface spans (text, type) of a model's answer.

    A list counts as it is, an object with text and type as one span, another
    object by its first list; else the first shortest bracketed part is read.
    Entries without text or type go.
    """
    kind = "array<struct<text:string,type:string>>"
    clean = strip_thinking(raw)
    one = F.from_json(clean, "struct<text:string,type:string>")
    values = F.filter(F.map_values(F.from_json(clean, "map<string,string>")), lambda v: F.startswith(F.ltrim(v), F.lit("[")))
    got = F.coalesce(
        F.when(clean.startswith("["), F.from_json(clean, kind)),
        F.when(clean.startswith("{"), F.coalesce(F.when(one["text"].isNotNull() & one["type"].isNotNull(), F.array(one)), F.from_json(F.get(values, F.lit(0)), kind))),
        F.from_json(F.regexp_extract(clean, r"(?s)(\[.*?\])", 1), kind),
        F.array().cast(kind),
    )
    return F.filter(got, lambda s: s["text"].isNotNull() & s["type"].isNotNull())


#: fixed values: tag spellings by language
TAG_MAPS = {
    "ko": {"PS": "PER", "LC": "LOC", "OG": "ORG", "DT": "DAT", "PERSON": "PER", "LOCATION": "LOC", "ORGANIZATION": "ORG", "DATE": "DAT"},
    "ja": {
        "PER": "PS", "LOC": "LC", "ORG": "OG", "DAT": "DT", "TIM": "TI", "NUM": "QT", "QUANTITY": "QT", "DATE": "DT", "TIME": "TI",
        "PERSON": "PS", "LOCATION": "LC", "ORGANIZATION": "OG",
    },
    "vi": {"PERSON": "PER", "LOCATION": "LOC", "ORGANIZATION": "ORG", "MISCELLANEOUS": "MISC"},
}


def normalize_tag(tag: Column, lang: Column) -> Column:
    """B-/I- tags under a language's spelling, looked up in capitals; others stay as they are written.

    Unknown languages use the Korean map; empty and null become O; a tag without a hyphen stays.
    """
    entity = F.regexp_extract(tag, r"(?s)^[^-]*-(.*)$", 1)

    def mapped(pairs: dict[str, str]) -> Column:
        table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
        return F.coalesce(F.try_element_at(table, F.upper(entity)), entity)

    found = F.when(lang == "ja", mapped(TAG_MAPS["ja"])).when(lang == "vi", mapped(TAG_MAPS["vi"])).otherwise(mapped(TAG_MAPS["ko"]))
    prefix = F.regexp_extract(tag, r"^([^-]*)-", 1)
    return F.when((tag == "") | tag.isNull(), F.lit("O")).when(~F.contains(tag, F.lit("-")), tag).otherwise(F.concat(prefix, F.lit("-"), found))


def merge_label(label: Column, rules: dict[str, str] | None = None) -> Column:
    rules = rules or {"NAME": "PER", "ADDRESS": "LOC"}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]), label), label)


def text_match(a: Column, b: Column, least: float = 0.7) -> Column:
    """Equal after trimming, or one in the other at a length ratio of ``least`` or more; empty never matches."""
    x, y = trim_all(a), trim_all(b)
    ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))
    within = (F.contains(x, y) | F.contains(y, x)) & (ratio >= least)
    return F.coalesce((x != "") & (y != "") & ((x == y) | within), F.lit(False))


def context(text: Column, start: Column, end: Column, width: int) -> tuple[Column, Column]:
    """The ``width`` characters before and after a span, fewer at the ends of the text."""
    before = F.greatest(start - width, F.lit(0))
    return F.substr(text, (before + 1).cast("int"), (start - before).cast("int")), F.substr(text, (end + 1).cast("int"), F.lit(width))


def surface(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))


#: fixed values: endings that a Japanese surface may carry
JA_PARTICLES = ("は", "が", "を", "に", "で", "と", "の", "へ", "から", "まで", "も", "や", "より")
JA_HONORIFICS = ("氏", "さん", "君", "ちゃん", "様")


def strip_endings(text: Column) -> Column:
    """Without one particle (the longest) and then one honorific; at least one character stays."""
    for endings in (JA_PARTICLES, JA_HONORIFICS):
        text = F.regexp_replace(text, rf"(?s)(?<=.)(?:{'|'.join(sorted(endings, key=len, reverse=True))})$", "")
    return text


def collapse(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, r"(?U)\s+", "")


def plain_surface(text: Column) -> Column:
    """The form under which surfaces are compared: trimmed, no spaces."""
    return F.replace(trim_all(text), F.lit(" "), F.lit(""))


def reconstruct(tokens: Column) -> Column:
    """Text of tokens: syllables end to end, blank ones as a space; without blank ones, words with a space between."""
    blank = lambda t: trim_all(t) == ""
    return F.when(F.exists(tokens, blank), F.array_join(F.transform(tokens, lambda t: F.when(blank(t), F.lit(" ")).otherwise(t)), "")).otherwise(F.array_join(tokens, " "))


def characters(text: Column) -> Column:
    """The code points of a text, so that each is reached by its place."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def fold(text: str) -> tuple[str, list[int]]:
    """Trimmed, runs of white space as one space, and for each character its place in the original; a space stands for its run's last character."""
    chars, index = [], []
    for m in re.finditer(r"(\s+)|\S+", text):
        if m[1] is None:
            chars.append(m[0])
            index += range(*m.span())
        elif chars and m.end() < len(text):
            chars.append(" ")
            index.append(m.end() - 1)
    return "".join(chars), index


def folded(text: Column) -> Column:
    """Struct (text, index) by ``fold``; null counts as empty."""
    return rowwise(lambda t: dict(zip(("text", "index"), fold(t or ""))), "struct<text:string,index:array<int>>")(text)


def unfold(index: Column, start: Column, end: Column, size: Column) -> tuple[Column, Column]:
    """Offsets in the folded text as offsets in the original of ``size`` characters; (0, 0) stays, an empty span stands where its character stood."""
    none = (start == 0) & (end == 0)
    first = F.coalesce(F.get(index, start), size)
    return F.when(none, F.lit(0)).otherwise(first), F.when(none, F.lit(0)).when(end > start, F.get(index, end - 1) + 1).otherwise(first)


def trimmed(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """A span without white space at its ends and without full stops and commas at its end; as it was if nothing were left."""
    part = surface(text, start, end)
    lead = F.length(F.regexp_extract(part, r"(?U)^\s*", 0))
    trail = F.length(F.regexp_extract(F.substr(part, lead + 1), r"(?U)[\s.,]*$", 0))
    empty = lead + trail >= F.length(part)
    return F.when(empty, start).otherwise(start + lead), F.when(empty, end).otherwise(end - trail)


def strip_markup(sentence: Column) -> Column:
    """``<surface:TAG>`` as the surface alone."""
    return F.regexp_replace(sentence, r"<([^:>]+):[A-Z]+>", "$1")


def table_cell(text: Column) -> Column:
    """Text that may stand in a cell of a Markdown table."""
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def lang_summary(langs: Column) -> Column:
    """Languages in the order of their first place, joined by a plus; none gives a hyphen."""
    return F.when(F.size(langs) > 0, F.array_join(F.array_distinct(langs), "+")).otherwise(F.lit("-"))


def nfc(text: Column) -> Column:
    """Canonical composition; there is no built-in for it, so batches of texts are composed in Python."""
    return rowwise(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t), "string")(text)
