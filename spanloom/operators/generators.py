"""Synthetic personal data as columns: every value follows from (seed, record, label), so it can be drawn anywhere and again.

Lists of names, places and domains are our own and neutral.  Values are made so
that they cannot belong to anyone: reserved telephone numbers, areas that are never
issued, check digits that are wrong, no valid card numbers on purpose.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

LABELS = ("NAME", "PHONE", "ADDRESS", "DAT", "ID_NUM", "EMAIL", "CREDIT_CARD")
#: fixed values: shares of the forms of a mail address's local part, and of its variations, in hundredths
FORMS = (("dot", 30), ("plain", 22), ("single", 20), ("initial", 15), ("underscore", 8), ("hyphen", 5))
CAPITALS, DIGITS_BEFORE, DIGITS_AFTER = 10, 2, 26
IINS = ("4", "5", "34", "37", "3528", "3569")
CARD_SEPARATORS = (" ", "-", "", "  ")
RRN_WEIGHTS = (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)
NEVER_ISSUED = ["000", "666", *map(str, range(900, 1000))]

LOCALES: dict[str, dict] = {
    "ja": {
        "family": ["青山", "川村", "野原", "石田", "森下", "浜口"], "given": ["一", "恵子", "健太", "美咲", "翔", "直樹"],
        "mail_family": ["aoyama", "kawamura", "nohara", "ishida"], "mail_given": ["keiko", "kenta", "misaki", "naoki"],
        "domains": ["example.co.jp", "example.ne.jp"], "region": ["東京都", "大阪府", "北海道", "愛知県"], "town": ["中央区本町", "青葉町", "緑区桜台", "港町"],
    },
    "ko": {
        "family": ["김", "박", "최", "윤", "한", "노"], "given": ["가람", "보라", "다온", "마루", "나래", "하늘"],
        "mail_family": ["kim", "park", "yoon", "han"], "mail_given": ["garam", "bora", "maru", "haneul"],
        "domains": ["example.kr", "example.co.kr"], "region": ["서울특별시", "부산광역시", "경기도", "강원도"], "town": ["중구", "남구", "동구", "북구"],
        "road": ["새싹로", "한빛로", "솔밭로"], "block": ["새동", "달동", "별동"],
    },
    "vi": {
        "family": ["Nguyen", "Tran", "Le", "Pham"], "middle": ["Van", "Thi", "Duc", "Minh"], "given": ["An", "Binh", "Chi", "Dung"],
        "family_marks": ["Nguyễn", "Trần", "Lê", "Phạm"], "middle_marks": ["Văn", "Thị", "Đức", "Minh"], "given_marks": ["Ân", "Bình", "Chí", "Dũng"],
        "mail_family": ["nguyen", "tran", "pham"], "mail_given": ["an", "binh", "dung"], "domains": ["example.vn", "example.com.vn"],
        "region": ["Hanoi", "Hue", "Da Nang"], "town": ["Quan 1", "Quan 3", "Ba Dinh"], "road": ["Le Loi", "Tran Phu", "Hai Ba Trung"],
    },
    "en": {
        "family": ["Abel", "Brandt", "Costa", "Duval", "Egger", "Falk"], "given": ["Alda", "Boris", "Cleo", "Dario", "Edda", "Fynn"], "middle": list("ABCDEFGH"),
        "mail_family": ["abel", "brandt", "costa", "duval"], "mail_given": ["alda", "boris", "cleo", "edda"], "domains": ["example.com", "example.org", "example.net"],
        "region": ["Springfield, OH", "Riverton, UT", "Fairview, TX"], "road": ["Elm Street", "Harbor Road", "Mill Lane", "Park Avenue"],
        "area": ["202", "303", "404", "505"], "months": "January February March April May June July August September October November December".split(),
    },
}


def draw(seed: int, key: Column, name: str, n: int) -> Column:
    """A number in [0, n) from a portable hash of (seed, key, name)."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(name))), 1, 8), 16, 10).cast("long")
    return h % n


class Draws:
    """Draws of one record and label; each has its own name."""

    def __init__(self, seed: int, key: Column, label: str):
        self.seed, self.key, self.label = seed, key, label

    def number(self, name: str, n: int, first: int = 0) -> Column:
        return draw(self.seed, self.key, f"{self.label}.{name}", n) + first

    def digits(self, name: str, n: int) -> Column:
        return F.concat(*[self.number(f"{name}{i}", 10).cast("string") for i in range(n)])

    def padded(self, name: str, n: int, first: int, width: int = 2) -> Column:
        return F.lpad(self.number(name, n, first).cast("string"), width, "0")

    def pick(self, name: str, values) -> Column:
        if not any(isinstance(v, Column) for v in values):
            return F.element_at(F.array(*map(F.lit, values)), self.number(name, len(values), 1).cast("int"))
        at, out = self.number(name, len(values)), None
        for i, v in enumerate(values):  # only the one that is drawn is made
            out = F.when(at == i, v) if out is None else out.when(at == i, v)
        return out

    def weighted(self, name: str, choices) -> Column:
        """One of (value, weight), in proportion to the weights."""
        at, total, out = self.number(name, sum(w for _, w in choices)), 0, None
        for value, weight in choices:
            total += weight
            value = value if isinstance(value, Column) else F.lit(value)
            out = F.when(at < total, value) if out is None else out.when(at < total, value)
        return out

    def shaped(self, name: str, patterns, **parts: Column) -> Column:
        """One of the patterns, with its named parts filled in."""
        return self.pick(name, [filled(p, parts) for p in patterns])


def filled(pattern: str, parts: dict[str, Column]) -> Column:
    """``{name}`` in a pattern as the part of that name."""
    bits = re.split(r"\{(\w+)\}", pattern)
    return F.concat(*[parts[b].cast("string") if i % 2 else F.lit(b) for i, b in enumerate(bits) if b or i % 2])


def name(d: Draws, lang: str) -> Column:
    at = LOCALES[lang]
    family, given = d.pick("family", at["family"]), d.pick("given", at["given"])
    if lang == "ja":
        return F.when(d.number("space", 100) < 20, F.concat(family, F.lit(" "), given)).otherwise(F.concat(family, given))
    if lang == "ko":
        return F.concat(family, given)
    if lang == "vi":
        marked = F.concat_ws(" ", *[d.pick(c, at[f"{c}_marks"]) for c in ("family", "middle", "given")])
        return F.when(d.number("marks", 100) < 40, marked).otherwise(F.concat_ws(" ", family, d.pick("middle", at["middle"]), given))
    initial = F.concat(given, F.lit(" "), d.pick("middle", at["middle"]), F.lit(". "), family)
    return F.when(d.number("initial", 100) < 25, initial).otherwise(F.concat(given, F.lit(" "), family))


def phone(d: Draws, lang: str) -> Column:
    a3, a4, b4 = d.digits("a", 3), d.digits("b", 4), d.digits("c", 4)
    if lang == "ja":
        mobile = d.shaped("m", ["0{p}-{a}-{b}", "0{p}{a}{b}", "+81-{p}-{a}-{b}", "+81(0){p}-{a}-{b}", "+81 {p} {a} {b}", "(0{p}){a}-{b}", "0{p}.{a}.{b}", "0{p}/{a}/{b}"], p=d.pick("carrier", ["70", "80", "90"]), a=a4, b=b4)
        forms = ["0{p}-{a}-{b}", "+81-{p}-{a}-{b}", "(0{p}){a}-{b}", "0{p}{a}{b}"]
        city = d.shaped("l", forms, p=d.pick("area2", ["3", "6"]), a=a4, b=b4)
        town = d.shaped("l", forms, p=d.pick("area3", ["11", "22", "45", "52", "75", "92", "96", "78"]), a=a3, b=b4)
        free = F.when(d.number("free", 2) == 0, d.shaped("f", ["0120-{a}-{b}", "0120{a}{b}", "0120 {a} {b}"], a=a3, b=d.digits("d", 3))).otherwise(d.shaped("f", ["0800-{a}-{b}", "0800{a}{b}", "0800 {a} {b}"], a=a3, b=b4))
        net = d.shaped("n", ["050-{a}-{b}", "+81-50-{a}-{b}", "050{a}{b}"], a=a4, b=b4)
        return d.weighted("kind", [(mobile, 60), (F.when(d.number("city", 2) == 0, city).otherwise(town), 22), (free, 10), (net, 8)])
    if lang == "ko":
        forms = ["{p}-{a}-{b}", "{p} {a} {b}", "{p}.{a}.{b}", "{p}{a}{b}"]

        def number(prefix: Column, middle: Column) -> Column:
            abroad = F.concat(F.lit("+82 "), F.regexp_replace(prefix, "^0", ""), F.lit("-"), middle, F.lit("-"), b4)
            return d.pick("form", [*(filled(f, {"p": prefix, "a": middle, "b": b4}) for f in forms), abroad])

        areas = ["031", "032", "033", "041", "042", "043", "044", "051", "052", "053", "054", "055", "061", "062", "063", "064"]
        short = F.when(d.number("long", 2) == 0, a3).otherwise(a4)
        return d.weighted("kind", [(number(F.lit("010"), a4), 62), (number(F.lit("070"), a4), 8), (number(F.lit("02"), short), 12), (number(d.pick("area", areas), a3), 18)])
    if lang == "vi":
        parts = {"p": d.pick("prefix", ["09", "03", "07", "08", "05"]), "r": d.digits("r", 8), "x": a3, "y": d.digits("y", 2), "z": d.digits("z", 2)}
        return d.shaped("form", ["{p}{r}", "{p}{x} {y} {z}", "+84{p}{r}", "+84 {p}{x} {y} {z}", "(+84) {p}{x}-{y}-{z}", "0{r}"], **parts)
    line = d.padded("line", 100, 100, 4)
    return d.shaped("form", ["({a}) 555-{l}", "{a}-555-{l}", "{a}.555.{l}", "+1 {a} 555 {l}", "+1-{a}-555-{l}", "1-{a}-555-{l}", "555-{l}"], a=d.pick("area", LOCALES["en"]["area"]), l=line)


def address(d: Draws, lang: str) -> Column:
    at = LOCALES[lang]
    parts = {c: d.pick(c, at[c]) for c in ("region", "town", "road", "block") if c in at}
    parts |= {"n": d.number("n", 500, 1), "m": d.number("m", 40, 1), "f": d.number("f", 20, 1), "z3": d.digits("z", 3), "z4": d.digits("w", 4), "z5": d.padded("zip", 99_000, 1000, 5), "c": d.number("c", 5, 1)}
    patterns = {
        "ja": ["{region}{town}{c}丁目{n}-{m}", "{region}{town}{n}-{m}", "{region} {town} {c}丁目{n}-{m}", "{region}{town}{c}丁目{n}-{m} ビル{f}F", "〒{z3}-{z4} {region}{town}{c}丁目{n}-{m}"],
        "ko": ["{region} {town} {road} {n}", "{region} {town} {road} {n}길 {m}", "{region} {town} {road} {n} 타워 {f}층", "{region} {town} {block} {n}", "{region} {town} {block} {n}-{m}", "{region} {town} {block} {n}-{m} 빌라 {f}호"],
        "vi": ["{n} {road}, {town}, {region}", "Số {n} {road}, {town}, {region}", "{n}/{m} {road}, {town}, {region}", "{n} {road} - {town} - {region}", "P.{f}, {n} {road}, {town}, {region}"],
        "en": ["{n} {road}, {region} {z5}", "{n} {road}, {region}", "{n} {road} Apt {m}, {region} {z5}", "{n} {road} Suite {m}, {region} {z5}", "{n} {road}"],
    }
    return d.shaped("form", patterns[lang], **parts)


def date(d: Draws, lang: str) -> Column:
    """A day of the years 1950 to 2005, the 28th of a month at most."""
    y, m, day = d.number("y", 56, 1950), d.number("m", 12, 1), d.number("d", 28, 1)
    parts = {"y": y, "m": m, "d": day, "mm": F.lpad(m.cast("string"), 2, "0"), "dd": F.lpad(day.cast("string"), 2, "0")}
    if lang == "vi":
        return d.weighted("form", [(filled(p, parts), w) for p, w in (("{dd}/{mm}/{y}", 20), ("{y}-{mm}-{dd}", 20), ("{dd}-{mm}-{y}", 20), ("{d} tháng {m} năm {y}", 40))])
    if lang == "en":
        parts["month"] = F.element_at(F.array(*[F.lit(x) for x in LOCALES["en"]["months"]]), m.cast("int"))
    patterns = {
        "ja": ["{y}-{mm}-{dd}", "{y}/{mm}/{dd}", "{y}年{m}月{d}日", "{y}.{mm}.{dd}"], "ko": ["{y}-{mm}-{dd}", "{y}.{mm}.{dd}", "{y}년 {m}월 {d}일", "{y}/{mm}/{dd}"],
        "en": ["{month} {d}, {y}", "{mm}/{dd}/{y}", "{y}-{mm}-{dd}", "{d} {month} {y}"],
    }
    return d.shaped("form", patterns[lang], **parts)


def rrn_check(first12: Column, wrong: bool = True) -> Column:
    """Check digit of a registration number, one off where it must not be valid."""
    weights = F.array(*[F.lit(w) for w in RRN_WEIGHTS])
    total = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(0), lambda s, i: s + F.substr(first12, i, F.lit(1)).cast("int") * F.element_at(weights, i))
    right = (11 - total % 11) % 10
    return ((right + 1) % 10) if wrong else right


def id_number(d: Draws, lang: str) -> Column:
    if lang in ("ja", "vi"):
        parts = {c: d.digits(c, 4) for c in "abc"}
        return d.shaped("form", ["{a}{b}{c}", "{a}-{b}-{c}", "{a} {b} {c}"] if lang == "ja" else ["{a}{b}{c}", "{a}-{b}{c}"], **parts)
    if lang == "ko":
        born = F.concat(d.digits("y", 2), d.padded("m", 12, 1), d.padded("d", 28, 1))
        rest = F.concat(d.number("sex", 4, 1).cast("string"), d.digits("r", 5))
        return F.concat(born, F.lit("-"), rest, rrn_check(F.concat(born, rest)).cast("string"))
    return d.shaped("form", ["{a}-{g}-{s}", "{a} {g} {s}", "{a}{g}{s}"], a=d.pick("area", NEVER_ISSUED), g=d.padded("g", 99, 1), s=d.padded("s", 9999, 1, 4))


def card(d: Draws) -> Column:
    """16 digits from an issuer's first ones, in groups of four, without a check digit."""
    start = d.pick("iin", IINS)
    all_ = F.substring(F.concat(start, d.digits("n", 15)), 1, 16)
    groups = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.substr(all_, i * 4 + 1, F.lit(4)))
    sep = d.pick("sep", CARD_SEPARATORS)
    return F.aggregate(groups, F.lit(""), lambda a, g: F.when(a == "", g).otherwise(F.concat(a, sep, g)))


def local_part(d: Draws, given: Column, family: Column) -> Column:
    """The part of a mail address before the sign: a form, capitals and digits are drawn apart; 64 characters at most."""
    form, upper = d.weighted("form", FORMS), d.number("upper", 100) < CAPITALS
    cased = lambda c: F.when(upper, F.initcap(c)).otherwise(c)
    g, f = cased(given), cased(family)
    body = (
        F.when(form == "dot", F.concat(g, F.lit("."), f)).when(form == "plain", F.concat(g, f)).when(form == "single", d.pick("one", [g, f]))
        .when(form == "initial", cased(F.concat(F.substring(given, 1, 1), family))).when(form == "underscore", F.concat(g, F.lit("_"), f)).otherwise(F.concat(g, F.lit("-"), f))
    )
    at = d.number("digits", 100)
    before, after = F.substr(d.digits("x", 2), F.lit(1), d.number("nx", 2, 1).cast("int")), F.substr(d.digits("y", 4), F.lit(1), d.number("ny", 4, 1).cast("int"))
    body = F.when(at < DIGITS_BEFORE, F.concat(before, body)).when(at < DIGITS_BEFORE + DIGITS_AFTER, F.concat(body, after)).otherwise(body)
    return F.regexp_replace(F.substring(body, 1, 64), r"^\.+|\.+$", "")


def email(d: Draws, lang: str) -> Column:
    at = LOCALES[lang]
    return F.concat(local_part(d, d.pick("given", at["mail_given"]), d.pick("family", at["mail_family"])), F.lit("@"), d.pick("domain", at["domains"]))


def value(label: str, lang: str, seed: int, key: Column) -> Column:
    """A synthetic value of a label in a language; unknown labels and languages raise."""
    if lang not in LOCALES:
        raise ValueError(f"unknown language: {lang}")
    made = {"NAME": name, "PHONE": phone, "ADDRESS": address, "DAT": date, "ID_NUM": id_number, "EMAIL": email}
    d = Draws(seed, key, label)
    if label == "CREDIT_CARD":
        return card(d)
    if label not in made:
        raise ValueError(f"unknown label: {label}")
    return made[label](d, lang)


#: shapes that every value has, by label and language
SHAPES = {
    ("CREDIT_CARD", "*"): r"(?:4|5|34|37|3528|3569)[0-9]*|(?:[0-9]{4}(?: |-|  )){3}[0-9]{4}", ("EMAIL", "*"): r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}@[a-z.]+\.[a-z]+",
    ("ID_NUM", "ja"): r"[0-9]{12}|[0-9]{4}([- ])[0-9]{4}\1[0-9]{4}", ("ID_NUM", "vi"): r"[0-9]{4}-?[0-9]{8}", ("ID_NUM", "ko"): r"[0-9]{6}-[1-4][0-9]{6}",
    ("ID_NUM", "en"): r"(?:000|666|9[0-9]{2})([- ]?)[0-9]{2}\1[0-9]{4}", ("PHONE", "en"): r".*555[-. ]01[0-9]{2}", ("PHONE", "ko"): r"(?:0|\+82 )[0-9 .-]{8,12}",
    ("PHONE", "ja"): r"(?:\(?0|\+81)[0-9() ./-]{9,16}", ("PHONE", "vi"): r"(?:\(?\+84\)? ?)?0[0-9 -]{8,12}", ("DAT", "*"): r".*(?:19[5-9][0-9]|200[0-5]).*",
    ("NAME", "*"): r".{2,40}", ("ADDRESS", "*"): r".{5,80}",
}


def shape(label: str, lang: str) -> str:
    """The pattern that all values of a label in a language match as a whole."""
    return SHAPES.get((label, lang)) or SHAPES[label, "*"]
