"""Personal data with offset-preserving deobfuscation.

The base detectors run on the text itself. Two transducers then rewrite it and keep, for each
character they put out, the source characters it stands for: the first maps homoglyphs
(full-width, look-alike letters, other scripts' digits, invisible characters), the second
spelled digits and the at/dot disguises. The detectors run on the result too, and a match that
holds a rewritten character is mapped back to its source span and added unless it meets a base
span of its kind.

All scans are linear in the text. Defined results: a null text is an empty one; texts without
findings have zero counts, empty ``spans`` and the digest of an empty string; offsets are code
points of the source, ends exclusive; repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from pitlane.llm.common import table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, str, int]  # start, kind, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A digit run is entered at its first digit only: a match never ends within a run.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """Matches around each @ from left to right; a match takes the local characters before it
    back to the end of the one before."""
    done, at = 0, t.find("@")
    while at >= 0:
        lo = at
        while lo > done and t[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(t, at + 1) if lo < at else None
        if m:
            yield lo, m.end()
        done = m.end() if m else at + 1  # nothing before a failing @ can be used again
        at = t.find("@", done)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ip_part(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 3 or len(s) == 3 and s <= "255"


def detect(t: str) -> list[Span]:
    """The base spans of a text by start, then kind."""
    out: list[Span] = [(a, "email", b) for a, b in _emails(t)] if "@" in t else []
    if _DIGIT.search(t):
        if "." in t:
            out += [(m.start(), "ip", m.end()) for m in _IP.finditer(t) if all(map(_ip_part, m.groups()))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
                out.append((m.start(), "card", m.end()))
        if "+" in t:
            out += [(m.start(), "phone", m.end()) for m in _PHONE.finditer(t) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


# Look-alikes of Latin letters, by the letters they stand for (fixed values).
_LOOKS = {
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", "a": "аα", "c": "сϲ", "d": "ԁ", "e": "еε", "g": "ɡ",
    "h": "һ", "i": "іι", "j": "ј", "k": "κ", "l": "ӏ", "n": "п", "o": "оοσ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υ",
    "v": "ν", "w": "ԝω", "x": "хχ", "y": "уγ",
    "@": "﹫", ".": "․。｡﹒", "-": "‐‑‒–—−﹣", "+": "﹢", " ": "     　", "(": "﹙", ")": "﹚",
}
_INVISIBLE = "­​‌‍⁠﻿"
#: Blocks whose decimal digits, and letters by compatibility, are rewritten.
_BLOCKS = ((0xFF01, 0xFF5E), (0x2070, 0x2079), (0x2080, 0x2089), (0x2460, 0x2468), (0x0660, 0x0669), (0x06F0, 0x06F9), (0x0966, 0x096F), (0x1D400, 0x1D7FF))


def _glyphs() -> dict[str, str]:
    out = {c: latin for latin, looks in _LOOKS.items() for c in looks} | dict.fromkeys(_INVISIBLE, "")
    for lo, hi in _BLOCKS:
        for x in range(lo, hi + 1):
            c = chr(x)
            d = unicodedata.digit(c, None)
            plain = str(d) if d is not None else unicodedata.normalize("NFKC", c)
            if plain != c and len(plain) == 1 and plain.isascii():
                out[c] = plain
    return out


GLYPHS = _glyphs()
_GLYPH = re.compile("[" + "".join(map(re.escape, GLYPHS)) + "]")

# Spelled digits in four languages, and the words for signs (fixed values).
_NUMBERS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_N = "(?:" + "|".join(sorted(_NUMBERS, key=len, reverse=True)) + ")"
_DOT = r"(?:dot|punkt|punto|point)"
# Plain words stand for a sign only between what could be parts of an address or a number.
_DISGUISE = re.compile(
    rf"(?P<digits>(?<!\w){_N}(?:[\s-]{{1,3}}{_N})*(?!\w))"
    r"|(?P<at>\s{0,3}[\[({<]\s{0,3}(?:at|@|arroba|klammeraffe)\s{0,3}[\])}>]\s{0,3}|(?<=\w)\s{1,3}(?:at|arroba|klammeraffe)\s{1,3}(?=[\w-]+\s{0,3}[\[({<]?\s{0,3}(?:dot|punkt|punto|point)))"
    rf"|(?P<dot>\s{{0,3}}[\[({{<]\s{{0,3}}(?:{_DOT}|\.)\s{{0,3}}[\])}}>]\s{{0,3}}|(?<=\w)\s{{1,3}}{_DOT}\s{{1,3}}(?=\w))"
    r"|(?P<plus>(?<!\w)plus\s{1,3}(?=[0-9]|" + _N + r"))",
    re.IGNORECASE,
)
_NUMBER = re.compile(_N, re.IGNORECASE)
_AFTER = re.compile(rf"\s{{1,3}}{_DOT}\s", re.IGNORECASE)
_WORD = re.compile(r"\w+")
_SIGNS = ("dot", "punkt", "punto", "point")
#: Words one of which a disguise without brackets holds, if its address has no sign inside of a word.
_HINTS = frozenset({*_NUMBERS, *_SIGNS, "plus"})
_AT = frozenset({"at", "arroba", "klammeraffe"})
#: Letters that ``re.IGNORECASE`` takes for ASCII ones though ``lower`` does not.
_FOLD = str.maketrans("İıſ", "iis")


def _lower(t: str) -> str:
    return t.lower() if t.isascii() else t.translate(_FOLD).lower()


def _may_hide(t: str) -> bool:
    """A cheap test that no disguised text fails."""
    if any(c in t for c in "[({<"):
        return True
    low = _lower(t)
    words = set(_WORD.findall(low))
    # What follows a plain "at" may hold its sign within a word: "at lapointe.com".
    return not _HINTS.isdisjoint(words) or not _AT.isdisjoint(words) and any(s in low for s in _SIGNS)


#: A disguised address ends in a name, not in a number.
_NAME = re.compile(r"\.[A-Za-z]{2,}$")


class Rewritten:
    """A text with, for each character, the source characters [start, end) it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.changed = np.zeros(len(text), bool)

    def replace(self, parts: list[tuple[int, int, str]]) -> None:
        """Put each (from, to, new) in place; every new character stands for the whole part."""
        text, start, end, changed, pos = [], [], [], [], 0
        for a, b, new in parts:
            text += [self.text[pos:a], new]
            n = len(new)
            start += [self.start[pos:a], np.full(n, self.start[a])]
            end += [self.end[pos:a], np.full(n, self.end[b - 1])]
            changed += [self.changed[pos:a], np.ones(n, bool)]
            pos = b
        self.text = "".join([*text, self.text[pos:]])
        self.start = np.concatenate([*start, self.start[pos:]])
        self.end = np.concatenate([*end, self.end[pos:]])
        self.changed = np.concatenate([*changed, self.changed[pos:]])


def _word_parts(t: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _DISGUISE.finditer(t):
        if m.lastgroup == "digits":
            words = list(_NUMBER.finditer(t, m.start(), m.end()))
            after_dot = bool(out) and out[-1][1] == m.start() and out[-1][2] == "."
            if len(words) == 1 and not after_dot and not _AFTER.match(t, m.end()):
                continue  # a lone number word is one
            for k, w in enumerate(words):
                stop = words[k + 1].start() if k + 1 < len(words) else w.end()
                out.append((w.start(), stop, _NUMBERS[_lower(w.group())]))
        else:
            out.append((m.start(), m.end(), {"at": "@", "dot": ".", "plus": "+"}[m.lastgroup]))
    return out


def hidden(t: str) -> list[Span]:
    """Spans that show only after rewriting."""
    glyphs = not t.isascii() and not GLYPHS.keys().isdisjoint(t)
    if not glyphs and not _may_hide(t):
        return []
    r = Rewritten(t)
    if glyphs:
        r.replace([(m.start(), m.end(), GLYPHS[m.group()]) for m in _GLYPH.finditer(t)])
    r.replace(_word_parts(r.text))
    out = []
    for a, kind, b in detect(r.text):
        moved = r.changed[a:b].any() or r.end[b - 1] - r.start[a] > b - a  # invisible characters leave no trace but length
        if moved and (kind != "email" or _NAME.search(r.text, a, b)):
            out.append((int(r.start[a]), kind, int(r.end[b - 1])))
    return out


def spans(t: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start and kind."""
    t = t or ""
    base = detect(t)
    more = [s for s in hidden(t) if not any(s[1] == k and s[0] < b and a < s[2] for a, k, b in base)]
    return base, sorted({*base, *more}, key=lambda s: (s[0], KINDS.index(s[1]), s[2])) if more else base


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in found)


def find_pii(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: base counts per kind, the base spans' digest, all spans."""
    src = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [spans(t) for t in b["text"]]
            out = {"doc_id": b["doc_id"]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(k == kind for _, k, _ in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            out["spans"] = [joined(every) for _, every in found]
            yield pd.DataFrame(out)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return src.mapInPandas(run, f"doc_id {dict(src.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string")


def op5_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(table(spark, sf_dir, "documents"))
