"""Visually identical text in one consistent form.

A text is unstable where a character could change under the rules below. A table over all code points holds the quick-check
property of each character: kept, mapped to one character, dropped, or unstable in its surroundings. Texts without the last kind
are mapped through the table, many at a time; of the others only the unstable segments, each with the character before
it as context, are normalised and spliced back.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that are drawn like a Latin letter, in code order, and that letter.
GREEK_TWINS = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυϲϳ", "ABEZHIKMNOPTYXavopucj"))
CYRILLIC_TWINS = dict(zip("ЅІЈАВЕКМНОРСТУХаеорсухѕіјѴѵҮһӀӏԌԚԛԜԝ", "SIJABEKMHOPCTYXaeopcyxsijVvYhIlGQqWw"))
ARMENIAN_TWINS = dict(zip("ՍՏՕզհոսցօ", "USOqhnugo"))
CHEROKEE_TWINS = dict(zip("ᎠᎢᎥᎪᎫᎬᎷᎻᏃᏏᏒᏙᏞᏟᏢᏦᏧᏴ", "DTiAJEMHZbRVLCPKdB"))
LISU_TWINS = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
LATIN_TWINS = {"ɑ": "a", "ɡ": "g", "ʼ": "’"}
HYPHENS = "‐‑﹣"
# Code points that are not shown by themselves (first and last of each range).
IGNORABLE = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F),
    (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
# Blocks whose compatibility form is drawn alike: ligatures, Roman numerals, upright sans-serif and monospace letters and digits, full-width forms.
SAME_FORM = [(0xB5, 0xB5), (0x2024, 0x2024), (0x2160, 0x217F), (0xFB00, 0xFB06), (0xFF01, 0xFFEE), (0x1D5A0, 0x1D5D3), (0x1D670, 0x1D6A3), (0x1D7E2, 0x1D7EB), (0x1D7F6, 0x1D7FF)]
# Where letters that combine, decompose or are mapped can stand; all other code points are letters that stay as they are.
LOOKED_AT = [(0x80, 0x33FF), (0xA000, 0xABFF), (0xD7B0, 0xD7FF), (0xF900, 0x1FFFF), (0x2F800, 0x2FA1F), (0xE0000, 0xE0FFF)]

SCRIPT_TWINS = {"cyrillic": CYRILLIC_TWINS, "greek": GREEK_TWINS, "armenian": ARMENIAN_TWINS, "cherokee": CHEROKEE_TWINS, "lisu": LISU_TWINS}
TWINS = {other: latin for twins in SCRIPT_TWINS.values() for other, latin in twins.items()} | LATIN_TWINS
TWO_FORMS = "ҮӀ" + "ϲϳ"  # a second letter of the script with the same twin; it is not what a word gets back
BACK = {script: {latin: other for other, latin in twins.items() if other not in TWO_FORMS} for script, twins in SCRIPT_TWINS.items()}
TO_CYRILLIC = BACK["cyrillic"]
TWIN_WORD = set(TO_CYRILLIC) - set("VvlGQW")  # twins of letters rare enough that a word of twins alone with one of them is Latin
KEEP, DROP, UNSTABLE = 0, 1, 2


def _single_map() -> dict[int, str]:
    """What single characters become: invisible ones nothing, any space a space, full-width forms and Latin ligatures
    their plain letters, twins the Latin letter; composed letters over a twin go with it."""
    out = {c: " " for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs"}
    for first, last in SAME_FORM:
        out |= {c: unicodedata.normalize("NFKC", chr(c)) for c in range(first, last + 1) if unicodedata.normalize("NFKC", chr(c)) != chr(c)}
    out |= {ord(c): "-" for c in HYPHENS} | {0x2028: "\n", 0x2029: "\n", 0x85: "\n"}
    out |= {ord(c): latin for c, latin in TWINS.items()}
    for c in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(c))
        if len(parts) > 1 and parts[0] in TWINS:
            out[c] = unicodedata.normalize("NFC", TWINS[parts[0]] + parts[1:])
    for first, last in IGNORABLE:
        out |= dict.fromkeys(range(first, last + 1), "")
    return out


SINGLE = _single_map()


def _is_unstable(c: int) -> bool:
    """May combine with the character before it, or changes under NFC."""
    return unicodedata.category(chr(c))[0] == "M" or 0x1160 <= c < 0x1200 or 0xD7B0 <= c < 0xD800 or not unicodedata.is_normalized("NFC", chr(c))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(character that each code point becomes, its quick-check property)."""
    to, property_ = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, np.uint8)
    for first, last in LOOKED_AT:
        property_[[c for c in range(first, last + 1) if not 0xD800 <= c < 0xE000 and _is_unstable(c)]] = UNSTABLE
    for c, text in SINGLE.items():
        if not text:
            property_[c] = DROP
        elif len(text) > 1 or _is_unstable(ord(text)):
            property_[c] = UNSTABLE
        else:
            property_[c], to[c] = KEEP, ord(text)
    return to, property_


TO, PROPERTY = _tables()


def _ranges(codes: list[int]) -> str:
    """A character class of sorted code points."""
    spans: list[list[int]] = []
    for c in codes:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" if a < b else f"\\u{a:04x}" for a, b in spans)


BELOW_ASTRAL = sorted(c for c in {*np.flatnonzero(PROPERTY == UNSTABLE).tolist(), *SINGLE} if c < 0x10000)
SEGMENT = re.compile(f"[\r{_ranges(BELOW_ASTRAL)}\U00010000-\U0001ffff\U0002f800-\U0002fa1f\U000e0000-\U000e0fff]+\n?")  # beyond U+FFFF whole blocks
WORD = re.compile(r"[^\W\d_]+")
OTHER_SCRIPT = re.compile("[\u0370-\u03ff\u0400-\u052f\u0531-\u0587\u13a0-\u13fd\u1f00-\u1fff\ua4d0-\ua4ff]")


@lru_cache(maxsize=1 << 16)
def _settle(segment: str) -> str:
    """The normal form of an unstable segment with its context; what composes only after the mapping is mapped again."""
    text = unicodedata.normalize("NFC", segment.translate(SINGLE).replace("\r\n", "\n").replace("\r", "\n"))
    return unicodedata.normalize("NFC", text.translate(SINGLE)) if SEGMENT.search(text) else text


def _splice(text: str) -> str:
    """text with each unstable segment settled; the character before a segment is taken in, as a mark may join it."""
    out, done = [], 0
    for m in SEGMENT.finditer(text):
        start = max(m.start() - 1, done)
        out += [text[done:start], _settle(text[start : m.end()])]
        done = m.end()
    out.append(text[done:])
    return "".join(out)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_of(codes: np.ndarray) -> str:
    return codes.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")


def pieces(text: str, most: int = 1_000_000) -> list[str]:
    """The text in pieces of about so many characters that begin with a plain space, with which nothing before it combines."""
    out, at = [], 0
    while len(text) - at > most:
        cut = text.find(" ", at + most)
        if cut < 0:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def skeletons(texts: list[str], batch_chars: int = 50_000, piece_chars: int = 1_000_000) -> list[str]:
    """skeleton() of each text, those without an unstable character through the table, many at a time; very long ones in pieces."""
    out, rows, chars = list(texts), [], 0
    for i, text in enumerate(texts):
        if text.isascii() and "\r" not in text:
            continue
        if len(text) > 2 * piece_chars:
            out[i] = "".join(new for piece in pieces(text, piece_chars) for new in _mapped([piece]))
            continue
        rows.append(i)
        chars += len(text)
        if chars >= batch_chars:
            for k, new in zip(rows, _mapped([texts[k] for k in rows])):
                out[k] = new
            rows, chars = [], 0
    for k, new in zip(rows, _mapped([texts[k] for k in rows])):
        out[k] = new
    return out


def _mapped(texts: list[str]) -> list[str]:
    codes = codes_of("".join(texts))
    property_ = PROPERTY[codes]
    ends = np.cumsum([len(t) for t in texts])
    spliced = set(np.searchsorted(ends, np.flatnonzero(property_ == UNSTABLE), side="right").tolist())
    codes = TO[codes]
    if (property_ == DROP).any():
        kept = property_ != DROP
        codes = codes[kept]
        ends = np.r_[0, np.cumsum(kept)][ends]  # ends of the texts among the kept characters
    whole = text_of(codes)
    ends = [0, *ends.tolist()]
    out = [_splice(t) if i in spliced else whole[ends[i] : ends[i + 1]] for i, t in enumerate(texts)]
    return [t.replace("\r\n", "\n").replace("\r", "\n") if "\r" in t else t for t in out]


def _script(char: str) -> str:
    code = ord(unicodedata.normalize("NFD", char)[0])
    if code < 0x250:
        return "latin"
    if 0x370 <= code < 0x400 or 0x1F00 <= code < 0x2000:
        return "greek"
    if 0x400 <= code < 0x530:
        return "cyrillic"
    return "armenian" if 0x531 <= code < 0x588 else "cherokee" if 0x13A0 <= code < 0x13FE else "lisu" if 0xA4D0 <= code < 0xA500 else "other"


def _back(word: str, table: dict[str, str]) -> str:
    out = []
    for char in word:
        parts = unicodedata.normalize("NFD", char)
        out.append(table.get(parts[0], parts[0]) + parts[1:])
    return unicodedata.normalize("NFC", "".join(out))


@lru_cache(maxsize=1 << 16)
def _kind(word: str) -> tuple[str, int, int]:
    """Script a word is of ('' if of Latin or none, 'twins' if it has twins of Cyrillic alone), its unmistakable Cyrillic and Latin letters."""
    bases = [unicodedata.normalize("NFD", c)[0] for c in word]
    scripts = [_script(b) for b in bases]
    latin = sum(s == "latin" and b not in TO_CYRILLIC for b, s in zip(bases, scripts))
    kind = "twins" if all(b in TWIN_WORD for b in bases) else ""
    for script, table in BACK.items():
        if script in scripts and all(s == script or b in table for b, s in zip(bases, scripts)):
            kind = script
    return kind, scripts.count("cyrillic"), latin


@lru_cache(maxsize=1 << 16)
def _restored_word(word: str, mostly_cyrillic: bool) -> str:
    kind = _kind(word)[0]
    if kind == "twins":
        return _back(word, TO_CYRILLIC) if mostly_cyrillic else word
    return _back(word, BACK[kind]) if kind else word


def _restore(text: str) -> str:
    """Words of another script get their own letters back.

    Decided from the Latin-lettered form alone: a word with letters that only one of the scripts has, and otherwise only
    twins, is of that script; a word of twins alone goes with the script that most unmistakable letters of the text have.
    """
    if not OTHER_SCRIPT.search(text):
        return text
    kinds = [_kind(w) for w in WORD.findall(text)]
    mostly = sum(k[1] for k in kinds) > sum(k[2] for k in kinds)
    # a letter that has no composed form in its script leaves a mark, which may have to change places with the next ones
    return unicodedata.normalize("NFC", WORD.sub(lambda m: _restored_word(m.group(), mostly), text))


def skeleton(text: str) -> str:
    """canonical() with every look-alike letter as the Latin one, whatever the script of its word."""
    return text if text.isascii() and "\r" not in text else _splice(text)


def canonical(text: str) -> str:
    """The one form of all texts that look like this one.

    Line ends become \\n, spaces of any kind a plain space, invisible characters go, accents are composed, full-width
    forms, ligatures and look-alike letters become plain ones (in words of another script, letters of that script).
    The number of spaces, tabs and blank lines stays, and so do case, accents, digits and letters that differ visibly.
    """
    if text.isascii() and "\r" not in text:
        return text
    return _restore(_splice(text))


def _each(texts: pd.Series, whole: bool) -> pd.Series:
    there = texts.notna()
    done = skeletons(texts[there].tolist())
    return pd.Series([_restore(t) for t in done] if whole else done, texts.index[there], dtype=object).reindex(texts.index, fill_value=None)


@F.pandas_udf(T.StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return _each(texts, True)


@F.pandas_udf(T.StringType())
def _skeleton_udf(texts: pd.Series) -> pd.Series:
    return _each(texts, False)


# Spark may not evaluate these twice where a filter looks at their result.
_canonical_udf, _skeleton_udf = _canonical_udf.asNondeterministic(), _skeleton_udf.asNondeterministic()


def _unless_plain(text: Column) -> Column:
    """Null for texts of ASCII without a return, which no rule touches: the quick check that costs the JVM next to nothing."""
    return F.when((F.octet_length(text) != F.char_length(text)) | F.contains(text, F.lit("\r")), text)


def canonical_text(text: Column) -> Column:
    """canonical() of a string column: null stays null, empty stays empty. Plain texts are not sent to Python."""
    return F.coalesce(_canonical_udf(_unless_plain(text)), text)


def skeleton_text(text: Column) -> Column:
    """skeleton() of a string column, with which texts are compared: equal where canonical_text() is, and cheaper."""
    return F.coalesce(_skeleton_udf(_unless_plain(text)), text)
