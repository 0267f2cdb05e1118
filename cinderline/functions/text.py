"""Column functions that read dirty strings: dates, fire numbers, period labels, names. All stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s    　]"
INVISIBLE = r"[­᠎​-‏⁠﻿]"


def _accent_pairs() -> tuple[str, str]:
    """Each accented Latin letter below U+0250 and its plain letter, from the Unicode decompositions."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_pairs()


def trim_blank(col: Column | str) -> Column:
    """Without any kind of white space at the ends; null stays null."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, f"^{BLANK}+|{BLANK}+$", "")


def fold_accents(col: Column) -> Column:
    """Letters without their accents, composed or combining; other characters stay."""
    return F.regexp_replace(F.translate(col, ACCENTED, PLAIN), r"\p{M}", "")


def parse_date(col: Column | str) -> Column:
    """DATE from yyyy-MM-dd (also with a time after it), yyyy/MM/dd, yyyyMMdd, yyyy-DDD, dd/MM/yyyy or d-M-yyyy.

    Where the year stands last, the day comes first. Anything else, null, and days that do not exist give null.
    The plain layout is told by its length and hyphens; only other texts are trimmed (once) and matched with patterns.
    The lambda keeps the patterns out of the generated code: inlined wherever a day is used, they make methods too large for the
    JVM to compile, at three times the cost.
    """
    c = F.col(col) if isinstance(col, str) else col
    plain = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    return F.when(plain, c.try_cast("date")).otherwise(F.transform(F.array(trim_blank(c)), _other_layouts)[0])


def _other_layouts(s: Column) -> Column:
    def day_first(sep: str) -> Column:
        return F.concat_ws("-", F.split_part(s, F.lit(sep), F.lit(3)), F.split_part(s, F.lit(sep), F.lit(2)), F.split_part(s, F.lit(sep), F.lit(1))).try_cast("date")

    jan1 = F.concat(F.substring(s, 1, 4), F.lit("-01-01")).try_cast("date")
    ordinal = F.date_add(jan1, F.substring(s, 6, 3).try_cast("int") - 1)
    return (
        F.when(s.rlike(r"^\d{4}-\d\d-\d\d([T ].*)?$"), F.substring(s, 1, 10).try_cast("date"))
        .when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), day_first("/"))
        .when(s.rlike(r"^\d{4}/\d\d/\d\d$"), F.translate(s, "/", "-").try_cast("date"))
        .when(s.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)).try_cast("date"))
        .when(s.rlike(r"^\d{4}-\d{3}$"), F.when(F.year(ordinal) == F.year(jan1), ordinal))
        .when(s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), day_first("-"))
    )


def fire_number(col: Column | str) -> Column:
    """The number in a fire id however it is written (fire_007, FIRE-7, ' fire_7 '), BIGINT; null if it has none."""
    digits = F.regexp_extract(F.col(col) if isinstance(col, str) else col, r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def fire_label(number: Column, digits: int = 3) -> Column:
    """fire_NNN with so many digits at least; null stays null."""
    return F.when(number.isNotNull(), F.format_string(f"fire_%0{digits}d", number))


PERIODS = ("Pre-fire", "Post-fire", "Background")


def period_label(col: Column | str) -> Column:
    """Pre-fire, Post-fire or Background from its spellings; null for anything else. Only what is not spelt so already is looked at with a pattern."""
    c = F.col(col) if isinstance(col, str) else col
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    other = F.when(letters == "prefire", PERIODS[0]).when(letters == "postfire", PERIODS[1]).when(letters == "background", PERIODS[2])
    return F.when(c.isin(*PERIODS), c).otherwise(other)
