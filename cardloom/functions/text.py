"""Name folding and text clean-up, as built-in expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as the inputs' producers strip it: Unicode's and four separators.
_BLANK = r"[\s\x1c-\x1f]"
#: Those of them that are one byte.
_PLAIN_BLANK = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def strip_blank(text: Column) -> Column:
    """Without white space of any kind at both ends; where all characters are one byte,
    without a pattern."""
    return F.when(F.octet_length(text) == F.length(text), F.btrim(text, F.lit(_PLAIN_BLANK))).otherwise(F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", ""))


def text_or_null(text: Column) -> Column:
    """Stripped text; null if nothing is left."""
    return F.nullif(strip_blank(text), F.lit(""))


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters that decompose to one base character, and after them all marks; these base
    characters; and the few that decompose to several.  Hangul follows a rule of its own."""
    source, target, marks, several = [], [], [], {}
    for c in map(chr, range(0x80, 0x110000)):
        if 0xD800 <= ord(c) < 0xE000 or "가" <= c <= "힣":
            continue
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            source.append(c)
            target.append(base)
        elif base != c:
            several[c] = base
    return "".join(source + marks), "".join(target), several


def _taken_apart(text: Column, several: dict[str, str]) -> Column:
    """Hangul syllables as their two or three letters, and other characters that stand for
    several."""
    letters = lambda first, n: F.lit("".join(chr(first + i) for i in range(n)))
    many = F.create_map(*[F.lit(x) for pair in several.items() for x in pair]) if several else None

    def apart(c: Column) -> Column:
        at = F.ascii(c) - 0xAC00
        lead = F.substring(letters(0x1100, 19), (at / 588).cast("int") + 1, 1)
        vowel = F.substring(letters(0x1161, 21), (at % 588 / 28).cast("int") + 1, 1)
        tail = F.when(at % 28 > 0, F.substring(letters(0x11A8, 27), at % 28, 1)).otherwise("")
        other = F.coalesce(F.try_element_at(many, c), c) if several else c
        return F.when(c.between("가", "힣"), F.concat(lead, vowel, tail)).otherwise(other)

    odd = f"[가-힣{''.join(several)}]"
    return F.when(text.rlike(odd), F.array_join(F.transform(F.split(text, ""), apart), "")).otherwise(text)


def normalize_name(name: Column) -> Column:
    """Accents dropped, stripped and in lower case; inner space and ``//`` stay.

    Equals decomposing every character and dropping marks.
    """
    plain = F.octet_length(name) == F.length(name)
    source, target, several = _folds()  # what has no target goes
    folded = _taken_apart(F.translate(name, source, target), several)
    return F.lower(strip_blank(F.when(plain, name).otherwise(folded)))


@F.pandas_udf(T.StringType())
def compatible_name(names: pd.Series) -> pd.Series:
    """The looser folding of lists that people type: compatibility forms are split too."""

    def fold(name: str | None) -> str | None:
        if name is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).strip().lower()

    return names.map(fold)
