"""One form for text that looks the same: the tables, in Python for workers and as SQL expressions for plans.

``look`` keeps every visible difference (case, accents, raised digits, marks of another shape). ``plain`` also
drops case, and is for operators to which case and odd characters do not matter.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that show nothing, and spaces of a fixed width or that cannot break.
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x206A), *range(0xFE00, 0xFE10), 0xFEFF]
SPACES = [0x00A0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]
# Letters of other scripts beside the Latin letters that they look like.
CYRILLIC_LOOKS = "аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ Ԛ Q Ԝ W"
GREEK_LOOKS = "αa γy ιi νv οo ρp υu χx ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
ARMENIAN_LOOKS = "օo ՕO հh ոn սu"
CHEROKEE_LOOKS = "ᎠD ᎡR ᎢT ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏃZ ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK ᏴB"
ROMAN_NUMERALS = "ⅠI ⅤV ⅩX ⅬL ⅭC ⅮD ⅯM ⅰi ⅴv ⅹx ⅼl ⅽc ⅾd ⅿm"
#: Small letters shaped like small capitals: alike only where case does not count.
CYRILLIC_SMALL_CAPITALS = "вb кk мm нh тt"
# Marks and letters that look like a usual one or like a row of usual ones.
MARKS = {"‐": "-", "‑": "-", "｡": "。", "｢": "「", "｣": "」", "､": "、", "･": "・", "；": ";", "’": "'", "ʼ": "'"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def _pairs(text: str) -> dict[str, str]:
    letters = text.replace(" ", "")
    return dict(zip(letters[::2], letters[1::2]))


#: Full-width letters, digits and marks lie 0xFEE0 above the usual ones.
FULLWIDTH = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
LETTERS = {a: b for t in (CYRILLIC_LOOKS, GREEK_LOOKS, ARMENIAN_LOOKS, CHEROKEE_LOOKS, ROMAN_NUMERALS) for a, b in _pairs(t).items()}
#: Characters that Unicode has twice, such as the sign of the kelvin: each with the one it is equal to.
SINGLETONS = {c: n for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x30000))) if len(n := unicodedata.normalize("NFC", c)) == 1 and n != c}
ONE_TO_ONE = FULLWIDTH | MARKS | LETTERS | {chr(c): " " for c in SPACES}
_LOOK = str.maketrans(ONE_TO_ONE | LIGATURES | {chr(c): "" for c in INVISIBLE})
#: Without the letters of other scripts: what is odd in any text, whatever its script.
_TIDY = str.maketrans(FULLWIDTH | MARKS | LIGATURES | {chr(c): " " for c in SPACES} | {chr(c): "" for c in INVISIBLE})
_PLAIN = _LOOK | str.maketrans(_pairs(CYRILLIC_SMALL_CAPITALS))
_BARE = _PLAIN | {c: "" for c in range(0x0300, 0x0370)}


def look(text: str) -> str:
    """The form that two texts share if they look the same."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_LOOK))


def tidy(text: str) -> str:
    """``text`` without invisible, full-width and fixed-space characters; letters keep their script."""
    return text if text.isascii() else unicodedata.normalize("NFC", text.translate(_TIDY))


def plain(text: str) -> str:
    """``look`` without case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_PLAIN).casefold())


def bare(text: str) -> str:
    """``plain`` without accents."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFD", text).translate(_BARE).casefold()


def looks_like(c: Column) -> Column:
    """``look`` as built-in expressions, but for the composition of accents, which the collation settles.

    Composed Cyrillic letters whose base has a Latin look-alike are mapped to the composed Latin letter.
    """
    composed = {"ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï", "ѐ": "è", "Ѐ": "È"}
    one = {c: ONE_TO_ONE.get(n, n) for c, n in SINGLETONS.items()} | ONE_TO_ONE | composed
    source = "".join(one) + "".join(map(chr, INVISIBLE))
    whole = c
    for a, b in LIGATURES.items():
        whole = F.replace(whole, F.lit(a), F.lit(b))
    wide = F.translate(F.when(c.rlike("[\ufb00-\ufb06]"), whole).otherwise(c), source, "".join(one.values()))
    # What is ASCII only has no other form.
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(wide)
