"""Text functions as Column expressions: normal forms, marks, words and letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods see it, in a class that Java and RE2 read alike.
SPACE = r"[\s\p{Z}\x1C-\x1F\x85]"
# The ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# The Hungarian alphabet, and its letters of several characters, longest first.
HUNGARIAN = "a á b c cs d dz dzs e é f g gy h i í j k l ly m n ny o ó ö ő p q r s sz t ty u ú ü ű v w x y z zs".split()
LETTER = r"dzs|dz|cs|gy|ly|ny|sz|ty|zs|[a-záéíóöőúüű]"
SENTENCE_END = r"[.!?]$"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def normal(c: Column) -> Column:
    """Stripped, runs of white space as one blank, lower case."""
    return F.lower(strip(F.regexp_replace(c, f"{SPACE}+", " ")))


def bare(c: Column) -> Column:
    """Lower case without ASCII punctuation."""
    return F.translate(F.lower(c), PUNCTUATION, "")


def words(c: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(c, f"{SPACE}+"), lambda w: w != "")


def tokens(c: Column) -> Column:
    """Runs of letters, digits and underscores in any script."""
    return F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def lines(c: Column) -> Column:
    """Stripped lines by any line end; the empty tail after a last line end is no line."""
    parts = F.split(F.regexp_replace(c, "\r\n?", "\n"), "\n")
    whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.transform(whole, strip)


def ends_sentence(c: Column) -> Column:
    return strip(c).rlike(SENTENCE_END)


def starts_upper(c: Column) -> Column:
    return strip(c).rlike(r"^\p{Lu}")


def tight(c: Column, spaces: str = r"\s+") -> Column:
    """Without the blanks before ``, . ! ?``."""
    return F.regexp_replace(c, f"{spaces}([,.!?])", "$1")


def one_line(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def letter_counts_input(c: Column) -> Column:
    """Letters of the Hungarian alphabet, the longest first."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({LETTER})"), F.lit(1))


def has_digit(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\p{Nd}"), F.lit(False))


def rule_violations(c: Column) -> Column:
    """``empty`` alone for an empty sentence, else ``not_upper`` and ``no_end`` as they apply."""
    t = strip(c)
    found = F.filter(
        F.array(F.when(~starts_upper(c), F.lit("not_upper")), F.when(~ends_sentence(c), F.lit("no_end"))), lambda v: v.isNotNull()
    )
    return F.when(F.coalesce(t, F.lit("")) == "", F.array(F.lit("empty"))).otherwise(found)
