"""Column expressions over text. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that separates words: Unicode white space and the four ASCII
# information separators.
_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
_CODES += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACES = "".join(map(chr, _CODES))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space, none is left at the ends."""
    plain = F.translate(text, SPACES, " " * len(SPACES))
    return F.trim(F.regexp_replace(plain, "  +", " "))


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def one_line(text: Column) -> Column:
    """Strip, then turn each line break character into a space."""
    return F.translate(strip(text), "\r\n", "  ")


def quiet_quotes(text: Column) -> Column:
    """Double quotes become single ones."""
    return F.translate(text, '"', "'")


def clean_summary(text: Column) -> Column:
    """Line feeds to spaces, outer spaces removed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, "\n", " ")))


def url_host(url: Column) -> Column:
    """The third '/'-separated piece; null when there is none."""
    return F.get(F.split(url, "/"), 2)


def words(text: Column) -> Column:
    """Lower-cased text cut at every single space; empty tokens stay."""
    return F.split(F.lower(text), " ")


def not_stop_word(word: Column, stop_words: Iterable[str]) -> Column:
    """True for tokens outside ``stop_words``; ``word`` is in lower case already."""
    listed = sorted({w.lower() for w in stop_words})
    return ~word.isin(listed) if listed else F.lit(True)
