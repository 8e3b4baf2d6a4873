"""String functions (STR1-STR11, CLN6, CLN14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: trims every kind of whitespace, not only blanks."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalise_key(c: Column) -> Column:
    """STR6/CLN14: ``strip().lower().replace(' ', '_')``."""
    return F.replace(F.lower(py_strip(c)), F.lit(" "), F.lit("_"))


def substr_from(c: Column, pos: int) -> Column:
    """STR1: ``SUBSTR(s, pos)`` to the end (1-based)."""
    return F.substr(c, F.lit(pos))


def split_list(c: Column, sep: str) -> Column:
    """STR2: split on a literal separator (escaped: ``split`` takes a regex)."""
    import re
    return F.split(c, re.escape(sep))


def remove_token_ci(c: Column, token: str) -> Column:
    """STR7: remove a token ignoring case (``str.replace(tok, '', case=False)``)."""
    import re
    return F.regexp_replace(c, "(?i)" + re.escape(token), "")


def decimal_comma(c: Column) -> Column:
    """STR8: decimal comma → point."""
    return F.replace(c, F.lit(","), F.lit("."))


# Ordered mojibake repairs (UTF-8 bytes read as Latin-1/CP1252)
# and the text they stand for; applied in this order, later pairs see the
# result of earlier ones.  The euro-sign fragments map to the empty string.
MOJIBAKE_FIXES: tuple[tuple[str, str], ...] = (
    ("Ã±", "ñ"),
    ("Ã²", "ò"),
    ("Ã³", "ó"),
    ("Ãª", "ê"),
    ("Ã«", "ë"),
    ("Ã¡", "á"),
    ("Ã\xa0", "à"),
    ("Ã ", "à"),
    ("Ã\xad", "í"),
    ("Ã­", "í"),
    ("Ã©", "é"),
    ("Ã¨", "è"),
    ("Ãº", "ú"),
    ("Ã§", "ç"),
    ("â¬", ""),
    ("â\xac", ""),
    ("â\x82¬", ""),
)


def fix_mojibake(c: Column, fixes: Sequence[tuple[str, str]] = MOJIBAKE_FIXES) -> Column:
    """STR9: ordered literal substitution fold; leaves correct text alone."""
    out = c
    for bad, good in fixes:
        out = F.replace(out, F.lit(bad), F.lit(good))
    return out


def parse_amount_text(c: Column, legacy_order: bool = False) -> Column:
    """CLN6: salary text → double.

    Strips ``euros`` (any case) and ``€``, trims, turns a decimal comma into a
    point and casts leniently (``to_numeric(errors='coerce')`` → ``try_cast``).
    ``legacy_order=True`` coerces *before* the comma fix, so comma values turn
    NULL, as happened in the original notebook order.
    """
    s = py_strip(F.replace(remove_token_ci(c.cast("string"), "euros"), F.lit("€"), F.lit("")))
    if legacy_order:
        return s.try_cast("double")
    return decimal_comma(s).try_cast("double")


def label_no_spaces(c: Column) -> Column:
    """STR11: remove blanks from a label (file names per group)."""
    return F.replace(c, F.lit(" "), F.lit(""))
