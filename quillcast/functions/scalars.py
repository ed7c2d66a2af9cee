"""Scalar functions of the post metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Language codes whose country code is spelled differently.
COUNTRY_OF_LANGUAGE = {
    "en": "us",
    "ja": "jp",
    "el": "gr",
    "da": "dk",
    "uk": "ua",
    "fa": "ir",
    "hi": "in",
}


def round_half_even(value: Column, places: int = 2) -> Column:
    """Banker's rounding of the exact binary value of a double.

    ``bround`` rounds the shortest decimal text instead and so takes 2.675, which
    is stored as 2.67499999…, for a tie. Splitting the value at 2^-20 makes both
    products below exact for values up to 2^27, so the distance from the tie is too.
    """
    scale = float(10**places)
    high = F.floor(value * 2.0**20) / 2.0**20
    high_scaled = high * scale
    low_scaled = (value - high) * scale
    whole = F.floor(high_scaled + low_scaled)
    past_tie = (high_scaled - whole - 0.5) + low_scaled
    up = (past_tie > 0) | ((past_tie == 0) & (whole % 2 != 0))
    return (whole + F.when(up, 1).otherwise(0)) / scale


def country_code(lang: Column) -> Column:
    """Country code a profile language points to.

    ``xx-yy`` names the country itself; a bare code goes through the alias table,
    which is case-sensitive, before it is lowered.
    """
    code = F.regexp_replace(lang, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    parts = F.split(F.regexp_replace(code, "-+$", ""), "-")
    alias = F.create_map(*[F.lit(x) for pair in COUNTRY_OF_LANGUAGE.items() for x in pair])
    bare = F.element_at(parts, 1)
    return F.lower(
        F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2))).otherwise(
            F.coalesce(F.try_element_at(alias, bare), bare)
        )
    )


def one_line(text: Column) -> Column:
    """A text without line breaks, blanks at the ends or other form that a CSV reader changes.

    Backslashes are doubled, line feeds and returns written as ``\\n`` and ``\\r``, the empty
    text as ``\\e``; NULL stays NULL.
    """
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.when(text == "", "\\e").otherwise(escaped)


def from_one_line(text: Column) -> Column:
    """The inverse of :func:`one_line`."""
    def breaks(part: Column) -> Column:
        part = F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
        return F.replace(part, F.lit("\\e"), F.lit(""))

    # Between doubled backslashes, every backslash begins an escape.
    return F.array_join(F.transform(F.split(text, "\\\\\\\\"), breaks), "\\")


def quoted_text(text: Column) -> Column:
    """CSV-escape a text, backslash its double quotes and wrap it in single quotes."""
    needs_quotes = text.rlike('[,"\\n\\r]')
    quoted = F.when(
        needs_quotes, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    ).otherwise(text)
    return F.concat(F.lit("'"), F.replace(quoted, F.lit('"'), F.lit('\\"')), F.lit("'"))
