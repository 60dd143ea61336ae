"""Text clean-up and fixed-width helpers as native column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points that count as whitespace when a field is
# stripped (ASCII, the four separators 1C..1F and the Unicode spaces).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# French letters and what each becomes.
FRENCH_LETTERS = "ÀàÂâÉéÈèÊêËëÎîÏïÔôÛûÙùÜüÇç"
FRENCH_PLAIN = "AaAaEeEeEeEeIiIiOoUuUuUuCc"
FRENCH_LIGATURES = {"Œ": "Oe", "œ": "oe"}

# Check letters of an 18-character record id.
RECORD_ID_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"

DIGITS = r"^\p{Nd}+\z"
LETTERS = r"^\p{L}+\z"
POSTAL_PREFIX = r"^[a-zA-Z]\p{Nd}[a-zA-Z]\p{Nd}[a-zA-Z]\p{Nd}"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def to_string(c: Column, numeric: bool = False) -> Column:
    """Missing becomes empty, the rest is stripped text; a numeric zero is missing too."""
    text = strip(c.cast("string"))
    if numeric:
        text = F.when(c != 0, text)
    return F.coalesce(text, F.lit(""))


def transliterate_fr(c: Column) -> Column:
    """French letters to ASCII; other characters stay.

    Text of one byte per character has nothing to replace and skips the work.
    """
    plain = c
    for ligature, letters in FRENCH_LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    plain = F.translate(plain, FRENCH_LETTERS, FRENCH_PLAIN)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(plain)


def clean_name(c: Column) -> Column:
    return transliterate_fr(to_string(c))


def fixed(c: Column, width: int) -> Column:
    """Cut to `width` or pad with spaces on the right; missing is all spaces."""
    return F.rpad(F.coalesce(c.cast("string"), F.lit("")), width, " ")


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def escape_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("\\,"))


def record_id_18(c: Column, strict: bool = False) -> Column:
    """15-character record id plus three check letters, one per five characters.

    Each letter encodes which of its five characters are upper case. Ids of 18
    characters pass; any other length is null, or an error when `strict`.
    """
    letters = []
    for block in range(3):
        bits = F.lit(0)
        for j in range(5):
            ch = F.substring(c, block * 5 + j + 1, 1)
            bits = bits + F.when(ch.between("A", "Z"), 1 << j).otherwise(0)
        letters.append(F.substring(F.lit(RECORD_ID_LETTERS), bits + 1, F.lit(1)))
    out = F.when(F.length(c) == 18, c).when(F.length(c) == 15, F.concat(c, *letters))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("bad record id: "), F.coalesce(c, F.lit("null")))))
    return out


_OUTSIDE_QUOTES = re.compile(r'"(?:\\.|[^"\\])*"|=>|\bnil\b', re.S)
_RUBY_TOKENS = {"=>": ": ", "nil": "null"}


def _outside_quotes(text: str | None) -> str | None:
    if text is None:
        return None
    return _OUTSIDE_QUOTES.sub(lambda m: _RUBY_TOKENS.get(m.group(0), m.group(0)), text)


@F.pandas_udf(T.StringType())
def _ruby_outside_quotes(s: pd.Series) -> pd.Series:
    return s.map(_outside_quotes, na_action="ignore")


def ruby_hash_to_json(c: Column, safe: bool = False) -> Column:
    """Hash literal to JSON text.

    The plain form replaces everywhere, quoted text included, as the landed data
    has always been read; `safe` leaves quoted text alone.
    """
    if safe:
        return _ruby_outside_quotes(c)
    return F.replace(F.replace(c, F.lit("=>"), F.lit(": ")), F.lit("nil"), F.lit("null"))


# What bytes 80..9F mean in windows-1252 (the five undefined
# bytes are left out).
_CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
_CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def decode_bytes(c: Column, charset: str) -> Column:
    """Read a line as text of a single-byte charset from its raw bytes."""
    text = F.decode(c.cast("binary"), "ISO-8859-1")
    return F.translate(text, _CP1252_BYTES, _CP1252_CHARS) if charset == "windows-1252" else text


def encode_bytes(c: Column, charset: str) -> Column:
    """A string column whose stored bytes are `c` in a single-byte charset.

    The text sink writes these bytes as they are, so the file has that charset.
    """
    if charset == "windows-1252":
        c = F.translate(c, _CP1252_CHARS, _CP1252_BYTES)
    return F.encode(c, "ISO-8859-1").cast("string")
