"""String helpers: trimming, field names and form encoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column | str) -> Column:
    """Remove whitespace of any kind from both ends."""
    column = F.col(text) if isinstance(text, str) else text
    return F.btrim(column, F.lit(WHITESPACE))


def form_field(name: str) -> str:
    """``friendly_name`` -> ``FriendlyName``: every part of the name begins
    with a capital and goes on in small letters; underscores and spaces
    between parts go. A part ends at any character that is no letter."""
    field, inside = [], False
    for sign in name:
        if sign not in "_ ":
            field.append(sign.lower() if inside else sign.upper())
        inside = sign.isalpha()
    return "".join(field)


def form_quote(text: Column | str) -> Column:
    """Percent-encode a value for a form body, with ``+`` for a space."""
    column = F.col(text) if isinstance(text, str) else text
    encoded = F.url_encode(column)
    # The JVM encoder leaves '*' bare and escapes '~'; form bodies built in
    # Python have it the other way round.
    return F.replace(
        F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def form_encode(fields: Mapping[str, Column]) -> Column:
    """``name=value`` pairs joined by ``&``; a NULL value leaves its pair out."""
    pairs = [
        F.concat(form_quote(F.lit(name)), F.lit("="), form_quote(value))
        for name, value in fields.items()
    ]
    return F.concat_ws("&", *pairs)
