"""Text functions as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code points removed at both ends of a text: ASCII and Unicode white space.
SPACES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE = "".join(map(chr, SPACES))
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"
# Combining grave, acute, circumflex, tilde, diaeresis and cedilla.
COMBINING = "".join(map(chr, [0x300, 0x301, 0x302, 0x303, 0x308, 0x327]))


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes only U+0020)."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalize(c: Column) -> Column:
    """Lower case without surrounding white space."""
    return strip(F.lower(c))


def fold(c: Column) -> Column:
    """A lower-case text without accents and combining marks."""
    return F.translate(c, ACCENTED + COMBINING, PLAIN)


def plain(c: Column) -> Column:
    """Lower-case, stripped and accent-free spelling; also drops combining marks."""
    return fold(normalize(c))


def slug(c: Column) -> Column:
    """``plain`` with "_" for spaces."""
    return F.replace(plain(c), F.lit(" "), F.lit("_"))


def has_non_ascii(c: Column) -> Column:
    """True where a text holds a character outside ASCII (more bytes than characters)."""
    return F.octet_length(c) > F.char_length(c)
