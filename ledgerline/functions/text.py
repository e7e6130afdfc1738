"""String helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace class that a strip removes. It equals Unicode White_Space
# and gives the same result in Spark (Java regex) and DuckDB (RE2).
WHITESPACE_CLASS = r"[\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Python's str.strip() also removes the four separators U+001C to U+001F.
PY_WHITESPACE_CLASS = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


# The same two sets as single characters, for the cheap first / last character test.
WHITESPACE_CHARS = tuple(
    chr(x) for x in [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
PY_WHITESPACE_CHARS = WHITESPACE_CHARS + tuple(chr(x) for x in range(0x1C, 0x20))


def strip(c: Column, ws_class: str = WHITESPACE_CLASS, ws_chars: tuple[str, ...] = WHITESPACE_CHARS) -> Column:
    """Remove leading and trailing whitespace (``trim`` removes the space only).

    The regex runs only when the first or last character is whitespace (a hash-set
    test), which is rare, so the common row pays two substring lookups.
    """
    edge = F.substring(c, 1, 1).isin(*ws_chars) | F.substring(c, -1, 1).isin(*ws_chars)
    return F.when(edge, F.regexp_replace(c, f"^{ws_class}+|{ws_class}+$", "")).otherwise(c)


def py_strip(c: Column) -> Column:
    """Strip with Python's whitespace set (the currency normaliser uses it)."""
    return strip(c, PY_WHITESPACE_CLASS, PY_WHITESPACE_CHARS)


def is_canonical_uuid(c: Column) -> Column:
    """True for canonical lower-case 8-4-4-4-12 text; string functions only, no regex."""
    dashes = [F.substring(c, i, 1) == "-" for i in (9, 14, 19, 24)]
    return (F.char_length(c) == 36) & dashes[0] & dashes[1] & dashes[2] & dashes[3] & (
        F.translate(c, "0123456789abcdef-", "") == ""
    )


def uuid_hex(c: Column) -> Column:
    """The 32 hex digits of a lenient UUID text, lower case, or null when it is no UUID.

    Accepted forms: canonical, braces, ``urn:uuid:`` prefix, no hyphens, upper case.
    """
    s = F.replace(F.replace(c, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    s = F.replace(F.regexp_replace(s, r"^[{}]+|[{}]+$", ""), F.lit("-"), F.lit(""))
    s = F.lower(s)
    return F.when(s.rlike("^[0-9a-f]{32}$"), s)


def canonical_uuid(c: Column) -> Column:
    """Canonical 8-4-4-4-12 lower-case UUID text, or null (canonical input passes as is)."""
    slow = F.regexp_replace(uuid_hex(c), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(is_canonical_uuid(c), c).otherwise(slow)


def normalise_currency(c: Column) -> Column:
    """Strip, then upper-case; the caller checks the length before and after (V9)."""
    return F.upper(py_strip(c))
