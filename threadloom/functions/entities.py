"""Character references of HTML to characters, as the HTML standard reads them, in column expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
UNKNOWN = "�"
LARGEST = 0x10FFFF
# The names most texts use come first, as a map is searched from its start.
COMMON = ["amp;", "quot;", "lt;", "gt;", "nbsp;", "apos;", "copy;", "reg;", "hellip;", "middot;"]
PAIRS, PARTS = "\u0001", "\u0002"  # no name and no character of the table


def names() -> dict[str, str]:
    """Names that end in a semicolon."""
    return {name: html5[name] for name in [*COMMON, *sorted(set(html5) - set(COMMON))] if name.endswith(";")}


def short_names() -> list[str]:
    """Names that also hold without a semicolon, longest first: the longest prefix of a reference counts."""
    return sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))


def windows_characters() -> dict[int, str]:
    """References 128 to 159 mean the characters of Windows-1252; its five free places mean themselves."""
    found = {}
    for number in range(0x80, 0xA0):
        try:
            found[number] = bytes([number]).decode("cp1252")
        except UnicodeDecodeError:
            found[number] = chr(number)
    return found


def _table(entries: dict[str, str]) -> Column:
    """A map as one literal."""
    return F.str_to_map(F.lit(PAIRS.join(f"{k}{PARTS}{v}" for k, v in entries.items())), F.lit(PAIRS), F.lit(PARTS))


def _numbered(reference: Column) -> Column:
    """The character of ``&#...;``: by decimal or hexadecimal number, of any length."""
    hexadecimal = F.substring(reference, 3, 1).isin("x", "X")
    decimal_digits = F.regexp_extract(reference, "^&#0*([0-9]*)", 1)
    hex_digits = F.regexp_extract(reference, "^&#[xX]0*([0-9a-fA-F]*)", 1)
    digits = F.when(hexadecimal, hex_digits).otherwise(decimal_digits)
    base = F.when(hexadecimal, F.conv(F.concat(F.lit("0"), hex_digits), 16, 10)).otherwise(F.concat(F.lit("0"), decimal_digits))
    number = F.when(F.length(digits) > 7, LARGEST + 1).otherwise(base.cast("int"))
    in_windows = F.element_at(F.array(*[F.lit(c) for c in windows_characters().values()]), number - 0x7F)
    # Control characters other than white space, and code points that are no characters.
    control = number.between(0x01, 0x08) | (number == 0x0B) | number.between(0x0E, 0x1F) | (number == 0x7F)
    nothing = control | number.between(0xFDD0, 0xFDEF) | (number % 0x10000).isin(0xFFFE, 0xFFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32")
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > LARGEST), UNKNOWN)
        .when(number.between(0x80, 0x9F), in_windows)
        .when(nothing, "")
        .otherwise(character)
    )


def _named(reference: Column) -> Column:
    """The character of a known name, or of the longest known beginning and the rest as it is."""
    whole = F.try_element_at(_table(names()), F.substring(reference, 2, 40))
    start = F.regexp_extract(reference, f"^&({'|'.join(short_names())})", 1)
    rest = F.substring(reference, F.length(start) + 2, F.length(reference))
    begun = F.concat(F.try_element_at(_table({name: html5[name] for name in short_names()}), start), rest)
    return F.when(reference.endswith(";"), F.coalesce(whole, begun, reference)).otherwise(F.coalesce(begun, reference))


def unescape(text: Column) -> Column:
    """All references of a text replaced, each once; a text without an ampersand is left as it is."""
    def replaced(between: Column, reference: Column) -> Column:
        numbered = F.substring(reference, 2, 1) == "#"
        value = F.when(reference.isNull(), "").when(numbered, _numbered(reference)).otherwise(_named(reference))
        return F.concat(between, value)

    parts = F.zip_with(F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), replaced)
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)
