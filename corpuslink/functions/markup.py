"""Patterns of tags and attributes, and character references, shared by links and blocks."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE = r"""(?:'[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+)"""
ATTRIBUTE = rf"""[^\s/>][^\s/=>]*+(?:\s*+=[\s=]*+{VALUE})?+"""
INSIDE = rf"""(?:[\s/]++|{ATTRIBUTE})*+"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _character(reference: Column) -> Column:
    """The character of one reference; an unknown name stays as it is."""
    digits = F.regexp_extract(reference, r"^&#([0-9]+);$", 1)
    hexed = F.regexp_extract(reference, r"^&#[xX]([0-9a-fA-F]+);$", 1)
    code = F.when(digits != "", digits.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    # One literal instead of one per name: the plan stays small.
    listed = "\x02".join(f"{name}\x01{chr(n)}" for name, n in name2codepoint.items())
    named = F.str_to_map(F.lit(listed), F.lit("\x02"), F.lit("\x01"))
    name = F.regexp_extract(reference, r"^&([A-Za-z][A-Za-z0-9]*);$", 1)
    return F.when(valid, char).when(code.isNotNull(), "\ufffd").otherwise(
        F.coalesce(F.try_element_at(named, name), reference)
    )


def unescape(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    between = F.split(text, _REFERENCE, -1)
    joined = F.zip_with(between, found, lambda b, r: F.concat(b, F.when(r.isNull(), "").otherwise(_character(r))))
    return F.when(text.contains("&"), F.array_join(joined, "")).otherwise(text)
