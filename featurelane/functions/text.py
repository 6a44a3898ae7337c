"""Text functions: HTML entity unescape (F2) and the multivalent normaliser."""

from __future__ import annotations

import json
from html.entities import html5 as _html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common HTML entities with the text they stand for, from which the
# DuckDB twin's SQL is made. html_unescape decodes all names of HTML5.
NAMED_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "copy": "©",
    "apos": "'", "nbsp": "\u00a0", "reg": "®", "middot": "·", "hellip": "…",
    "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "trade": "™", "euro": "€",
    "laquo": "«", "raquo": "»", "deg": "°", "times": "×",
}
LEGACY_NO_SEMICOLON = tuple(n for n in NAMED_ENTITIES if n in _html5)
# Names that HTML5 also decodes without the trailing ';' (and as the longest
# prefix of an unknown name, '&ampx' -> '&x'), from the HTML5 table in Python's
# standard library.
_LEGACY = {n: text for n, text in _html5.items() if not n.endswith(";")}
# Numbers that HTML5 takes for others: the C1 controls stand for windows-1252.
_REMAP = {0: "\ufffd", 0x0D: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}

# One character reference: decimal, hex, or a name (HTML5 tokeniser classes).
ENTITY_PATTERN = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _map(table: dict, kind: str) -> Column:
    """A constant map (one JSON literal, folded when the plan is optimised)."""
    return F.from_json(F.lit(json.dumps(table)), kind)


def _named_entity(e: Column) -> Column:
    """The text of ``&name;`` or ``&name``, else that of its longest prefix that
    needs no ';' and the rest, else null."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, text in _html5.items():
        by_letter.setdefault(name[0], {})[f"&{name}"] = text
    whole = F.try_element_at(F.try_element_at(_map(by_letter, "map<string,map<string,string>>"), F.substring(e, 2, 1)), e)
    legacy = _map(_LEGACY, "map<string,string>")
    sizes = sorted({len(n) for n in _LEGACY}, reverse=True)
    return F.coalesce(whole, *[F.concat(F.try_element_at(legacy, F.substring(e, 2, n)), F.substring(e, n + 2, 1 << 30)) for n in sizes])


def _numeric_entity(e: Column) -> Column:
    """``&#39;`` / ``&#x27`` -> the character; 0, surrogates and values past
    U+10FFFF -> U+FFFD; C1 controls -> windows-1252; other controls and
    noncharacters -> nothing."""
    body = F.regexp_extract(e, r"^&#[xX]?([0-9a-fA-F]+);?$", 1)
    is_hex = e.rlike(r"^&#[xX]")
    digits = F.regexp_replace(body, "^0+(?=.)", "")  # conv fails on values past 64 bits
    num = F.when(~is_hex, body).when(F.length(digits) <= 8, F.conv(digits, 16, 10)).try_cast("long")
    ok = num.between(1, 0x10FFFF) & ~num.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.conv(num.cast("string"), 10, 16), 8, "0")), "UTF-32")
    remap = F.try_element_at(_map({str(n): text for n, text in _REMAP.items()}, "map<string,string>"), num.cast("string"))
    none = (num.between(1, 8) | (num == 0x0B) | num.between(0x0E, 0x1F) | (num == 0x7F) | num.between(0xFDD0, 0xFDEF)
            | (num.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return F.when(body != "", F.coalesce(remap, F.when(ok & none, F.lit("")).when(ok, char).otherwise(F.lit("\ufffd"))))


def html_unescape(col: str | Column) -> Column:
    """one left-to-right pass over character references (no double unescape
    of ``&amp;lt;``), all names and rules of HTML5."""
    x = F.col(col) if isinstance(col, str) else col
    parts = F.split(x, ENTITY_PATTERN, -1)
    ents = F.regexp_extract_all(x, F.lit(ENTITY_PATTERN), 0)

    def decode_one(e: Column) -> Column:
        named = F.when(~e.startswith("&#"), _named_entity(e))
        return F.coalesce(named, _numeric_entity(e), e)

    decoded = F.transform(ents, decode_one)
    glued = F.zip_with(parts, F.concat(decoded, F.array(F.lit(""))), lambda p, d: F.concat(p, F.coalesce(d, F.lit(""))))
    return F.when(x.isNull(), x).when(~x.contains("&"), x).otherwise(F.array_join(glued, ""))


# A "word" character is a Unicode letter, number or underscore (Python's \w for str).
NON_WORD = r"[^.\p{L}\p{N}_|]+"


def multivalue_clean(col: str | Column, unescape: bool = True) -> Column:
    """``'a| b&amp;c ||d'`` -> sorted ``['a', 'b c', 'd']``; null -> ``['']``.

    null -> '' ; HTML unescape ; runs of non-word characters (except ``.`` and
    ``|``) -> one space ; strip spaces and pipes at both ends ; split on pipes
    with surrounding spaces ; sort (code-point order).
    """
    x = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    if unescape:
        x = html_unescape(x)
    x = F.regexp_replace(x, NON_WORD, " ")
    x = F.regexp_replace(x, r"^[ |]+|[ |]+$", "")
    return F.array_sort(F.split(x, r" *\|+ *"))


def split_multi(col: str | Column, sep: str) -> Column:
    """Split on a literal separator with optional surrounding whitespace."""
    import re
    x = F.col(col) if isinstance(col, str) else col
    return F.split(x, r"\s*" + re.escape(sep) + r"\s*")
