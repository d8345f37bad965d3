"""Text and time expressions; all run inside the JVM."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: an optional sign, digits, and a fraction with digits.
COORDINATE = r"^-?\d+(\.\d+)?$"

# Fixed value: wall-clock time with a literal Z.
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Letters and signs that Unicode does not decompose, as they are
# written in ASCII.
SPELLED_OUT = {
    "ß": "ss",
    "æ": "ae",
    "œ": "oe",
    "þ": "th",
    "ŋ": "ng",
    "°": "deg",
    "«": "<<",
    "»": ">>",
    "—": "--",
    "…": "...",
    "€": "EUR",
    "ø": "o",
    "đ": "d",
    "ð": "d",
    "ħ": "h",
    "ł": "l",
    "ŧ": "t",
    "ı": "i",
    "¿": "?",
    "¡": "!",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "–": "-",
    "⁄": "/",
    " ": " ",
}


# Fixed value: Unicode has no character beyond that decomposes to ASCII.
_LAST = 0x1FBFF


def _ascii_forms() -> dict[str, str]:
    """ASCII form of every lower-case character that has one; combining marks have none left.

    The form is the compatibility decomposition without its marks, which covers
    accented letters, raised digits, fractions, ligatures, full-width letters
    and the like. Other scripts have no ASCII form and pass through.
    """
    forms = dict(SPELLED_OUT)
    for code in range(0x80, _LAST + 1):
        sign = chr(code)
        if unicodedata.category(sign) == "Cs" or sign != sign.lower() or sign in forms:
            continue
        if unicodedata.combining(sign):
            if code < 0x0370:
                forms[sign] = ""
            continue
        parts = unicodedata.normalize("NFKD", sign).lower()
        if parts == sign:
            continue
        plain = "".join(
            SPELLED_OUT.get(part, part) for part in parts if not unicodedata.combining(part)
        )
        if plain.isascii() and plain.isprintable():
            forms[sign] = plain
    return forms


_FORMS = _ascii_forms()
_SINGLE = {sign: form for sign, form in _FORMS.items() if len(form) == 1 and ord(sign) < 0x10000}
_REMOVED = "".join(sign for sign, form in _FORMS.items() if not form)
_LONGER = {
    sign: form for sign, form in _FORMS.items() if sign not in _SINGLE and sign not in _REMOVED
}
# The few longer forms that ordinary text is full of; the others are rare.
_USUAL = [sign for sign in SPELLED_OUT if sign in _LONGER]
_RARE = {sign: form for sign, form in _LONGER.items() if sign not in _USUAL}
_ACCENTED, _BASE = "".join(_SINGLE) + _REMOVED, "".join(_SINGLE.values())
_NOT_ASCII = r"[^\x00-\x7F]"


def fold(text: Column) -> Column:
    """Lower case without accents: ``São Tomé`` becomes ``sao tome``.

    Every character with an ASCII form in Unicode gets it; other scripts pass
    through. Texts that are plain ASCII skip the replacements, and only texts
    that are not ASCII after the usual ones are looked up sign by sign.
    """
    lowered = F.lower(text)
    folded = F.translate(lowered, _ACCENTED, _BASE)
    for sign in _USUAL:
        folded = F.replace(folded, F.lit(sign), F.lit(_FORMS[sign]))
    # One constant: the optimizer evaluates it before any row is read.
    forms = F.from_json(F.lit(json.dumps(_RARE)), "map<string, string>")

    def by_sign(left: Column) -> Column:
        signs = F.transform(
            F.split(left, ""),
            lambda sign: F.when(sign <= "\x7f", sign).otherwise(
                F.coalesce(F.element_at(forms, sign), sign)
            ),
        )
        return F.when(left.rlike(_NOT_ASCII), F.array_join(signs, "")).otherwise(left)

    # An array of one names the folded text, so that it is computed once.
    whole = F.get(F.transform(F.array(folded), by_sign), F.lit(0))
    return F.when(lowered.rlike(_NOT_ASCII), whole).otherwise(lowered)


def zone_code(name: Column, level: str) -> Column:
    """``gz-<folded name>-<first letter of the level>``."""
    return F.concat(F.lit("gz-"), fold(name), F.lit(f"-{level[0]}"))


def qualified_name(schema: Column, table: Column) -> Column:
    return F.concat(schema, F.lit("."), table)


def iso_time(time: Column) -> Column:
    return F.date_format(time, ISO_TIME)


def present_or(value: Column, default: Column) -> Column:
    """``value`` unless it is null or the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), default)


def is_present(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def is_coordinate(text: Column) -> Column:
    """Format check only; the range of the number does not matter."""
    return F.coalesce(text.rlike(COORDINATE), F.lit(False))


def is_uuid(text: Column) -> Column:
    """32 hexadecimal digits, with or without hyphens, braces or a URN prefix."""
    bare = F.regexp_replace(text, "urn:|uuid:", "")
    bare = F.regexp_replace(F.btrim(bare, F.lit("{}")), "-", "")
    return F.coalesce(bare.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))
