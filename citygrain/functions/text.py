"""Text normalisers for addresses. Native columns only: no Python runs per row."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from citygrain.functions.numbers import bound

# Abbreviated street designations and house-number suffixes.
STREET_ALIASES = {
    "ALL": "ALLEE",
    "AV": "AVENUE",
    "BD": "BOULEVARD",
    "BLD": "BOULEVARD",
    "CHE": "CHEMIN",
    "CRS": "COURS",
    "FG": "FAUBOURG",
    "IMP": "IMPASSE",
    "PAS": "PASSAGE",
    "PL": "PLACE",
    "QU": "QUAI",
    "RLE": "RUELLE",
    "RTE": "ROUTE",
    "SQ": "SQUARE",
    "VLA": "VILLA",
}
SUFFIX_ALIASES = {
    "B": "BIS",
    "T": "TER",
    "Q": "QUATER",
}


@lru_cache(maxsize=1)
def _ascii_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition restricted to ASCII, read off the Unicode database.

    Returns the characters that become one ASCII character, their images in the same order,
    and the characters that become several.
    """
    single, images, several = [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        image = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(image) == 1:
            single.append(char)
            images.append(image)
        elif image:
            several[char] = image
    return "".join(single), "".join(images), several


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(item) for pair in pairs.items() for item in pair])


def to_ascii(c: Column) -> Column:
    """Compatibility-decompose and drop whatever is not ASCII (accents go, ``œ`` goes)."""
    single, images, several = _ascii_tables()
    expandable = F.lit("".join(several))
    # Characters with a longer image are rare: only texts that hold one pay for the walk. They are
    # looked for with ``translate``, whose table is hashed; a regex class would be tried one by one.
    holds_one = F.translate(c, "".join(several), "") != c
    table = _literal_map(several)
    expanded = F.array_join(
        F.transform(
            F.split(c, ""),
            lambda char: F.when(expandable.contains(char), F.try_element_at(table, char)).otherwise(char),
        ),
        "",
    )
    widened = F.when(holds_one, expanded).otherwise(c)
    reduced = F.regexp_replace(F.translate(widened, single, images), r"[^\x00-\x7F]", "")
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(reduced)


def normalize_text(c: Column) -> Column:
    """Upper-case ASCII words separated by single blanks; NULL becomes ''."""
    words = F.regexp_replace(F.upper(to_ascii(F.coalesce(c, F.lit("")))), "[^A-Z0-9]+", " ")
    return F.trim(words)


def normalize_street(c: Column) -> Column:
    """Normalised street name with every abbreviated word written out."""
    # Each word gets a blank of its own on both sides, so that neighbours are found too. What an
    # abbreviation stands for is none itself. A walk over the words takes seven times as long.
    words = F.concat(F.lit(" "), F.replace(normalize_text(c), F.lit(" "), F.lit("  ")), F.lit(" "))
    for short, long in STREET_ALIASES.items():
        words = F.replace(words, F.lit(f" {short} "), F.lit(f" {long} "))
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def extract_digits(c: Column) -> Column:
    """The digits 0-9 of a text; NULL becomes ''. Digits of other scripts are not kept."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def normalize_house_number(c: Column) -> Column:
    """Digits without leading zeros, but a number of zeros only stays as it is."""

    def without_zeros(digits: Column) -> Column:
        stripped = F.ltrim(digits, F.lit("0"))
        return F.when(stripped == "", digits).otherwise(stripped)

    return bound(extract_digits(c), without_zeros)


def normalize_suffix(c: Column) -> Column:
    aliases = _literal_map(SUFFIX_ALIASES)
    return bound(normalize_text(c), lambda suffix: F.coalesce(F.try_element_at(aliases, suffix), suffix))
