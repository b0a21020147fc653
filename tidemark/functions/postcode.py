"""Postcode keys: unit ⊂ sector ⊂ district ⊂ area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank_to_null(col: Column) -> Column:
    return F.when(F.length(col) > 0, col)


def postcode_parts(raw: Column) -> tuple[Column, Column]:
    """Outward and inward part of a postcode written in any usual form.

    Two words are taken as they stand. One word gives its last three
    characters as the inward part, and the separators ``_``, ``-`` and ``+``
    are peeled (in that order) from both ends of the rest.
    """
    text = F.upper(F.trim(raw))
    words = F.split(text, r"\s+")
    rest = F.substring(text, 1, F.length(text) - 3)
    for mark in ("_", "-", r"\+"):
        rest = F.regexp_replace(rest, f"^{mark}+|{mark}+$", "")
    spaced = F.size(words) > 1
    usable = spaced | (F.length(text) > 3)
    outward = F.when(spaced, words[0]).when(usable, rest)
    inward = F.when(spaced, words[1]).when(usable, F.right(text, F.lit(3)))
    return _blank_to_null(outward), inward


def canonical_postcode(raw: Column) -> Column:
    outward, inward = postcode_parts(raw)
    return F.when(outward.isNotNull() & inward.isNotNull(), F.concat(outward, F.lit(" "), inward))


def postcode_district(raw: Column) -> Column:
    return postcode_parts(raw)[0]


def postcode_sector(raw: Column) -> Column:
    outward, inward = postcode_parts(raw)
    return F.concat(outward, F.lit(" "), F.substring(inward, 1, 1))


def district_of_sector(sector: Column) -> Column:
    """First word of a sector, or all but its last character if unspaced."""
    text = F.upper(F.trim(sector))
    words = F.split(text, r"\s+")
    rest = F.substring(text, 1, F.length(text) - 1)
    for mark in ("_", "-", r"\+"):
        rest = F.regexp_replace(rest, f"^{mark}+|{mark}+$", "")
    return _blank_to_null(F.when(F.size(words) > 1, words[0]).otherwise(rest))


def postcode_area(district: Column) -> Column:
    """Leading capitals of a district."""
    return _blank_to_null(F.regexp_extract(district, "^([A-Z]+)", 1))


def with_postcode_keys(df: DataFrame, postcode: str = "postcode", normalise: bool = False) -> DataFrame:
    """Add ``postcodeSector`` and ``postcodeDistrict``; optionally rewrite the postcode."""
    keys = {
        "postcodeSector": postcode_sector(F.col(postcode)),
        "postcodeDistrict": postcode_district(F.col(postcode)),
    }
    if normalise:
        keys[postcode] = canonical_postcode(F.col(postcode))
    return df.withColumns(keys)
