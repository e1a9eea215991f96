"""Material, customer and centre codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.config import CARS, KEEP_SUFFIX_BUYER, MOTORCYCLES, SEGMENTS


def strip_zeros(c: Column) -> Column:
    """Drop leading zeros; an all-zero code becomes the empty text."""
    return F.ltrim(c, F.lit("0"))


def is_blank(c: Column) -> Column:
    """NULL or only spaces."""
    return F.coalesce(F.trim(c) == "", F.lit(True))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def default_center(org: Column, center: Column) -> Column:
    """A missing centre is the segment's main centre; other organisations stay empty."""
    fallback = reduce(
        lambda chain, s: chain.when(org == s.org, s.default_center), SEGMENTS.values(), F)
    return F.when(is_blank(center), fallback).otherwise(center)


def company_of(center: Column) -> Column:
    return F.concat(F.substring(center, 1, 2), F.lit("00"))


def names_no_item(item: Column, zeros: bool = False) -> Column:
    """True where the chain field names no item: NULL, blank, ``SIM`` or (on request) zero."""
    text = F.upper(F.trim(item))
    empty = text.isin("", "SIM")
    if zeros:
        empty = empty | text.rlike(r"^0+(\.0+)?$")
    return F.coalesce(empty, F.lit(True))


def main_item(item: Column, material: Column, zeros: bool = False) -> Column:
    """Main item of the chain, the material itself where none is named."""
    return F.when(names_no_item(item, zeros), material).otherwise(item)


def main_item_plain(item: Column, material: Column) -> Column:
    """Consumer-view form: no trimming, and a blank text counts as an item."""
    return F.when(F.coalesce(F.upper(item) == "SIM", F.lit(True)), material).otherwise(item)


def clean_chain(code: Column, org: Column, buyer: Column) -> Column:
    """Drop the variant suffix of a chain item.

    Cars drop ``C`` and ``G``; motorcycles drop ``C`` unless the in-house buyer owns
    the item (no buyer counts as any other buyer).
    """
    other_buyer = F.coalesce(F.trim(buyer) != KEEP_SUFFIX_BUYER, F.lit(True))
    return (
        F.when(org == CARS, F.regexp_replace(code, r"\s+[CG]$", ""))
        .when((org == MOTORCYCLES) & other_buyer, F.regexp_replace(code, r"\s+C$", ""))
        .otherwise(code)
    )


def clean_variant(code: Column, org: Column, buyer: Column) -> Column:
    """Drop the variant suffix for the supersession map.

    ``N``, ``NP`` and ``C`` always go. ``G`` goes for cars, and for motorcycles when a
    buyer other than the in-house one is known.
    """
    drop_g = (org == CARS) | ((org == MOTORCYCLES) & (buyer != KEEP_SUFFIX_BUYER))
    return (
        F.when(drop_g, F.regexp_replace(code, r"\s+(NP|N|C|G)$", ""))
        .otherwise(F.regexp_replace(code, r"\s+(NP|N|C)$", ""))
    )


# Centres that serve two states instead of the customer's own centre.
CENTER_MOVES = (("TO", "0203", "0209"), ("TO", "0503", "0505"), ("AP", "0209", "0232"))


def adjusted_center(state: Column, center: Column) -> Column:
    moves = reduce(
        lambda chain, m: chain.when((state == m[0]) & (center == m[1]), m[2]), CENTER_MOVES, F)
    return moves.otherwise(center)


def strip_market(c: Column) -> Column:
    """``Export - Parts`` becomes ``Parts``."""
    return F.regexp_replace(c, r"^(Domestic|Export)\s*-\s*", "")


def class_tag(c: Column) -> Column:
    """Text after the first `` - `` that follows some text; NULL without a separator."""
    at = F.locate(" - ", c, 2)
    tag = F.when(at > 0, F.substring(c, at + 3, F.length(c))).otherwise(F.lit(""))
    return F.when(F.contains(c, F.lit(" - ")), tag)
