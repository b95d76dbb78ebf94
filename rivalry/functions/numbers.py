"""Expressions that read numbers out of text, and the guarded win rate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the raw statistics.
OF_PAIR = r"(\d+) of (\d+)"
CLOCK = r"(\d+):(\d+)"
RECORD = r"(\d+)-(\d+)-(\d+)"
HEIGHT = r"(\d+)'(\d+)\""
REACH = r"(\d+)\""
WEIGHT = r"(\d+) lbs."
HEX_ID = r"^[0-9a-fA-F]{1,16}$"


def _group(text: Column, pattern: str, index: int, to: str) -> Column:
    """One capture group as a number, null where the pattern is absent."""
    return F.regexp_extract(text, pattern, index).try_cast(to)


def parse_percent(text: Column, strict: bool = True) -> Column:
    """``45%`` as 0.45. Junk raises, or gives null when not strict."""
    digits = F.replace(text, F.lit("%"), F.lit(""))
    number = digits.cast("double") if strict else digits.try_cast("double")
    return number / 100


def parse_of_pair(text: Column) -> dict[str, Column]:
    """``17 of 37`` as landed and total."""
    return {
        "landed": _group(text, OF_PAIR, 1, "double"),
        "total": _group(text, OF_PAIR, 2, "double"),
    }


def parse_clock(text: Column) -> Column:
    """``m:s`` in seconds."""
    return _group(text, CLOCK, 1, "double") * 60 + _group(text, CLOCK, 2, "double")


def parse_record(text: Column) -> dict[str, Column]:
    """``10-2-1`` as wins, losses and ties."""
    names = ["wins", "losses", "ties"]
    return {name: _group(text, RECORD, i, "smallint") for i, name in enumerate(names, 1)}


def parse_height(text: Column) -> Column:
    """Feet and inches in inches."""
    return _group(text, HEIGHT, 1, "double") * 12 + _group(text, HEIGHT, 2, "double")


def parse_reach(text: Column) -> Column:
    return _group(text, REACH, 1, "double")


def parse_weight(text: Column) -> Column:
    return _group(text, WEIGHT, 1, "double")


def hex_to_double(text: Column, strict: bool = True) -> Column:
    """A hexadecimal id of up to 64 bits as a double; the low bits above 2^53 are lost.

    ``conv`` reads bad digits as 0, so the text is checked first: bad ids raise,
    or give null when not strict. Prefer the text itself as a join key.
    """
    number = F.conv(text, 16, 10).cast("decimal(20,0)").cast("double")
    checked = F.when(text.rlike(HEX_ID), number)
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a hexadecimal id: "), text)).cast("double")
        checked = checked.when(text.isNotNull(), bad)
    return checked


def win_rate(wins: Column, losses: Column, default: Column) -> Column:
    """wins / (wins + losses), and ``default`` where there is no decided contest."""
    return F.coalesce(F.try_divide(wins.cast("double"), wins + losses), default)
