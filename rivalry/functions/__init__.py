"""Scalar column expressions; all stay inside the JVM."""

from rivalry.functions.numbers import (
    CLOCK,
    OF_PAIR,
    hex_to_double,
    parse_clock,
    parse_height,
    parse_of_pair,
    parse_percent,
    parse_reach,
    parse_record,
    parse_weight,
    win_rate,
)
from rivalry.functions.text import (
    drop_inner_spaces,
    file_id,
    normalize_category,
    null_if,
    quoted,
    simple_category,
    split_location,
    strip,
    url_basename,
)
from rivalry.functions.time import LONG_MONTH, SHORT_MONTH, age_years, parse_date

__all__ = [
    "CLOCK", "LONG_MONTH", "OF_PAIR", "SHORT_MONTH", "age_years", "drop_inner_spaces",
    "file_id", "hex_to_double", "normalize_category", "null_if", "parse_clock", "parse_date",
    "parse_height", "parse_of_pair", "parse_percent", "parse_reach", "parse_record",
    "parse_weight", "quoted", "simple_category", "split_location", "strip", "url_basename",
    "win_rate",
]
