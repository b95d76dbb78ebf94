"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The place format "[city, ]state, country", read greedily.
PLACE = r"(?:(.*), )?(.*), (.*)"
PLACE_WITH_CITY = r".*, .*, .*"
PLACE_ANY = r".*, .*"

# Replacements that make a category name, applied in this order.
CATEGORY_REPLACEMENTS = [(" - ", "_"), ("/", "_"), (" ", "_"), ("'", "")]

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def quoted(name: str) -> Column:
    """The column of that exact name, also if the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def split_location(place: Column) -> dict[str, Column]:
    """City, state and country; two parts have no city, fewer give nulls."""
    return {
        "city": F.when(place.rlike(PLACE_WITH_CITY), F.regexp_extract(place, PLACE, 1)),
        "state": F.when(place.rlike(PLACE_ANY), F.regexp_extract(place, PLACE, 2)),
        "country": F.when(place.rlike(PLACE_ANY), F.regexp_extract(place, PLACE, 3)),
    }


def url_basename(url: Column) -> Column:
    """The part after the last slash; empty if the text ends in one."""
    return F.substring_index(url, "/", -1)


def file_id(path: Column) -> Column:
    """The base name of a path or URL without its page suffix."""
    return F.replace(url_basename(path), F.lit(".html"), F.lit(""))


def normalize_category(text: Column) -> Column:
    name = F.lower(text)
    for old, new in CATEGORY_REPLACEMENTS:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def simple_category(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def null_if(text: Column, sentinel: str) -> Column:
    return F.when(text != F.lit(sentinel), text)


def drop_inner_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def strip(text: Column) -> Column:
    """Trim any white space, line breaks and no-break spaces included."""
    return F.trim(text, F.lit(WHITE_SPACE))
