"""Rounding, integer and code helpers that keep the semantics of the SQL that the results must equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Countries and their ISO codes.
COUNTRIES = {
    "austria": "AT", "belgium": "BE", "bulgaria": "BG", "cyprus": "CY", "czechia": "CZ", "denmark": "DK", "france": "FR", "germany": "DE", "greece": "GR", "hungary": "HU",
    "ireland": "IE", "italy": "IT", "netherlands": "NL", "norway": "NO", "poland": "PL", "serbia": "RS", "slovenia": "SI", "spain": "ES", "sweden": "SE", "united_kingdom": "GB",
}
#: Fixed value: what reads as a number.
NUMERIC = r"^[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?$"


def r2(x: Column) -> Column:
    """Half away from zero to two decimals."""
    return F.round(x, 2)


def half_even(x: Column) -> Column:
    """A double assigned to an integer column: half to even."""
    return F.rint(x).cast("int")


def min_max(x: Column, low: Column, high: Column, whole: bool = False) -> Column:
    """(x - low) / (high - low), null for an empty range; whole: integer division, as between integer columns."""
    span = F.nullif(high - low, F.lit(0))
    if whole:
        return ((x - low) / span).cast("int").cast("double")
    return (x - low).cast("double") / span


def lookup(x: Column, codes: dict[str, int], other: int = -1) -> Column:
    """Simple CASE: the code of x, other for null or unknown."""
    out = F.lit(other)
    for value, code in reversed(codes.items()):
        out = F.when(x == value, F.lit(code)).otherwise(out)
    return out


def has_numeric(val_double: Column, val_int: Column, val_string: Column) -> Column:
    return numeric(val_double, val_int, val_string).isNotNull()


def numeric(val_double: Column, val_int: Column, val_string: Column) -> Column:
    """A property's number: the double, else the integer, else the string where it reads as a number."""
    return F.coalesce(val_double, val_int.cast("double"), F.when(val_string.rlike(NUMERIC), val_string.cast("double")))


def country_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), "[ -]", "_")


def country_code(name: Column) -> Column:
    """ISO code of a country name; null where the country is not supported."""
    pairs = [F.lit(x) for pair in COUNTRIES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), country_key(name))


def supported_country(name: str) -> str:
    """The ISO code of a configured country, or an error that names the supported ones."""
    key = name.strip().lower().replace(" ", "_").replace("-", "_")
    if key not in COUNTRIES:
        raise ValueError(f"country {name!r} is not supported; supported are {', '.join(COUNTRIES)}")
    return COUNTRIES[key]


def parse_srid(text: str) -> int:
    """'EPSG:25832' or '25832' -> 25832."""
    digits = text.strip().upper().removeprefix("EPSG:")
    if not digits.isdigit() or int(digits) <= 0:
        raise ValueError(f"not an SRID: {text!r}")
    return int(digits)


def srid(text: Column) -> Column:
    """parse_srid for a column: null for what is no SRID."""
    digits = F.regexp_extract(F.upper(F.trim(text)), r"^(?:EPSG:)?([0-9]+)$", 1)
    return F.when(F.expr("true") & (F.try_to_number(F.nullif(digits, F.lit("")), F.lit("9999999999")) > 0), digits.try_cast("int"))


def circular_difference(a: Column, b: Column) -> Column:
    """a - b on the circle, in [-180, 180)."""
    return F.pmod(a - b + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
