"""Text column helpers: strict parsing, list text, calendar text, tile keys and tile names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strict_int(text: Column) -> Column:
    """A 32-bit integer from plain digits with an optional sign, else NULL."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def hex_to_long(text: Column) -> Column:
    """A signed 64-bit integer from hexadecimal digits with an optional sign, else NULL.

    ``conv`` ignores what it cannot read, so the digits are checked first; a value above
    2**63 - 1 is NULL.
    """
    negative = text.startswith("-")
    digits = F.regexp_replace(text, r"^[+-]", "")
    legal = text.rlike(r"^[+-]?0*[0-9A-Fa-f]{1,16}$")
    size = F.conv(F.when(legal, digits), 16, 10).try_cast("decimal(20,0)")
    signed = F.when(negative, -size).otherwise(size)
    return F.when(legal, signed.try_cast("bigint"))


def iso_date(text: Column) -> Column:
    """A date written as year-month-day with all digits, else NULL."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def int_list(text: Column, delimiter: str = ",") -> Column:
    """The integers in a delimited text; items that are not integers are dropped."""
    items = F.transform(F.split(text, delimiter), lambda item: strict_int(F.trim(item)))
    return F.filter(items, lambda item: item.isNotNull())


def list_text(items: Column) -> Column:
    """``[a,b,c]``; an empty list is ``[]``."""
    return F.concat(F.lit("["), F.array_join(items.cast("array<string>"), ","), F.lit("]"))


def counted(amount: Column, unit: str) -> Column:
    """``1 Day``, ``2 Days``."""
    return F.concat(amount.cast("string"), F.lit(f" {unit}"), F.when(amount == 1, "").otherwise("s"))


def period_text(years: Column, months: Column, days: Column, total_days: Column) -> Column:
    """``1 Year, 2 Months, 3 Days (Total: n Days)``; zero parts are left out, equal dates give ``0 Days``."""
    part = lambda amount, unit: F.when(amount != 0, counted(amount, unit))
    empty = (years == 0) & (months == 0)
    parts = F.concat_ws(
        ", ", part(years, "Year"), part(months, "Month"), F.when((days != 0) | empty, counted(days, "Day"))
    )
    return F.concat(parts, F.lit(" (Total: "), counted(total_days, "Day"), F.lit(")"))


def tile_key_text(col: Column, row: Column, zoom: Column) -> Column:
    """``3z/1c/2r``."""
    return F.format_string("%dz/%dc/%dr", zoom, col, row)


def hex_word(value: Column) -> Column:
    """A 32-bit value as ``0x`` and eight lower-case hex digits."""
    word = F.hex(value.cast("bigint").bitwiseAND(F.lit(4294967295)))
    return F.concat(F.lit("0x"), F.lpad(F.lower(word), 8, "0"))


def tile_index(col: Column, row: Column, zoom: Column) -> Column:
    """Text index of a tile key: its three words joined by hyphens."""
    return F.concat_ws("-", hex_word(col), hex_word(row), hex_word(zoom))


def latitude_name(lat: Column) -> Column:
    """``N26_00``, ``S03_00``."""
    return F.format_string("%s%02d_00", F.when(lat >= 0, "N").otherwise("S"), F.abs(lat))


def longitude_name(lon: Column) -> Column:
    """``E087_00``, ``W005_00``."""
    return F.format_string("%s%03d_00", F.when(lon >= 0, "E").otherwise("W"), F.abs(lon))


# Public elevation archives by resolution in metres, (archive name, arc-second code).
ELEVATION_ARCHIVES = {30: ("copernicus-dem-30m", "10"), 90: ("copernicus-dem-90m", "30")}


def elevation_tile_name(lat: Column, lon: Column, resolution: int = 30) -> Column:
    """Name of the 1-degree elevation tile whose lower left corner is given."""
    _, code = ELEVATION_ARCHIVES[resolution]
    prefix = F.lit(f"Copernicus_DSM_COG_{code}_")
    return F.concat(prefix, latitude_name(lat), F.lit("_"), longitude_name(lon), F.lit("_DEM"))


def elevation_tile_url(tile: Column, resolution: int = 30) -> Column:
    """Public address of a tile's file."""
    archive, _ = ELEVATION_ARCHIVES[resolution]
    return F.concat(F.lit(f"https://{archive}.s3.amazonaws.com/"), tile, F.lit("/"), tile, F.lit(".tif"))
