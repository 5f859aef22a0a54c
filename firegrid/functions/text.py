"""Column functions on names, codes and times of day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def instrument_from_satellite(satellite: Column) -> Column:
    """Terra/Aqua carry MODIS, N (Suomi NPP and later) carries VIIRS.

    A reader that turned the bare letter ``N`` into a boolean leaves ``false``: that is VIIRS too.
    """
    text = F.upper(F.trim(satellite.cast("string")))
    first = F.substring(text, 1, 1)
    return (
        F.when(text == "FALSE", "VIIRS")
        .when(text == "TRUE", None)
        .when(first.isin("T", "A"), "MODIS")
        .when(first == "N", "VIIRS")
    )


def instrument_from_path(path: Column) -> Column:
    """Instrument named by a file name; null when the name says nothing."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return (
        F.when(name.rlike("modis|mcd14|m-c6"), "MODIS")
        .when(name.rlike("viirs|vnp14|suomi|sv-c|j1v|jpss"), "VIIRS")
    )


def derive_instrument(satellite: Column, instrument: Column | None = None) -> Column:
    """An explicit instrument wins if it is recognisable, else the satellite decides."""
    derived = instrument_from_satellite(satellite)
    if instrument is None:
        return derived
    text = F.upper(F.trim(instrument))
    given = F.when(text.isin("MODIS", "M"), "MODIS").when(text.isin("VIIRS", "V"), "VIIRS")
    return F.coalesce(given, derived)


def is_confident(instrument: Column, confidence: Column, modis_min: int = 20) -> Column:
    """MODIS: whole-number confidence of at least ``modis_min``; VIIRS: not low.  Never null."""
    text = F.lower(F.trim(confidence))
    modis = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int")) >= modis_min
    viirs = ~text.startswith("l")
    flag = F.when(instrument == "MODIS", modis).when(instrument == "VIIRS", viirs)
    return F.coalesce(flag, F.lit(False))


def normalize_hhmm(time: Column) -> Column:
    """``7:05`` / ``705`` / null -> ``0705`` / ``0705`` / ``0000``."""
    return F.lpad(F.coalesce(F.replace(F.trim(time.cast("string")), F.lit(":")), F.lit("0")), 4, "0")


def tile_from_name(name: Column) -> Column:
    """The hXXvYY tile inside a product file name, or null."""
    tile = F.regexp_extract(F.lower(name), r"(h\d{2}v\d{2})", 1)
    return F.when(tile != "", tile)
