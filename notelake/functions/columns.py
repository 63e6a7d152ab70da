"""Scalar functions of the warehouse, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Applications in the order in which they are tried, as (name, patterns of SIMILAR TO, platform).
APPLICATIONS = [
    ("StreetComplete", ["%via StreetComplete%"], None),
    ("Maps.me", ["%#mapsme"], None),
    ("EveryDoor", ["%#EveryDoor"], None),
    ("OsmAnd", ["%#OsmAnd"], None),
    ("LocusMap", ["%#LocusMap"], None),
    ("OrganicMaps", ["%#organicmaps"], None),
    ("OSM Report", ["%#osmreport"], None),
    ("OrganicMaps", ["%#organicmaps android"], "android"),
    ("OrganicMaps", ["%#organicmaps ios"], "ios"),
    ("OnOSM.org", ["onosm.org %"], "web"),
    ("MapComplete", ["%#MapComplete #notes"], "web"),
    ("Mapy.cz", ["%#Mapy.cz%", "%#Mapycz%", "#Mapy.cz%", "%#mapycz%"], "web"),
    ("msftopenmaps", ["%#msftopenmaps%", "%#MSFTOpenMaps%"], "web"),
    ("OnOSM.OSMiranorg", ["onosm.osmiran.org %"], "web"),
]

#: Letters, marks, digits and the low line, of every script: what tags and mentions are made of.
WORD = "[\\p{L}\\p{M}\\p{N}_]"


def hour_of_week(ts: Column) -> Column:
    """ISO day of the week * 100 + hour."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), ts) * 100 + F.hour(ts)


def period_of_day(hour: Column) -> Column:
    return F.when(hour < 6, "Night").when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening")


def zone_offset(lon: Column) -> Column:
    """Whole hours from UTC by longitude, within -12 .. 14; 0 where unknown."""
    return F.when(lon.isNull(), 0).otherwise(F.least(F.greatest(F.round(lon / 15), F.lit(-12.0)), F.lit(14.0)).cast("int"))


def zone_name(offset: Column) -> Column:
    return F.when(offset == 0, "UTC").when(offset > 0, F.concat(F.lit("UTC+"), offset.cast("string"))).otherwise(F.concat(F.lit("UTC"), offset.cast("string")))


def season(ts: Column, lat: Column) -> Column:
    """0 near the equator or where unknown; 1-4 by month, in an order of its own south of it."""
    quarter = F.floor((F.month(ts) % 12) / 3)
    north = F.when(quarter == 0, 4).otherwise(quarter)
    return F.when(lat.isNull() | lat.between(-10, 10), 0).when(lat > 10, north).otherwise(5 - north).cast("int")


def hashtags(body: Column) -> Column:
    """Tags in order; after a tag one character is passed over, and a bare # ends the list, itself being an empty tag."""
    found = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(f"#({WORD}*)(?:[\\s\\S]|$)"), 1)
    bare = F.array_position(found, "")
    return F.when(bare > 0, F.slice(found, F.lit(1), bare.cast("int"))).otherwise(found)


def application(body: Column) -> Column:
    """Name and platform of the first application whose pattern the whole body matches; null if none does."""
    chain = None
    for name, patterns, kind in APPLICATIONS:
        hit = None
        for p in patterns:
            one = _similar(body, p)
            hit = one if hit is None else hit | one
        value = F.struct(F.lit(name).alias("name"), F.lit(kind).cast("string").alias("platform"))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def mentions(body: Column) -> Column:
    """Most bodies hold no sign, which is far faster to see than by the expression."""
    return F.coalesce(F.contains(body, F.lit("@")) & body.rlike(f"@{WORD}"), F.lit(False))


def _similar(body: Column, pattern: str) -> Column:
    text = pattern.strip("%")
    if pattern.startswith("%") and pattern.endswith("%"):
        return F.contains(body, F.lit(text))
    return body.endswith(text) if pattern.startswith("%") else body.startswith(text)


def is_mobile(platform: Column) -> Column:
    return F.coalesce(platform.isin("android", "ios") | platform.startswith("mobile"), F.lit(False))


def is_desktop(platform: Column) -> Column:
    return F.coalesce(platform.isin("web", "desktop", "windows", "linux", "macos"), F.lit(False))


def version(body: Column) -> Column:
    """The first N.N or N.N.N in the body; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(body, F.lit("")), "(\\d+\\.\\d+(\\.\\d+)?)", 1), F.lit(""))


def activity_score(n: Column) -> Column:
    """0; 1-2; 3-6; 7-14; ...; 511 and more -> 0 .. 9."""
    return F.least(F.lit(9), F.floor(F.log2(n + 1.000001))).cast("int")


def length_class(n: Column) -> Column:
    return F.when(n < 5, "poor").when(n < 10, "fair").when(n < 200, "good").when(n < 500, "complex").otherwise("treatise")


def age_band(days: Column) -> Column:
    return F.when(days <= 7, "0_7").when(days <= 30, "8_30").when(days <= 90, "31_90").otherwise("90_plus")


def clean_text(body: Column, length: int = 2000) -> Column:
    """One line for a CSV file: breaks and tabs become spaces, double quotes single ones."""
    return F.substring(F.trim(F.replace(F.regexp_replace(body, "[\\r\\n\\t]+", " "), F.lit('"'), F.lit("'"))), 1, length)
