"""Stamps, epochs and names as column expressions. Times are timestamps of a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the J2000 epoch as used for product times.
J2000 = "2000-01-01 12:00:00"


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def stamp(time: Column) -> Column:
    """Year, day of year, hour, minute, second and tenth as 14 digits."""
    tenth = F.floor(F.pmod(micros(time), F.lit(1_000_000)) / 100_000).cast("int")
    part = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(part(F.year(time), 4), part(F.dayofyear(time), 3), part(F.hour(time), 2), part(F.minute(time), 2), part(F.second(time), 2), part(tenth, 1))


def from_stamp(text: Column) -> Column:
    """The time of a 14-digit stamp; null if it is none."""
    ok = text.rlike(r"^\d{14}$")
    at = F.make_date(F.substring(text, 1, 4).cast("int"), F.lit(1), F.lit(1))
    day = F.date_add(at, F.substring(text, 5, 3).cast("int") - 1).cast("timestamp")
    tenths = ((F.substring(text, 8, 2).cast("long") * 60 + F.substring(text, 10, 2).cast("long")) * 60 + F.substring(text, 12, 2).cast("long")) * 10 + F.substring(text, 14, 1).cast("long")
    return F.when(ok, F.timestamp_micros(F.unix_micros(day) + tenths * 100_000))


def j2000_seconds(time: Column) -> Column:
    return (micros(time) - F.unix_micros(F.lit(J2000).cast("timestamp"))) / 1e6


def iso_millis(text: Column) -> Column:
    """'2020-03-10T02:23:18.2Z' with exactly three decimals and no zone letter."""
    whole = F.regexp_extract(text, r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)", 1)
    part = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d+)", 1), 1, 3), 3, "0")
    return F.when(whole != "", F.concat(whole, F.lit("."), part))


def local_solar(time: Column, lon: Column) -> Column:
    """Mean solar time: fifteen degrees an hour."""
    return F.timestamp_micros(micros(time) + F.round(lon / 15 * 3_600_000_000).cast("long"))


def date_of_path(path: Column) -> Column:
    """The date of a file from its place: .../YYYY/DDD/HH/..., .../YYYY/MMDD/... or ..._YYYY_MM_DD..."""
    year_day = F.regexp_extract(path, r"/(\d{4})/(\d{3})(?:/|$)", 1), F.regexp_extract(path, r"/(\d{4})/(\d{3})(?:/|$)", 2)
    month_day = F.regexp_extract(path, r"/(\d{4})/(\d{4})(?:/|$)", 1), F.regexp_extract(path, r"/(\d{4})/(\d{4})(?:/|$)", 2)
    named = F.regexp_extract(path, r"(\d{4})[-_](\d\d)[-_](\d\d)", 0)
    return (
        F.when(year_day[0] != "", F.date_add(F.make_date(year_day[0].cast("int"), F.lit(1), F.lit(1)), year_day[1].cast("int") - 1))
        .when(month_day[0] != "", F.make_date(month_day[0].cast("int"), F.substring(month_day[1], 1, 2).cast("int"), F.substring(month_day[1], 3, 2).cast("int")))
        .when(named != "", F.to_date(F.regexp_replace(named, "_", "-")))
    )


def satellite_of_path(path: Column) -> Column:
    """The first of G16 to G19 that a path names, by its short or long name."""
    out = F.lit(None).cast("string")
    for n in (19, 18, 17, 16):
        out = F.when(path.rlike(f"G(OES-?)?{n}"), F.lit(f"G{n}")).otherwise(out)
    return out


def report_name(satellite: Column, time: Column, lat: Column, lon: Column, ident: Column) -> Column:
    """A file name of a detection's report."""
    fixed = lambda x: F.format_string("%.2f", x)
    return F.concat_ws("_", satellite, F.date_format(time, "yyyy-MM-dd'T'HH'h'mm'm'ss"), fixed(lat), fixed(lon), ident.cast("string"))


def valid_id(text: Column) -> Column:
    """Is it a detection's id: a number of 64 bits that is no unsigned one of 32 bits, as those are random ids of a run. Null is none."""
    number = text.try_cast("bigint")
    return F.coalesce((number < 0) | (number > 2**32 - 1), F.lit(False))
