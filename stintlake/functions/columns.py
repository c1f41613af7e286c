"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compound codes, typical stint lengths in laps, default lap times in seconds.
COMPOUND_CODES = {"SOFT": 1, "MEDIUM": 2, "HARD": 3}
TYPICAL_STINT = {
    "SOFT": 15,
    "MEDIUM": 25,
    "HARD": 35,
    "SUPERSOFT": 12,
    "ULTRASOFT": 10,
    "INTERMEDIATE": 20,
    "WET": 15,
}
TYPICAL_STINT_OTHER = 20
DEFAULT_LAP_TIME = {"SOFT": 90.0, "MEDIUM": 91.0, "HARD": 92.0}
DEFAULT_LAP_TIME_OTHER = 92.0


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c: Column | str, mapping: dict, default=None) -> Column:
    """A small fixed mapping as a literal map; unmapped and null keys give ``default``."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(pairs, column(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def flag01(c: Column) -> Column:
    """0/1 flag of a predicate, 0 when unknown."""
    return F.coalesce(c, F.lit(False)).cast("int")


def interval_seconds(c: Column | str) -> Column:
    """Seconds of an interval string such as ``0 days 00:01:29.108000``; null if it is not one."""
    text = column(c)
    pattern = r"^(-?\d+) days (\d+):(\d{2}):(\d{2}(?:\.\d+)?)$"
    part = [F.try_to_number(F.regexp_extract(text, pattern, i), F.lit("9" * 9)) for i in (1, 2, 3)]
    seconds = F.regexp_extract(text, pattern, 4).try_cast("double")
    return F.when(
        text.rlike(pattern), part[0] * 86400.0 + part[1] * 3600.0 + part[2] * 60.0 + seconds
    )


def seconds_or_interval(c: Column | str) -> Column:
    """Seconds of a text column that mixes plain seconds and interval strings."""
    return F.coalesce(column(c).try_cast("double"), interval_seconds(c))


def sanitize_event(c: Column | str) -> Column:
    """Event name as a file-name token: blanks become ``_``, only letters, digits, ``_``, ``-`` stay."""
    token = F.regexp_replace(F.replace(column(c), F.lit(" "), F.lit("_")), r"(?U)[^\p{Alnum}_-]", "")
    return F.coalesce(F.nullif(token, F.lit("")), F.lit("unknown_event"))


def id_token(c: Column | str) -> Column:
    return F.upper(F.replace(column(c).cast("string"), F.lit(" "), F.lit("_")))


def minutes_seconds(c: Column | str) -> Column:
    """Seconds as ``MM:SS``."""
    whole = F.floor(column(c))
    return F.when(whole.isNotNull(), F.format_string("%02d:%02d", F.floor(whole / 60), F.pmod(whole, F.lit(60))))


def floor_half_second(c: Column | str) -> Column:
    return F.floor(column(c) * 2) / 2


def lap_percentage(metres: Column | str, length: Column | str) -> Column:
    """How much of the current lap is done, in percent; null for an unknown or zero length."""
    size = F.nullif(column(length).cast("double"), F.lit(0.0))
    return F.pmod(column(metres).cast("double"), size) / size * 100


def compound_code(c: Column | str) -> Column:
    return lookup(c, COMPOUND_CODES, 0)


def rotated(x: Column | str, y: Column | str, radians: Column) -> tuple[Column, Column]:
    """The point ``(x, y)`` as a row vector times the rotation matrix of the angle."""
    x, y = column(x), column(y)
    return x * F.cos(radians) - y * F.sin(radians), x * F.sin(radians) + y * F.cos(radians)
