"""Column builders: text, dates, times, weekday masks and distances. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BLANKS, DAYS, EARTH_RADIUS_M, RAIL_SPEED_KMH, ZONES


def clean_text(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.trim(c), '^"+|"+$', "")))


def blank_to_null(c: Column, extra: tuple[str, ...] = ()) -> Column:
    return F.when(~F.trim(c).isin(*BLANKS, *extra), c)


def invalid_coord(lat: Column, lon: Column) -> Column:
    """No coordinate, out of range, or at the null island."""
    wrong = lat.isNull() | lon.isNull() | (F.abs(lat) > 90) | (F.abs(lon) > 180) | ((F.abs(lat) < 1e-9) & (F.abs(lon) < 1e-9))
    return F.coalesce(wrong, F.lit(True))


def fix_timezone(zone: Column, country: Column) -> Column:
    vague = zone.isNull() | F.upper(zone).isin("CET", "UTC")
    known = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    return F.when(vague, F.coalesce(known[country], zone)).otherwise(zone)


def country_alias(c: Column) -> Column:
    return F.when(c == "UK", "GB").otherwise(c)


def selective_title(c: Column) -> Column:
    """Title case for names in capitals that join two places."""
    return F.when((c == F.upper(c)) & (c.contains(" - ") | c.contains(" <> ")), F.initcap(c)).otherwise(c)


def time_part(c: Column) -> Column:
    return F.substring_index(c, " ", -1)


def hms_to_seconds(c: Column) -> Column:
    """Seconds of H:M:S; hours may exceed 24, missing parts are 0, no number gives null."""
    parts = F.split(time_part(c), ":")
    number = lambda k: F.get(parts, F.lit(k)).try_cast("int")
    return number(0) * 3600 + F.coalesce(number(1), F.lit(0)) * 60 + F.coalesce(number(2), F.lit(0))


def half_up(c: Column, digits: int) -> Column:
    """Rounds positive numbers, halves up. The small addition keeps a half a half if its last bit is off."""
    return F.floor(c * float(10**digits) + 0.500001) / float(10**digits)


def units(c: Column | str, scale: int) -> Column:
    """A number of `scale` decimals as whole units of its last one: their sums don't depend on the order of rows or tasks."""
    return F.round((F.col(c) if isinstance(c, str) else c) * float(10**scale)).cast("long")


def exact_sum(c: Column | str, scale: int, digits: int) -> Column:
    """Aggregate: the sum of numbers of `scale` decimals, rounded once."""
    return half_up(F.sum(units(c, scale)).cast("double") / float(10**scale), digits)


def exact_mean(c: Column | str, scale: int, digits: int) -> Column:
    """Aggregate: the mean of numbers of `scale` decimals, rounded once."""
    u = units(c, scale)
    return half_up(F.sum(u).cast("double") / float(10**scale) / F.count(u), digits)


def trip_duration_min(departure: Column, arrival: Column, km: Column) -> Column:
    dep, arr = hms_to_seconds(departure), hms_to_seconds(arrival)
    seconds = arr - dep + F.when(arr < dep, 86400).otherwise(0)
    return half_up(F.coalesce(seconds / 60.0, km / RAIL_SPEED_KMH * 60.0), 1)


def norm_date8(c: Column, strict: bool = True) -> Column:
    """YYYYMMDD of an ISO date or of eight digits; else null (strict) or unchanged."""
    iso = F.regexp_replace(F.substring(c, 1, 10), "-", "")
    out = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), iso).when(c.rlike(r"^\d{8}$"), c)
    return out if strict else out.otherwise(c)


def days_mask(columns: tuple[str, ...] = DAYS) -> Column:
    return F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in columns])


def mask_from_text(c: Column) -> Column:
    """Weekday bits of words such as `Daily`, `daily except Sat`, `Fri (Oct-Jun)`, `Son`."""
    text = F.lower(F.regexp_replace(c, r"\(.*?\)", ""))
    daily, but = text.contains("daily"), F.substring_index(text, "except", -1)
    bits = []
    for names in (("mon",), ("tue",), ("wed",), ("thu",), ("fri",), ("sat",), ("sun", "son")):
        here = lambda t, names=names: F.lit(False) if not names else (t.contains(names[0]) if len(names) == 1 else t.contains(names[0]) | t.contains(names[1]))
        on = F.when(text.contains("except"), daily & ~here(but)).otherwise(daily | here(text))
        bits.append(F.when(F.coalesce(on, F.lit(False)), "1").otherwise("0"))
    return F.concat(*bits)


def mask_or(c: Column) -> Column:
    """Aggregate: a day runs if it runs in any row."""
    mask = F.coalesce(c, F.lit("0000000"))
    return F.concat(*[F.max(F.substring(mask, i, 1)) for i in range(1, 8)])


def train_number(c: Column) -> Column:
    return F.regexp_extract(c, r"\d{3,6}", 0)


def train_number_list(c: Column) -> Column:
    """All blocks of three to six digits."""
    return F.regexp_extract_all(c, F.lit(r"(\d{3,6})"), 1)


def known_mask(c: Column) -> Column:
    """mask_from_text() where the text names a day; null where it names none."""
    mask = mask_from_text(c)
    return F.when(mask != "0000000", mask)


def column_name(c: Column, renamed: dict[str, str]) -> Column:
    """Names of a column catalogue: no quotes, spaces or capitals, and one spelling for known variants."""
    plain = F.lower(F.trim(F.regexp_replace(c, '"', "")))
    if not renamed:
        return plain
    return F.coalesce(F.create_map(*[F.lit(x) for kv in renamed.items() for x in kv])[plain], plain)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))
