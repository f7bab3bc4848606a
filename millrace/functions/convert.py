"""Source values, which all arrive as strings, as typed native expressions; what can't be read is null.

Null and the empty string both mean null. No expression fails on malformed input, ANSI mode or not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that trimming removes: space and the control characters below it.
_TRIMMED = "".join(map(chr, range(1, 33)))


def bound(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often it is used there."""
    return F.get(F.transform(F.array(value), then), 0)


def present(v: Column) -> Column:
    """Null for an empty string."""
    return F.when(v != "", v)


def _trim(v: Column) -> Column:
    return F.trim(present(v), F.lit(_TRIMMED))


def to_string(v: Column) -> Column:
    return present(v)


def to_boolean(v: Column) -> Column:
    """1, true and t in any case are true, any other value is false."""
    return F.lower(_trim(v)).isin("1", "true", "t")


def to_long(v: Column) -> Column:
    """A whole number, also one written with an exponent or zero fraction; else what is before the first point."""
    t = _trim(v)
    whole = F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))
    #: A decimal holds 18 digits after the point; one with more that aren't zeros is no whole number.
    plain = F.regexp_replace(t, r"(\.\d*?)0+$", "$1")
    exact = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") & ~plain.rlike(r"\.\d{19,}"), t.try_cast("decimal(38,18)"))
    head = F.substring_index(t, ".", 1)
    cut = F.when(t.contains(".") & head.rlike(r"^[+-]?\d+$"), head.try_cast("bigint"))
    return F.coalesce(whole, F.when(exact == F.floor(exact), exact.try_cast("bigint")), cut)


def to_int(v: Column) -> Column:
    t = _trim(v)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))


def to_decimal(v: Column, precision: int, scale: int) -> Column:
    """Rounded half up; null where it has too many digits."""
    return _trim(v).try_cast(f"decimal({precision},{scale})")


def to_double(v: Column) -> Column:
    return _trim(v).try_cast("double")


def to_float(v: Column) -> Column:
    return _trim(v).try_cast("float")


def _number(v: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(v, pattern, group).try_cast("int")


def _day(v: Column, pattern: str) -> Column:
    """The date of groups 1 to 3; a day up to 31 beyond the month's end becomes its last day."""
    y, m, d = (_number(v, pattern, i) for i in (1, 2, 3))
    sound = v.rlike(pattern) & m.between(1, 12) & d.between(1, 31) & (y >= 1)
    first = F.make_date(F.when(sound, y), F.when(sound, m), F.lit(1))
    return F.date_add(first, F.least(d, F.dayofmonth(F.last_day(first))) - 1)


_DASH, _SLASH = r"^(\d{4})-(\d{2})-(\d{2})", r"^(\d{4})/(\d{2})/(\d{2})"


def to_date(v: Column) -> Column:
    """yyyy-MM-dd or yyyy/MM/dd; anything after a space at position 10 is dropped."""
    head = lambda t: F.when(F.substring(t, 11, 1) == " ", F.substring(t, 1, 10)).otherwise(t)
    return bound(bound(_trim(v), head), lambda t: F.coalesce(_day(t, _DASH + "$"), _day(t, _SLASH + "$")))


def _canonical(t: Column) -> Column:
    """The accepted forms, told apart by length and separator, as ``yyyy-MM-dd HH:mm:ss.fraction``; else null."""
    n, dash, slash, point = F.length(t), F.substring(t, 5, 1) == "-", t.rlike(_SLASH), F.substring(t, 20, 1) == "."
    dashed = F.translate(t, "/", "-")
    epoch, clock = F.lit("1970-01-01 "), F.substring(t, 3, 1) == ":"
    canon = (
        F.when(n.isin(29, 26, 23) & point, t)
        .when((n == 19) & dash, F.concat(t, F.lit(".0")))
        .when((n == 19) & slash, F.concat(dashed, F.lit(".0")))
        .when(n == 16, F.concat(t, F.lit(":00.0")))
        .when((n == 10) & dash, F.concat(t, F.lit(" 00:00:00.0")))
        .when((n == 10) & slash, F.concat(dashed, F.lit(" 00:00:00.0")))
        .when((n == 8) & clock, F.concat(epoch, t, F.lit(".0")))
        .when(n.isin(12, 15) & clock, F.concat(epoch, t))
    )
    return F.when(canon.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+$"), canon)


def _instant(c: Column, zone: Column | None = None) -> Column:
    """A canonical text's time. Days 29 to 31 beyond the month's end become its last day, 24:00:00 is the
    next midnight, and of a fraction six digits count."""


    def parts(c: Column) -> Column:
        part = lambda at, n: F.substring(c, at, n).try_cast("int")
        s = F.concat(F.substring(c, 18, 3), F.substring(F.rpad(F.substring(c, 21, 9), 6, "0"), 1, 6)).try_cast("decimal(8,6)")
        return F.struct(part(1, 4).alias("y"), part(6, 2).alias("mo"), part(9, 2).alias("d"), part(12, 2).alias("h"), part(15, 2).alias("mi"), s.alias("s"))

    def dated(p: Column) -> Column:
        end = (p["h"] == 24) & (p["mi"] == 0) & (p["s"] == 0)
        sound = (p["y"] >= 1) & p["mo"].between(1, 12) & p["d"].between(1, 31) & (p["h"].between(0, 23) | end) & p["mi"].between(0, 59) & (p["s"] < 60)
        first = F.when(sound, F.make_date(p["y"], p["mo"], F.lit(1)))
        day = bound(first, lambda f: F.date_add(f, F.least(p["d"], F.dayofmonth(F.last_day(f))) - 1 + F.when(end, 1).otherwise(0)))
        return F.struct(day.alias("day"), F.when(end, 0).otherwise(p["h"]).alias("h"), p["mi"].alias("mi"), p["s"].alias("s"))

    def made(x: Column) -> Column:
        args = [F.when(x["day"].isNotNull(), a) for a in (F.year(x["day"]), F.month(x["day"]), F.dayofmonth(x["day"]), x["h"], x["mi"], x["s"])]
        return F.make_timestamp_ntz(*args) if zone is None else F.make_timestamp(*args, zone)

    return bound(bound(bound(c, parts), dated), made)


def to_timestamp(v: Column) -> Column:
    """A time without zone, by length and separator (see ``_canonical``)."""
    return _instant(bound(_trim(v), _canonical))


def to_timestamptz(v: Column) -> Column:
    """An instant: ``yyyy-MM-dd HH:mm:ss[.SSS|.SSSSSS|.SSSSSSSSS] +HH:MM``, or any form without zone as UTC."""
    zoned = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{3}|\.\d{6}|\.\d{9})?) ([+-](?:0\d|1[0-8]):[0-5]\d|Z)$"

    def split(t: Column) -> Column:
        has = t.rlike(zoned)
        zone = F.when(has, F.regexp_replace(F.regexp_extract(t, zoned, 2), "^Z$", "+00:00")).otherwise("UTC")
        return F.struct(F.when(has, F.regexp_extract(t, zoned, 1)).otherwise(t).alias("t"), zone.alias("zone"))

    return bound(bound(_trim(v), split), lambda x: _instant(bound(x["t"], _canonical), x["zone"]))


def to_time(v: Column) -> Column:
    """HH:mm:ss.SSSSSS as a string: the clock of a date and time, or a clock alone, without its zone."""
    return bound(_trim(v), _clock)


def _clock(t: Column) -> Column:
    dated = r"^\d{4}-\d{2}-\d{2} (\d{2}:\d{2}:\d{2}(?:\.\d{3}|\.\d{6})?)$"
    bare = F.when(t.contains(" "), F.regexp_extract(t, r"^(.*) [^ ]*$", 1)).otherwise(t)
    clock = F.when(t.rlike(dated), F.regexp_extract(t, dated, 1)).when(bare.rlike(r"^\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"), bare)
    clock = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    sound = (F.substring(clock, 1, 2) < "24") & (F.substring(clock, 4, 2) < "60") & (F.substring(clock, 7, 2) < "60")
    fraction = F.rpad(F.regexp_extract(clock, r"\.(\d+)$", 1), 6, "0")
    return F.when(sound, F.concat(F.substring(clock, 1, 8), F.lit("."), F.substring(fraction, 1, 6)))


def converter(type_name: str):
    """The expression builder of a column type's simple name; types that can't be read give null."""
    import re

    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", type_name):
        return lambda v: to_decimal(v, int(m[1]), int(m[2]))
    known = {"string": to_string, "boolean": to_boolean, "bigint": to_long, "int": to_int, "double": to_double, "float": to_float, "date": to_date, "timestamp_ntz": to_timestamp, "timestamp": to_timestamptz, "time": to_time}
    return known.get(type_name, lambda v: F.lit(None).cast(type_name))
