"""Wire values to Spark values: numbers, clocks, zones, containers.

Everything here is a column expression. Values that do not fit come out NULL and
the typed projection sends their row to quarantine, so nothing fails a whole job.
The session clock is UTC (see session.configure).
"""

from __future__ import annotations

import re
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesync.functions import types as T

DAY_MICROS = 86_400_000_000
# Microseconds of 0001-01-01 and 9999-12-31T23:59:59.999999 since the epoch.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999

# Text forms of a shifted or zoned timestamp.
DATETIME_TEXT = "yyyy-MM-dd HH:mm:ss"
DATETIME_MILLIS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
ISO_LOCAL_TEXT = "yyyy-MM-dd'T'HH:mm:ss"


def zone(text: str) -> str:
    """Normalise a zone id to an offset `+HH:MM` or a known region; reject anything else."""
    name = text.strip()
    if name.upper() in ("Z", "UTC", "GMT"):
        return "+00:00"
    found = re.fullmatch(r"(?:GMT|UTC)?([+-])(\d{1,2})(?::?([0-5]\d))?", name, re.IGNORECASE)
    if found:
        sign, hours, minutes = found[1], int(found[2]), int(found[3] or 0)
        if hours * 60 + minutes <= 18 * 60:
            return f"{sign}{hours:02d}:{minutes:02d}"
    elif name in available_timezones():
        return name
    raise ValueError(f"unknown time zone {text!r}")


def offset_millis(text: str) -> int:
    """Fixed offset of a zone in milliseconds; a region has no single offset."""
    found = re.fullmatch(r"([+-])(\d\d):(\d\d)", zone(text))
    if not found:
        raise ValueError(f"zone {text!r} has no fixed offset")
    minutes = int(found[2]) * 60 + int(found[3])
    return (-1 if found[1] == "-" else 1) * minutes * 60_000


def zone_shift(source: str, target: str) -> int:
    """Milliseconds to add to a source wall clock to get the target wall clock."""
    return offset_millis(target) - offset_millis(source)


def date_from_days(days: Column) -> Column:
    return F.date_from_unix_date(days.try_cast("int"))


def ntz_from_micros(micros: Column) -> Column:
    """UTC wall clock of epoch microseconds, free of the session zone."""
    fits = F.when(micros.between(MIN_MICROS, MAX_MICROS), micros)
    return F.timestamp_add("MICROSECOND", fits, F.lit("1970-01-01").cast("timestamp_ntz"))


def ntz_from_millis(millis: Column) -> Column:
    return ntz_from_micros(F.try_multiply(millis, F.lit(1000).cast("bigint")))


def ntz_from_nanos(nanos: Column) -> Column:
    return ntz_from_micros(_whole(nanos, 1000))


def time_from_micros(micros: Column) -> Column:
    """Time of day; outside one day there is none."""
    inside = F.when(micros.between(0, DAY_MICROS - 1), micros)
    seconds = (inside / F.lit(1_000_000)).cast("decimal(18,6)")
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.lit("00:00:00").cast("time(6)") + since


def time_from_nanos(nanos: Column) -> Column:
    return time_from_micros(_whole(nanos, 1000))


def shifted_millis(millis: Column, shift: int) -> Column:
    """Zone shift of a migration; the epoch itself is a default value and stays."""
    if shift == 0:
        return millis
    return F.when(millis == 0, millis).otherwise(F.try_add(millis, F.lit(shift).cast("bigint")))


def shifted_text(millis: Column, shift: int) -> Column:
    """Shifted wall clock as text, whole seconds."""
    return F.date_format(ntz_from_millis(shifted_millis(millis, shift)), DATETIME_TEXT)


def zoned_wall_clock(text: Column, target_zone: str) -> Column:
    """Instant text (or epoch milliseconds as text) -> wall clock of the target zone."""
    # Numbers first: as text a bare number would be read as a year.
    instant = F.coalesce(
        ntz_from_millis(whole_number(text)).cast("timestamp"),
        _without_zero_date(text).try_cast("timestamp"),
    )
    # Unlike convert_timezone this looks a constant zone up once, not per row.
    return F.from_utc_timestamp(instant, zone(target_zone)).cast("timestamp_ntz")


def zoned_iso_text(text: Column, target_zone: str) -> Column:
    return F.date_format(zoned_wall_clock(text, target_zone), ISO_LOCAL_TEXT)


def zoned_text(text: Column, target_zone: str) -> Column:
    """Space separated form; milliseconds are kept when the input text carries a fraction."""
    clock = zoned_wall_clock(text, target_zone)
    fraction = (F.length(text) > 20) & whole_number(text).isNull()
    return F.when(fraction, F.date_format(clock, DATETIME_MILLIS_TEXT)).otherwise(
        F.date_format(clock, DATETIME_TEXT)
    )


def decimal_from_base64(text: Column, scale: int) -> Column:
    """Two's-complement big-endian unscaled bytes -> decimal(38,20), up to 16 bytes."""
    hexed = F.hex(F.try_to_binary(text, F.lit("base64")))
    # One-element arrays bind a value to a name, so each step is computed once.
    return F.get(F.transform(F.array(hexed), lambda h: _decimal_of_hex(h, scale)), F.lit(0))


def _decimal_of_hex(hexed: Column, scale: int) -> Column:
    negative = F.substring(hexed, 1, 1) >= "8"
    padded = F.when(negative, F.lpad(hexed, 32, "F")).otherwise(F.lpad(hexed, 32, "0"))
    whole = "decimal(38,0)"

    def word(start: Column) -> Column:
        # A negative number is -(complement + 1), so both signs add up unsigned words.
        number = F.conv(F.substring(padded, start, F.lit(8)), 16, 10).cast("decimal(20,0)")
        return F.when(negative, F.lit(0xFFFFFFFF) - number).otherwise(number).cast(whole)

    def shift_in(total: Column, start: Column) -> Column:
        shifted = F.try_multiply(total, F.lit(2**32).cast("decimal(10,0)")).try_cast(whole)
        return F.try_add(shifted, word(start)).try_cast(whole)

    def render(total: Column) -> Column:
        one = F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
        digits = F.try_add(total, one).try_cast(whole).cast("string")
        if scale > 0:
            digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
            digits = F.regexp_replace(digits, rf"([0-9]{{{scale}}})$", r".$1")
        return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), digits).try_cast("decimal(38,20)")

    starts = F.array(*[F.lit(i) for i in (1, 9, 17, 25)])
    value = F.aggregate(starts, F.lit(0).cast(whole), shift_in, render)
    return F.when((F.length(hexed) > 0) & (F.length(hexed) <= 32), value)


def field_path(name: str) -> str:
    """Path of one field of a VARIANT object."""
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def whole_number(text: Column) -> Column:
    """Text of a whole number as a number, NULL for other text.

    A failed cast raises and catches an exception per row; the pattern costs a
    twentieth of that where clocks arrive as text.
    """
    return F.when(F.rlike(text, F.lit("^-?[0-9]{1,19}$")), text).try_cast("bigint")


def number_field(row: Column, name: str) -> Column:
    """Field as a whole number, whether it came as a number or as its text."""
    return whole_number(F.try_variant_get(row, field_path(name), "string"))


def raw_field(row: Column, name: str) -> Column:
    return F.try_variant_get(row, field_path(name), "variant")


def present(row: Column, name: str) -> Column:
    """True if the field exists and is not JSON null."""
    raw = raw_field(row, name)
    return raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(True))


def typed_field(
    row: Column,
    spec: T.ColumnSpec,
    target_zone: str = "UTC",
    shift: int = 0,
    widen_unsigned: bool = False,
    number: Column | None = None,
) -> Column:
    """One field of a VARIANT row as its target type; NULL if absent or not convertible.

    Time values may also arrive as text that an earlier hop already rendered. `number`
    is the field as a number where the caller has read it already.
    """
    path = field_path(spec.name)

    def get(kind: str) -> Column:
        return F.try_variant_get(row, path, kind)

    kind = spec.spark_type(widen_unsigned)
    wire = spec.wire_type
    text = F.nullif(get("string"), F.lit(""))
    number = whole_number(text) if number is None else number
    if wire in (T.DATE, T.CONNECT_DATE):
        value = F.coalesce(date_from_days(number), _without_zero_date(text).try_cast("date"))
    elif wire in (T.TIMESTAMP, T.CONNECT_TIMESTAMP):
        value = F.coalesce(ntz_from_millis(shifted_millis(number, shift)), _clock(text))
    elif wire == T.MICRO_TIMESTAMP:
        value = F.coalesce(ntz_from_micros(number), _clock(text))
    elif wire == T.NANO_TIMESTAMP:
        value = F.coalesce(ntz_from_nanos(number), _clock(text))
    elif wire == T.ZONED_TIMESTAMP:
        value = zoned_wall_clock(text, target_zone)
    elif wire == T.CONNECT_TIME:
        value = F.coalesce(time_from_micros(F.try_multiply(number, F.lit(1000).cast("bigint"))), _time(text))
    elif wire == T.MICRO_TIME:
        value = F.coalesce(time_from_micros(number), _time(text))
    elif wire == T.NANO_TIME:
        value = F.coalesce(time_from_nanos(number), _time(text))
    elif wire == T.DECIMAL_BASE64:
        value = decimal_from_base64(text, spec.scale)
    elif kind == "binary":
        value = F.try_to_binary(get("string"), F.lit("base64"))
    elif kind == "string":
        value = get("string")
    else:
        value = get(kind)
    if wire and not (kind.startswith("decimal") or kind == "binary"):
        value = value.cast(kind) if kind == "string" else value.try_cast(kind)
    if spec.default is not None:
        value = F.when(present(row, spec.name), value).otherwise(F.lit(spec.default).cast(kind))
    return value


def read_as_number(spec: T.ColumnSpec) -> bool:
    """Whether the field is a clock that usually arrives as a number."""
    return spec.wire_type in (
        T.DATE, T.CONNECT_DATE, T.TIMESTAMP, T.CONNECT_TIMESTAMP, T.MICRO_TIMESTAMP, T.NANO_TIMESTAMP,
        T.CONNECT_TIME, T.MICRO_TIME, T.NANO_TIME,
    )


def array_field(row: Column, name: str, element: str) -> Column:
    """Array of typed elements."""
    return F.try_variant_get(row, field_path(name), f"array<{element}>")


def map_field(row: Column, name: str, value: str) -> Column:
    """Map with text keys, carried as an object."""
    return F.try_variant_get(row, field_path(name), f"map<string,{value}>")


def keyed_pairs_field(row: Column, name: str, key: str, value: str) -> Column:
    """Map with other keys, carried as an array of [key, value] pairs."""
    pairs = F.try_variant_get(row, field_path(name), "array<array<variant>>")
    return F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(
                F.try_variant_get(F.get(p, F.lit(0)), "$", key).alias("key"),
                F.try_variant_get(F.get(p, F.lit(1)), "$", value).alias("value"),
            ),
        )
    )


def pairs_of_map(entries: Column) -> Column:
    """Map with non-text keys -> array of [key, value] pairs as text."""
    return F.transform(
        F.map_entries(entries),
        lambda e: F.array(e["key"].cast("string"), e["value"].cast("string")),
    )


def struct_field(row: Column, name: str, fields: str) -> Column:
    """Nested struct, `fields` in DDL form."""
    return F.try_variant_get(row, field_path(name), f"struct<{fields}>")


def _whole(value: Column, divisor: int) -> Column:
    step = F.lit(divisor).cast("bigint")
    return F.call_function("div", F.try_subtract(value, F.pmod(value, step)), step)


def _without_zero_date(text: Column) -> Column:
    return F.when(~F.startswith(text, F.lit("0000-00-00")), text)


def _clock(text: Column) -> Column:
    return _without_zero_date(text).try_cast("timestamp_ntz")


def _time(text: Column) -> Column:
    return F.regexp_replace(text, "Z$", "").try_cast("time(6)")
