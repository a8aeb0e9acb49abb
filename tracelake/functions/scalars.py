"""Scalar column expressions (all JVM-side, no Python UDF).

Lenient parsing follows the behaviour of the analyses being replaced: a value
that does not parse becomes NULL instead of failing the query.  Every helper
is safe under ANSI mode (``try_*`` functions only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A plain decimal number, optional sign, exponent and surrounding blanks;
# infinities are allowed.  Java's trailing type letters (1d, 1f) are not.
_NUMBER_RE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity)\s*$"
# A zone suffix on an ISO timestamp: Z, +hh, +hh:mm, +hhmm.
_ZONE_RE = r"([zZ]|[+-]\d{2}(:?\d{2})?)$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: ColumnOrName) -> Column:
    """Text → double; anything that is not a number (or is NaN) → NULL."""
    s = _col(c).cast("string")
    parsed = s.try_cast("double")
    ok = F.lower(s).rlike(_NUMBER_RE)
    return F.when(ok & ~F.isnan(parsed), parsed)


def lenient_decimal(c: ColumnOrName, precision: int = 38, scale: int = 10) -> Column:
    """Lenient number as an exact decimal, for sums that must not drift."""
    return lenient_double(c).try_cast(f"decimal({precision},{scale})")


def typed_decimal(c: ColumnOrName, dtype, precision: int = 38, scale: int = 10) -> Column:
    """A number as an exact decimal: numeric columns are cast directly (NaN
    and infinities become NULL), text is parsed leniently."""
    from pyspark.sql import types as T

    col = _col(c)
    target = f"decimal({precision},{scale})"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col.try_cast(target))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return col.try_cast(target)
    return lenient_decimal(col, precision, scale)


def epoch() -> Column:
    """1970-01-01 as ``timestamp_ntz``."""
    return F.lit("1970-01-01").cast("timestamp_ntz")


def from_micros(c: ColumnOrName) -> Column:
    """Microseconds since the epoch as a UTC wall clock (``timestamp_ntz``).
    Plain arithmetic: the session's zone, with its summer time, has no part."""
    return F.timestamp_add("MICROSECOND", _col(c), epoch())


def to_ts(c: ColumnOrName) -> Column:
    """Lenient text → timestamp (UTC wall clock, ``timestamp_ntz``).

    ISO date-times with or without a zone and plain dates parse; anything else
    is NULL.  A zoned value is converted to UTC first.
    """
    s = F.trim(_col(c).cast("string"))
    zoned = s.rlike(_ZONE_RE) & s.contains(":")
    as_utc = from_micros(F.unix_micros(F.try_to_timestamp(s)))
    return F.when(zoned, as_utc).otherwise(s.try_cast("timestamp_ntz"))


def utc_wall_clock(c: ColumnOrName, dtype) -> Column:
    """Any time-like column as a UTC ``timestamp_ntz``: a zoned timestamp is
    converted from its instant, a ``timestamp_ntz`` kept, text parsed
    leniently."""
    from pyspark.sql import types as T

    col = _col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz")  # midnight of that day
    if isinstance(dtype, T.TimestampType):
        return from_micros(F.unix_micros(col))
    return to_ts(col)


def to_ts_strict(c: ColumnOrName) -> Column:
    """Strict text → timestamp: a value that does not parse fails the query
    (``raise_error``); NULL stays NULL."""
    s = F.trim(_col(c).cast("string"))
    return F.when(s.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(
        F.coalesce(to_ts(s), F.raise_error(F.concat(F.lit("bad timestamp: "), s)).cast("timestamp_ntz"))
    )


def epoch_ms(c: ColumnOrName) -> Column:
    """Epoch milliseconds → UTC timestamp (``timestamp_ntz``)."""
    return F.timestamp_add("MILLISECOND", _col(c).cast("bigint"), epoch())


def hour_floor(c: ColumnOrName) -> Column:
    """Floor a ``timestamp_ntz`` to the hour, result ``timestamp_ntz``."""
    day = _col(c).cast("date").cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.hour(_col(c)), day)


def fill_label(c: ColumnOrName, label: str) -> Column:
    return F.coalesce(_col(c), F.lit(label))


def blank_to(c: ColumnOrName, placeholder: str) -> Column:
    """NULL or empty text → placeholder."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit(placeholder))


def number_text(c: ColumnOrName) -> Column:
    """A double as Python prints it, with an exponent only below 1e-4 and from
    1e16 on (Spark writes one below 1e-3 and from 1e7).  The digits are the
    JVM's: before Java 19 a few values, such as 2.5e22, get more than needed."""
    value = _col(c).cast("double")
    text = value.cast("string")
    plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    digits = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    sign = F.when(power < 0, "e-").otherwise("e+")
    size = F.abs(power).cast("string")
    short = F.concat(digits, sign, F.when(F.length(size) < 2, F.lpad(size, 2, "0")).otherwise(size))
    return F.when(~text.contains("E"), text).when((power >= -4) & (power < 16), plain).otherwise(short)


def truncate(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_col(c), 1, n)


def json_list(c: ColumnOrName) -> Column:
    """JSON text → array<string>; only a JSON array yields a value."""
    s = F.trim(_col(c))
    return F.when(s.startswith("["), F.from_json(s, "array<string>", {"mode": "PERMISSIVE"}))


def session_label(title: ColumnOrName, sid: ColumnOrName) -> Column:
    """``title[:60] (id)``."""
    return F.concat(truncate(F.coalesce(_col(title), F.lit("")), 60), F.lit(" ("), _col(sid), F.lit(")"))
