"""Timestamp parsing, ISO rendering and time-range predicates as column expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp formats tried in this order.
DEFAULT_FORMATS = [
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%dT%H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S%z",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%d",
    "%d/%m/%Y %H:%M:%S",
    "%m/%d/%Y %H:%M:%S",
]

# directive -> (Spark pattern letters, regular expression of what it accepts)
_DIRECTIVES = {
    "%Y": ("yyyy", r"\d{4}"),
    "%m": ("M", r"\d{1,2}"),
    "%d": ("d", r"\d{1,2}"),
    "%H": ("H", r"\d{1,2}"),
    "%M": ("m", r"\d{1,2}"),
    "%S": ("s", r"\d{1,2}"),
    "%f": ("SSSSSS", r"\d{1,6}"),
    "%z": ("[XXX][XX]", r"(?:Z|[+-]\d{2}:?\d{2})"),
    "%b": ("MMM", r"[A-Za-z]{3}"),
    "%y": ("yy", r"\d{2}"),
}

_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
# Texts whose first fitting default format reads them just as a cast does.
_PLAIN_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{6})?$"
_YEAR_10000 = 253402300800.0


def _translate(fmt: str) -> tuple[str, str]:
    """strptime format -> (Spark datetime pattern, regular expression for its shape)."""
    pattern, shape = "", ""
    for part in re.findall(r"%.|[^%]+", fmt):
        if part.startswith("%"):
            if part not in _DIRECTIVES:
                raise ValueError(f"unsupported directive {part} in {fmt!r}")
            letters, accepts = _DIRECTIVES[part]
            pattern, shape = pattern + letters, shape + accepts
        else:
            pattern += re.sub(r"[A-Za-z]+", lambda m: f"'{m.group()}'", part)
            shape += re.escape(part)
    return pattern, f"^{shape}$"


def _epoch(x: Column) -> Column:
    """Digits with at most one dot: seconds, or milliseconds above 1e10."""
    number = x.try_cast("double")
    seconds = F.when(number > 1e10, number / 1000).otherwise(number)
    return F.when(
        x.rlike(r"^(?:\d+\.?\d*|\.\d+)$") & (seconds < _YEAR_10000),
        F.timestamp_micros(F.round(seconds * 1e6).cast("bigint")),
    )


def parse_timestamp(x: Column, formats: list[str] | None = None) -> Column:
    """First format that fits, then ISO, then ``yyyyMMdd`` for eight digits, then epoch digits.

    Every format is tried only on strings of its shape, so a row costs one real
    parse instead of a chain of failed ones. The commonest shapes of the default
    formats are cast, which costs a fraction of a parse by pattern.
    """
    attempts = [] if formats else [F.when(x.rlike(_PLAIN_SHAPE), x.try_cast("timestamp"))]
    for fmt in formats or DEFAULT_FORMATS:
        pattern, shape = _translate(fmt)
        attempts.append(F.when(x.rlike(shape), F.try_to_timestamp(x, F.lit(pattern))))
    attempts.append(F.when(x.rlike(_ISO_SHAPE), x.try_cast("timestamp")))
    attempts.append(F.when(x.rlike(r"^\d{8}$"), F.try_to_timestamp(x, F.lit("yyyyMMdd"))))
    attempts.append(_epoch(x))
    return F.coalesce(*attempts)


def iso_text(ts: Column) -> Column:
    """ISO text; the fraction is printed only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.unix_micros(ts) % 1000000 == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def _bound(value: str | dt.datetime) -> dt.datetime:
    parsed = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(value)
    if parsed.tzinfo:
        parsed = parsed.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return parsed


def in_range(ts: Column, start: str | None = None, end: str | None = None) -> Column:
    """``start`` is inclusive; ``end`` covers its whole day even when it names a time."""
    condition = F.lit(True)
    if start:
        condition = condition & (ts >= F.lit(_bound(start).isoformat(sep=" ")).cast("timestamp"))
    if end:
        next_day = _bound(end).date() + dt.timedelta(days=1)
        condition = condition & (ts < F.lit(next_day.isoformat()).cast("timestamp"))
    return condition


def time_filter(
    ts: Column, start: str | None = None, end: str | None = None, keep_undated: bool = True
) -> Column:
    """Range filter for log rows; rows without a timestamp survive unless told otherwise."""
    if not start and not end:
        return F.lit(True)
    dated = F.coalesce(in_range(ts, start, end), F.lit(False))
    return (ts.isNull() | dated) if keep_undated else dated
