"""Zone-free timestamps as microseconds since the epoch, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SECOND = 1_000_000


def _parts(moment: Column) -> tuple[Column, Column]:
    """Whole seconds since the epoch, rounded down, and the microseconds after them; no decimals.

    The seconds of a TIMESTAMP_NTZ do not depend on the zone. The rest is taken from the moment in
    the session's zone, which is whole seconds away.
    """
    moment = moment.cast("timestamp_ntz")
    seconds = F.unix_timestamp(moment)  # rounded towards zero
    rest = F.pmod(F.unix_micros(moment.cast("timestamp")), F.lit(_SECOND))
    rounded_up = (moment < F.lit("1970-01-01").cast("timestamp_ntz")) & (rest > 0)
    return seconds - rounded_up.cast("bigint"), rest


def micros_of(moment: Column) -> Column:
    """TIMESTAMP_NTZ to microseconds."""
    seconds, rest = _parts(moment)
    return seconds * F.lit(_SECOND) + rest


def millis_of(moment: Column) -> Column:
    """TIMESTAMP_NTZ to milliseconds, rounded down."""
    seconds, rest = _parts(moment)
    return seconds * F.lit(1000) + F.call_function("div", rest, F.lit(1000))


def moment_of(micros: Column) -> Column:
    """Microseconds to TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
