"""Event-time text <-> timestamp, independent of the session time zone.

Convention: a TIMESTAMP_NTZ holds UTC wall-clock time (the given tables store
``ts`` that way); a TIMESTAMP is an instant.  The helpers convert between the
two by counting from the epoch, never through the session's local wall clock, so
results do not depend on ``spark.sql.session.timeZone`` or its clock changes.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the event-time pattern it parses
# (microsecond fraction, ISO offset or Z).
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def instant_of_utc(ntz: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP instant."""
    since = ntz - F.expr(_EPOCH)  # an interval between wall clocks: no zone is involved
    micros = sum((F.extract(F.lit(unit), since).cast("bigint") * F.lit(size)
                  for unit, size in (("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000))),
                 (F.extract(F.lit("SECOND"), since) * F.lit(1_000_000)).cast("bigint"))
    return F.timestamp_micros(micros)


def utc_of_instant(ts: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ holding its UTC wall clock."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_now() -> Column:
    return utc_of_instant(F.current_timestamp())


def parse_event_time(text: Column, pattern: str = EVENT_TIME_PATTERN, lenient: bool = False) -> Column:
    """Parse event-time text to an instant; a mismatch is NULL, never an error.

    ``try_to_timestamp`` keeps the NULL-on-mismatch behaviour under ANSI mode.
    The strict pattern accepts 1-6 fraction digits with ``Z`` or ``+hh:mm`` and
    rejects a time without a fraction; ``lenient=True`` also takes that form.
    """
    strict = F.try_to_timestamp(text, F.lit(pattern))
    if lenient:
        return F.coalesce(strict, F.try_to_timestamp(text))
    return strict


def format_event_time(utc_ntz: Column) -> Column:
    """ISO-8601 text with microseconds, e.g. ``2025-10-17T20:06:33.569184+00:00``,
    from a UTC wall-clock TIMESTAMP_NTZ (use ``utc_of_instant`` for an instant)."""
    text = utc_ntz.cast("string")  # "2025-10-17 20:06:33.569184", trailing zeros of the fraction left out
    fraction = F.rpad(F.regexp_extract(text, r"\.(\d+)$", 1), 6, "0")
    whole = F.regexp_replace(F.regexp_replace(text, r"\.\d+$", ""), " ", "T")
    return F.concat(whole, F.lit("."), fraction, F.lit("+00:00"))
