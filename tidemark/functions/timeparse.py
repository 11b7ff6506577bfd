"""RFC-2822 date text <-> naive UTC timestamps, independent of the session
time zone.

Naive (TIMESTAMP_NTZ) values in this library always mean UTC wall-clock
time.  Conversions go through epoch arithmetic (``timestamp_add`` /
``timestamp_diff`` on NTZ values), never through a cast that would apply the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RFC-2822 layout "Fri, 03 Oct 2025 00:00:01 +0000".
# Spark 3+ cannot parse the day-name letter 'E', so the leading "Fri, " is cut
# off before parsing; the offset ('Z') is honoured.
RFC2822_BODY = "d MMM yyyy HH:mm:ss Z"
RFC2822_OUT = "EEE, dd MMM yyyy HH:mm:ss"
UTC_OFFSET_TEXT = " +0000"

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_ntz(col: Column | str) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall-clock time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), _epoch_ntz())


def epoch_micros_ntz(col: Column | str) -> Column:
    """Microseconds since the epoch of a naive UTC timestamp."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(col))


def epoch_seconds_ntz(col: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _epoch_ntz(), _c(col))


def parse_rfc2822(col: Column | str) -> Column:
    """Lenient parse to naive UTC: unparsable text gives NULL, not an error."""
    body = F.trim(F.regexp_replace(_c(col), r"^\s*[A-Za-z]{3},\s*", ""))
    return utc_ntz(F.try_to_timestamp(body, F.lit(RFC2822_BODY)))


def format_rfc2822(col: Column | str) -> Column:
    """Render a naive UTC timestamp (or a date) as RFC-2822 text in UTC,
    e.g. 'Fri, 03 Oct 2025 00:00:01 +0000'."""
    ntz = _c(col).cast("timestamp_ntz")
    return F.concat(F.date_format(ntz, RFC2822_OUT), F.lit(UTC_OFFSET_TEXT))
