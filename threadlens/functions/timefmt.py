"""Zone-free time helpers over epoch seconds.

The comment dumps carry ``created_utc`` as epoch seconds.  Deriving calendar
fields through ``date_from_unix_date`` and integer arithmetic keeps results
identical whatever ``spark.sql.session.timeZone`` a cluster runs with (the
original jobs silently used the host zone while labelling output "UTC").
"""

from __future__ import annotations

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(ts) -> Column:
    """Epoch seconds of a timestamp.  A ``timestamp_ntz`` value is read as a
    UTC wall clock, independent of the session zone."""
    return F.unix_timestamp(_c(ts))


def utc_date(epoch) -> Column:
    """UTC calendar date of epoch seconds."""
    return F.date_from_unix_date(F.floor(_c(epoch) / F.lit(SECONDS_PER_DAY)).cast("int"))


def day_number(epoch) -> Column:
    """``yyyyMMdd`` of epoch seconds as a bigint (UTC), e.g. 20240131."""
    return F.date_format(utc_date(epoch), "yyyyMMdd").cast("bigint")


def utc_year(epoch) -> Column:
    return F.year(utc_date(epoch)).cast("bigint")


def utc_month(epoch) -> Column:
    return F.month(utc_date(epoch)).cast("bigint")


# Every helper below mentions its input once.  Catalyst pushes filters
# through projections by substituting column definitions, so a helper that
# used its input ten times would copy an expensive input (say, a field of a
# parsed JSON message) ten times into the pushed predicate.

def utc_timestamp_ntz(epoch) -> Column:
    """Epoch seconds as a ``timestamp_ntz`` holding the UTC wall clock:
    1970-01-01 plus an interval, so no session zone is involved."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(epoch).cast("decimal(18,6)"))


def slot_start(epoch, slot_seconds: int = 60) -> Column:
    """Start (epoch seconds) of the tumbling slot that contains ``epoch``."""
    return (F.floor(_c(epoch) / F.lit(slot_seconds)) * F.lit(slot_seconds)).cast("bigint")


def minute_slot(epoch) -> Column:
    """``yyyyMMddHHmm`` of epoch seconds as a bigint (UTC), e.g. 202401311259."""
    return F.date_format(utc_timestamp_ntz(epoch), "yyyyMMddHHmm").cast("bigint")


def slot_of_epoch(epoch, slot_seconds: int = 60) -> Column:
    """Label (``yyyyMMddHHmm``) of the slot containing ``epoch``."""
    return minute_slot(slot_start(epoch, slot_seconds))


def slot_label(epoch: int, slot_seconds: int = 60) -> int:
    """``slot_of_epoch`` of a number, for a read at a known time."""
    return int(time.strftime("%Y%m%d%H%M", time.gmtime(epoch // slot_seconds * slot_seconds)))


def day_label(epoch: int) -> int:
    """``day_number`` of a number."""
    return int(time.strftime("%Y%m%d", time.gmtime(epoch)))


def second_slot(epoch) -> Column:
    """Arrival second of a live comment (floor of epoch seconds)."""
    return F.floor(_c(epoch)).cast("bigint")


def format_mdy_hms(epoch) -> Column:
    """``MM-dd-yyyy HH:mm:ss`` in UTC."""
    return F.date_format(utc_timestamp_ntz(epoch), "MM-dd-yyyy HH:mm:ss")


def display_time(epoch) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, as a feed shows it."""
    return F.date_format(utc_timestamp_ntz(epoch), "yyyy-MM-dd HH:mm:ss")
