"""Timestamp literals for TIMESTAMP_NTZ columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime, a date or an ISO string.

    Built from text, so no time zone takes part: ``F.lit(datetime)`` would
    make a zoned literal through the Python process's local zone, and its
    comparison with a TIMESTAMP_NTZ column would then depend on the session
    time zone.
    """
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")
