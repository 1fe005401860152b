"""Zone-free timestamp expressions.

All results are ``timestamp_ntz`` and none depends on the session time zone, so
a job gives the same months on every cluster.
"""

from pyspark.sql import functions as F


# Month, day, year and minute of a raw date; any other text as a whole.
_RAW_TIME = r"(?s)^(?:\s*(\d{1,2})/(\d{1,2})/(\d{2,4})\s+(\d{1,2}):(\d{1,2})\s*|.*)$"


def parse_minutes(text, strict=False):
    """Parse ``M/D/YYYY HH:MM``, padded or not; garbage gives NULL.

    The text is respelled as an ISO time (a text of another form becomes one
    without digits) and cast. With ``strict`` a text that is present but not a
    valid time stops the job.
    """
    iso = F.regexp_replace(text, _RAW_TIME, "00$3-$1-$2 $4:$5:00")
    parsed = iso.try_cast("timestamp_ntz")
    if not strict:
        return parsed
    complaint = F.concat(F.lit("not a M/D/YYYY HH:MM time: "), text)
    refused = F.when(text.isNotNull(), F.raise_error(complaint).cast("timestamp_ntz"))
    return F.coalesce(parsed, refused)


def month_start(ts):
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def month_label(month):
    """``YYYY-MM`` of a month start."""
    return F.substring(month.cast("date").cast("string"), 1, 7)
