"""Strict reading of ISO-8601 instants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The cast to TIMESTAMP alone also takes dates, blanks for T and zoneless text.
INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{0,9})?(Z|[+-]\d\d:\d\d(:\d\d)?)\z"
END_OF_DAY = r"^.{10}T24:00:00(\.0*)?[Z+-]"
LEAP_SECOND = r"^.{10}T23:59:60"


def parse_instant(text: Column) -> Column:
    """The instant, cut to microseconds, or NULL if the (upper-case) text is none.

    ``24:00:00`` is the next midnight and a leap second counts as the second
    before it.
    """
    unusual = F.when(
        text.rlike(END_OF_DAY),
        F.try_to_timestamp(F.regexp_replace(text, "T24:", "T00:")) + F.expr("INTERVAL 1 DAY"),
    ).when(
        text.rlike(LEAP_SECOND),
        F.try_to_timestamp(F.regexp_replace(text, "T23:59:60", "T23:59:59")),
    )
    return F.when(text.rlike(INSTANT), F.coalesce(F.try_to_timestamp(text), unusual))


def instant_text(moment: Column) -> Column:
    """Instant as text in UTC with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
