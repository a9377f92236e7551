"""Keys, payment-term buckets and dates as plain column expressions."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Analysis keys and labels written to the dashboards.
ALL_KEY = "TODOS"
ALL_LABEL = "Todos"
CLIENT_PREFIX = "CLIENTE-"

# Payment-term labels with their first and last day (None = no end).
# Zero and negative terms are in no bucket.
TERM_BUCKETS = (
    ("0-30", 1, 30),
    ("31-45", 31, 45),
    ("46-89", 46, 89),
    ("90", 90, 90),
    (">90", 91, None),
)


def client_key(cliente_id: str = "cliente_id") -> Column:
    return F.concat(F.lit(CLIENT_PREFIX), F.col(cliente_id).cast("string"))


def term_predicate(days: Column, first: int, last: int | None) -> Column:
    return days >= first if last is None else days.between(first, last)


def term_bucket(days: Column) -> Column:
    """Bucket label of a payment term; null when the term is in no bucket."""
    return F.coalesce(*[F.when(term_predicate(days, first, last), label) for label, first, last in TERM_BUCKETS])


def written_date(text: Column) -> Column:
    """Calendar date as written in an ISO timestamp text.

    The offset is ignored, so the result does not depend on the session time zone.
    Unreadable text gives null.
    """
    return F.try_to_date(text)


def day_window(ts: Column, day: date) -> Column:
    """Half-open day `[day, day + 1)` as a range on the raw column, so scans can prune on it."""
    start = F.lit(day).cast("timestamp_ntz")
    end = F.date_add(F.lit(day), 1).cast("timestamp_ntz")
    return (ts >= start) & (ts < end)
