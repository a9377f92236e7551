"""Column expressions shared by the operators."""

from .columns import (
    ALL_KEY,
    ALL_LABEL,
    CLIENT_PREFIX,
    TERM_BUCKETS,
    client_key,
    day_window,
    term_bucket,
    term_predicate,
    written_date,
)

__all__ = [
    "ALL_KEY",
    "ALL_LABEL",
    "CLIENT_PREFIX",
    "TERM_BUCKETS",
    "client_key",
    "day_window",
    "term_bucket",
    "term_predicate",
    "written_date",
]
