"""Refreshing dashboards when new input files arrive."""

from .arrivals import refresh_on_arrival

__all__ = ["refresh_on_arrival"]
