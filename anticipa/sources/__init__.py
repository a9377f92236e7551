"""Typed table readers."""

from .tables import Table, annex_feed, annexes, clients, invoices, read, read_all, users, users_target

__all__ = ["Table", "annex_feed", "annexes", "clients", "invoices", "read", "read_all", "users", "users_target"]
