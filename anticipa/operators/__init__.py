"""Relational operators over the typed inputs. Those that write say so; the others are lazy."""

from .groups import credit_days_of_groups, invoice_groups, pareto_of_groups, rates_of_groups
from .indicators import (
    annex_indicators,
    annex_indicators_all,
    annex_indicators_by_client,
    credit_days,
    credit_days_all,
    credit_days_by_client,
    rate_frequencies,
    rate_indicators,
    rate_indicators_all,
    rate_indicators_by_client,
)
from .inputs import annex_items, item_fields, nested_fields, open_fields, unique_clients
from .pareto import client_commission
from .quality import (
    drawn_rows,
    enforce_contract,
    preview,
    preview_of,
    previewed,
    reject_counts,
    split_contract,
    split_once,
)
from .snapshot import Dashboard, apply_merge, merged_day, plan_merge, todays_rows
from .sync import apply_sync, dead_letters, plan_sync, rejected_users, synced, target_ids
from .terms import (
    billed_of_buckets,
    billed_by_term,
    billed_by_term_all,
    billed_by_term_by_client,
    clients_by_term,
    clients_by_term_all,
    clients_by_term_by_client,
    clients_of_buckets,
    term_buckets,
    unbucketed,
)
from .versions import ConcurrentRefresh, apply_merge_versioned, current, drop_unnamed, put_new, read_version

__all__ = [
    "ConcurrentRefresh",
    "Dashboard",
    "annex_indicators",
    "annex_indicators_all",
    "annex_indicators_by_client",
    "annex_items",
    "apply_merge",
    "apply_merge_versioned",
    "apply_sync",
    "billed_by_term",
    "billed_by_term_all",
    "billed_by_term_by_client",
    "billed_of_buckets",
    "client_commission",
    "clients_by_term",
    "clients_by_term_all",
    "clients_by_term_by_client",
    "clients_of_buckets",
    "credit_days",
    "credit_days_all",
    "credit_days_by_client",
    "credit_days_of_groups",
    "current",
    "dead_letters",
    "drawn_rows",
    "drop_unnamed",
    "enforce_contract",
    "invoice_groups",
    "item_fields",
    "merged_day",
    "nested_fields",
    "open_fields",
    "pareto_of_groups",
    "plan_merge",
    "plan_sync",
    "preview",
    "preview_of",
    "previewed",
    "put_new",
    "rate_frequencies",
    "rate_indicators",
    "rate_indicators_all",
    "rate_indicators_by_client",
    "rates_of_groups",
    "reject_counts",
    "read_version",
    "rejected_users",
    "split_contract",
    "split_once",
    "synced",
    "target_ids",
    "term_buckets",
    "todays_rows",
    "unbucketed",
    "unique_clients",
]
