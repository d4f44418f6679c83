from .carry import carried_delta, last_readings, late_keys, next_state
from .delta import Form, daily_delta, distinct_delta, pair_totals
from .gaps import risen_delta, spread_delta
from .lookup import join_lookup
from .shape import preview, renamed, union_tables

__all__ = [
    "Form", "carried_delta", "daily_delta", "distinct_delta", "join_lookup", "last_readings",
    "late_keys", "next_state", "pair_totals", "preview", "renamed", "risen_delta", "spread_delta",
    "union_tables",
]
