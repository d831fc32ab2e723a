"""Operators: DataFrame in, DataFrame out."""

from .errors import error_events, error_trend
from .locate import check_ranges, locate, locate_networks
from .parse import add_buckets, format_clf, parse_clf, reject_counts, reject_fields, rejects
from .reports import (
    agent_stats,
    heat_map,
    product_stats,
    referrer_stats,
    spikes,
    status_distribution,
    top_k,
    value_percentiles,
)
from .tables import latest_per_key, refusal_reasons, retain, search, search_ranked, search_text, table_stats, upsert
from .windows import ip_activity, request_rate, traffic, url_activity, windowed_count

__all__ = [
    "add_buckets",
    "agent_stats",
    "check_ranges",
    "error_events",
    "error_trend",
    "format_clf",
    "heat_map",
    "ip_activity",
    "latest_per_key",
    "locate",
    "locate_networks",
    "parse_clf",
    "product_stats",
    "referrer_stats",
    "refusal_reasons",
    "reject_counts",
    "reject_fields",
    "rejects",
    "request_rate",
    "retain",
    "search",
    "search_ranked",
    "search_text",
    "spikes",
    "status_distribution",
    "table_stats",
    "top_k",
    "traffic",
    "upsert",
    "url_activity",
    "value_percentiles",
    "windowed_count",
]
