"""Column functions; all of them stay inside the JVM."""

from .agents import agent_details, browser, device, referrer_host
from .clf import (
    CLF_PATTERN,
    CLF_TIME_FORMAT,
    clf_line,
    hour_bucket,
    minute_bucket,
    parse_clf_ts,
    size_bytes,
    split_line,
)
from .keys import document_id, message_key, stamp, strip, with_message_key
from .network import ip_key, ipv4_to_long

__all__ = [
    "CLF_PATTERN",
    "CLF_TIME_FORMAT",
    "agent_details",
    "browser",
    "clf_line",
    "device",
    "document_id",
    "hour_bucket",
    "ip_key",
    "ipv4_to_long",
    "message_key",
    "minute_bucket",
    "parse_clf_ts",
    "referrer_host",
    "size_bytes",
    "split_line",
    "stamp",
    "strip",
    "with_message_key",
]
