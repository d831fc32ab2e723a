"""Sources of raw lines and of stored results."""

from .files import read_events, read_log_files
from .kafka import (
    decode_kafka,
    kafka_read_options,
    kafka_write_options,
    read_kafka,
    write_kafka,
)
from .paced import read_paced_lines
from .results import load_json_results, parse_documents

__all__ = [
    "decode_kafka",
    "kafka_read_options",
    "kafka_write_options",
    "load_json_results",
    "parse_documents",
    "read_events",
    "read_kafka",
    "read_log_files",
    "read_paced_lines",
    "write_kafka",
]
