"""Structured Streaming: sinks and the job that runs the analyses."""

from .combined import combined_progress, read_combined, to_combined, write_combined
from .documents import read_refused_documents, send_documents, to_documents
from .job import (
    ANALYSES,
    analysis_frames,
    start_all,
    start_all_connector,
    status,
    stop,
    stop_all,
    wait_all,
)
from .rollups import read_rollup, roll_up, to_rollups
from .sinks import each_batch, search_index_options, to_connector, to_console, to_files, to_table, with_document_id
from .spikes import live_spikes
from .summaries import (
    merged, rank_error, read_summaries, stored_percentiles, stored_top_k, to_summaries, top_error, window_summaries
)

__all__ = [
    "ANALYSES",
    "analysis_frames",
    "combined_progress",
    "each_batch",
    "live_spikes",
    "merged",
    "rank_error",
    "read_combined",
    "read_refused_documents",
    "read_rollup",
    "read_summaries",
    "roll_up",
    "search_index_options",
    "send_documents",
    "start_all",
    "start_all_connector",
    "status",
    "stop",
    "stop_all",
    "stored_percentiles",
    "stored_top_k",
    "to_combined",
    "to_connector",
    "to_console",
    "to_documents",
    "to_files",
    "to_rollups",
    "to_summaries",
    "to_table",
    "top_error",
    "wait_all",
    "window_summaries",
    "with_document_id",
    "write_combined",
]
