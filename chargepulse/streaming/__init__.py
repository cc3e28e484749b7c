"""Structured Streaming: the three apps, running totals, per-batch results, resume."""

from chargepulse.streaming.apps import (
    compact, notify_app, notify_results, ods_app, read_ods, read_batch_partials, read_partials, read_quarantine, redrive_notify, redrive_request,
    request_app, request_results, topup_app, topup_results,
)
from chargepulse.streaming.control import ask_to_stop, run_until_stopped, stop_cleanly
from chargepulse.streaming.jobs import (
    console, late_rows, per_batch, progress_ledger, raw_to_files, read_totals, resume_positions, run_to_end, running_totals,
    watermarked_totals,
)
from chargepulse.streaming.sinks import (
    ChangelogUpsert, PerBatchWriter, claim_output, jdbc_options, read_batches, read_current, snapshot,
    write_jdbc,
)

__all__ = [
    "compact", "notify_app", "notify_results", "read_partials", "read_batch_partials", "read_quarantine", "ods_app", "read_ods", "redrive_notify",
    "redrive_request", "ask_to_stop", "run_until_stopped", "stop_cleanly", "snapshot", "late_rows", "read_totals", "watermarked_totals", "request_app", "request_results",
    "topup_app", "topup_results", "console", "per_batch", "progress_ledger", "raw_to_files",
    "resume_positions", "run_to_end", "running_totals", "ChangelogUpsert", "PerBatchWriter",
    "claim_output", "jdbc_options", "read_batches", "read_current", "write_jdbc",
]
