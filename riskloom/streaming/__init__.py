"""Streams: scoring, windowed counts, late rows, and writing batches once."""

from riskloom.streaming.late_rows import late_report, mark_late, open_windows, replay
from riskloom.streaming.scoring import batch_writer, high_risk_by_window, read_stream, score_stream, write_batches, write_stream

__all__ = [
    "batch_writer", "high_risk_by_window", "late_report", "mark_late", "open_windows", "read_stream", "replay",
    "score_stream", "write_batches", "write_stream",
]
