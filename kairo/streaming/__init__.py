"""Structured Streaming forms (watermarks, windowed aggregation,
``transformWithState`` processors, state reader)."""

from kairo.streaming.time import as_event_time, bounded_out_of_order, never_late, punctuated
from kairo.streaming.forms import (
    jump_alert_stream, jump_alert_ttl_stream, running_count_stream, gate_stream,
    threshold_alert_stream, fire_risk_stream, rise_alert_stream, window_agg_stream,
    observe_stream, read_state, late_rows_stream, late_report_stream, late_window_stream,
    late_updates_stream, early_fire_stream, broadcast_threshold_stream,
    keyed_and_bucket_counts_stream, bucket_counts_stream, rolling_sum_stream,
    rolling_argmax_stream,
)

__all__ = [n for n in dir() if not n.startswith("_")]
