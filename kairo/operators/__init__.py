"""Batch forms of the event-time operators."""

from kairo.operators.windows import (
    window_agg, window_avg_celsius, window_avg, window_min, window_min_max,
    window_count, window_elementwise_max, early_fire,
)
from kairo.operators.rolling import (
    rolling_sum, rolling_argmax, running_count, keyed_and_bucket_counts,
    bucket_counts,
)
from kairo.operators.alerts import jump_alert, jump_alert_ttl
from kairo.operators.rise import rise_alert
from kairo.operators.control import (
    gate, latest_level, fire_risk, threshold_alert, threshold_table,
)
from kairo.operators.late import (
    arrival_watermark, flag_late, late_rows, late_counts, late_window_split,
    late_updates,
)
from kairo.operators.route import route, split, freezing_monitor, router, observe_count

__all__ = [n for n in dir() if not n.startswith("_")]
