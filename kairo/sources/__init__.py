"""Sources: batch readers over the driver tables, derived control streams
and replayed streams (S1, S2)."""

from kairo.sources.tables import (
    read_table, readings, levels_from_events, thresholds_from_events,
    switches_from_events,
)
from kairo.sources.replay import replay_stream, split_for_replay

__all__ = [
    "read_table", "readings", "levels_from_events", "thresholds_from_events",
    "switches_from_events", "replay_stream", "split_for_replay",
]
