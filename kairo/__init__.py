"""kairo — event-time operators for keyed event streams on Apache Spark.

Every operator takes a DataFrame plus column names and parameters and returns
a DataFrame.  Batch forms are plain Catalyst plans (windows, aggregations,
range exchanges); streaming forms use Structured Streaming watermarks,
windowed aggregation and ``transformWithState``.
"""

from kairo.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
