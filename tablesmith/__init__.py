"""tablesmith: Spark-native tabular profiling, feature preparation and model selection.

Every operator takes DataFrames plus parameters and returns a DataFrame; nothing is
collected to the driver except small fitted statistics (bounded by the number of
columns, classes or requested quantiles, never by the number of rows).
"""

from tablesmith.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
