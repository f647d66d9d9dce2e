"""Hourly (and daily) time-series forecasting, quality and signal jobs on Spark.

Every operator is a ``DataFrame -> DataFrame`` function over rows of
``(series_key, ts, <double columns>)`` where ``ts`` is ``TIMESTAMP_NTZ`` in UTC.
"""

from hourloom.config import KEY, TS

__all__ = ["KEY", "TS"]
