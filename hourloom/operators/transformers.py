"""The feature operators as ML pipeline stages."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from hourloom.operators import features


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keyword parameters become ML params, so stages persist with their pipeline."""


class ResidualLoad(_Stage):
    load = Param(Params._dummy(), "load", "load column", TypeConverters.toString)
    wind = Param(Params._dummy(), "wind", "wind column", TypeConverters.toString)
    solar = Param(Params._dummy(), "solar", "solar column", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "output column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, load="actual_load", wind="wind_generation", solar="solar_generation", output="residual_load"):
        super().__init__()
        self._setDefault(load="actual_load", wind="wind_generation", solar="solar_generation", output="residual_load")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = [self.getOrDefault(n) for n in (self.load, self.wind, self.solar)]
        return dataset.withColumn(self.getOrDefault(self.output), features.residual_load(*p))


class CalendarParts(_Stage):
    parts = Param(Params._dummy(), "parts", "calendar parts to add", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, parts=None):
        super().__init__()
        self._setDefault(parts=["hour", "day_of_week", "month", "is_weekend"])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.calendar_features(dataset, self.getOrDefault(self.parts))


class Lags(_Stage):
    columns = Param(Params._dummy(), "columns", "columns to lag", TypeConverters.toListString)
    lags = Param(Params._dummy(), "lags", "distances in hours", TypeConverters.toListInt)
    mode = Param(Params._dummy(), "mode", "time or rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, lags=None, mode="time"):
        super().__init__()
        self._setDefault(columns=[], lags=[], mode="time")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.lag_features(
            dataset, self.getOrDefault(self.columns), self.getOrDefault(self.lags), self.getOrDefault(self.mode)
        )


class RollingWindows(_Stage):
    """Statistics that include the current row and need a full window."""

    columns = Param(Params._dummy(), "columns", "columns to aggregate", TypeConverters.toListString)
    windows = Param(Params._dummy(), "windows", "window lengths in hours", TypeConverters.toListInt)
    aggregations = Param(Params._dummy(), "aggregations", "mean, std, min, max", TypeConverters.toListString)
    mode = Param(Params._dummy(), "mode", "time or rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, windows=None, aggregations=None, mode="time"):
        super().__init__()
        self._setDefault(columns=[], windows=[], aggregations=["mean", "std"], mode="time")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.rolling_features(
            dataset,
            self.getOrDefault(self.columns),
            self.getOrDefault(self.windows),
            self.getOrDefault(self.aggregations),
            min_periods=features.full_window,
            shift=0,
            mode=self.getOrDefault(self.mode),
            prefix="rolling",
        )
