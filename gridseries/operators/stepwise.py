"""Ordered walk-forward for any step model.

A step model is an object with ``fit`` and ``predict_one_step``. One entity's rows stream through it in order, as a
table function over ``PARTITION BY entity ORDER BY time``; it holds the last ``memory`` rows only, however long the
series is, and each prediction sees rows at or before t - step alone.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SeriesSpec, Split
from ..functions import time as tf
from .series import split_label

Row = tuple[int, float | None]


class StepModel(Protocol):
    """``history`` holds (epoch seconds, value) of the last ``memory`` rows, the newest last; a value may be None."""

    memory: int

    def fit(self, history: Sequence[Row]) -> None:
        """Called once, before the first row after the training window."""

    def predict_one_step(self, history: Sequence[Row], target: int) -> float | None:
        """The value expected at ``target`` (epoch seconds)."""


class LastValue:
    """The newest row's value."""

    memory = 1

    def fit(self, history: Sequence[Row]) -> None:
        return None

    def predict_one_step(self, history: Sequence[Row], target: int) -> float | None:
        return history[-1][1] if history else None


class SeasonalValue:
    """The value one season before, or else the newest row's."""

    def __init__(self, period: int, step: int):
        self.memory, self.back = period + 1, period * step

    def fit(self, history: Sequence[Row]) -> None:
        return None

    def predict_one_step(self, history: Sequence[Row], target: int) -> float | None:
        known = dict(history)
        return known[target - self.back] if target - self.back in known else history[-1][1] if history else None


def step_forecasts(series: DataFrame, spec: SeriesSpec, make: Callable[[], StepModel], name: str, split: Split | None = None) -> DataFrame:
    """One-step forecasts of every row by a model of each entity's own: (model, entity, ts, y_true, y_pred).

    ``make`` gives a new model. With a ``split``, ``fit`` sees the last ``memory`` training rows. Rows with
    equal times do not see one another.
    """
    e = spec.entity
    kinds = {c: series.schema[c].dataType.simpleString() for c in (e, spec.ts)}
    label = split_label(series, spec, split) if split else F.lit("test")
    rows = series.select(
        F.col(e).alias("entity"), F.col(spec.ts).alias("ts"), F.col(spec.value).cast("double").alias("value"),
        tf.epoch_seconds(series, spec.ts).cast("long").alias("at"), F.coalesce(label == "train", F.lit(False)).alias("train"),
    )
    step = spec.step

    class Walk:
        def __init__(self) -> None:
            self.model = make()
            self.history: deque[Row] = deque(maxlen=self.model.memory)
            self.waiting: deque[Row] = deque()
            self.fitted = False

        def eval(self, row: Any):
            while self.waiting and self.waiting[0][0] <= row["at"] - step:
                self.history.append(self.waiting.popleft())
            if not self.fitted and not row["train"]:
                self.model.fit(self.history)
                self.fitted = True
            predicted = self.model.predict_one_step(self.history, row["at"]) if self.fitted else None
            yield row["entity"], row["ts"], row["value"], None if predicted is None else float(predicted)
            self.waiting.append((row["at"], row["value"]))

    walk = F.udtf(Walk, returnType=f"entity {kinds[e]}, ts {kinds[spec.ts]}, y_true double, y_pred double")
    out = walk(rows.asTable().partitionBy("entity").orderBy("at"))
    return out.select(F.lit(name).alias("model"), F.col("entity").alias(e), F.col("ts").alias(spec.ts), "y_true", "y_pred")
