"""Scoring of tables with user models."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def normalise_output(result: Any, names: Sequence[str]) -> pd.DataFrame:
    """A frame, array, sparse matrix or list of predictions as a frame with the given columns."""
    if hasattr(result, "toarray"):
        result = result.toarray()
    if isinstance(result, pd.Series):
        result = result.to_frame()
    if isinstance(result, pd.DataFrame):
        if list(result.columns) == list(names):
            return result
        result = result.to_numpy()
    if isinstance(result, (list, np.ndarray)):
        values = np.asarray(result)
        values = values.reshape(len(values), -1)
        if values.shape[1] != len(names):
            raise ValueError(f"model gave {values.shape[1]} columns, {len(names)} expected")
        return pd.DataFrame(values, columns=list(names))
    raise TypeError(f"unsupported prediction type: {type(result).__name__}")


def predict(
    df: DataFrame,
    model: Any,
    features: Sequence[str],
    output_schema: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Add the model's predictions to the ``keep`` columns.

    ``model.predict`` gets a frame of the feature columns per Arrow batch. The model is sent to
    the executors once, as a broadcast variable. A Spark ML model scores with ``transform``.
    """
    if hasattr(model, "transform") and not hasattr(model, "predict"):
        return model.transform(df)
    if not callable(getattr(model, "predict", None)):
        raise TypeError("model has no predict function")
    out = T.StructType.fromDDL(output_schema)
    kept = list(keep)
    features = list(features)
    schema = T.StructType([*[df.schema[c] for c in kept], *out.fields])
    shipped = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    names = out.fieldNames()

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = pickle.loads(shipped.value)
        for frame in frames:
            scored = normalise_output(scorer.predict(frame[features]), names)
            kept_part = frame[kept].reset_index(drop=True)
            yield pd.concat([kept_part, scored.reset_index(drop=True)], axis=1)

    needed = list(dict.fromkeys([*kept, *features]))
    return df.select(*needed).mapInPandas(score, schema)
