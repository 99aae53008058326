"""Batch scoring and the sample-transform surface.

``batch_score`` runs a user predictor over Arrow batches with ``mapInPandas``;
the model is loaded once per Python worker (cached by key) and reused across
batches and tasks.  Model files are not shipped through the driver: the loader
opens them on the executor.
"""

from __future__ import annotations

from functools import partial, reduce
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxwise.session import ship_package
from boxwise.sources.fsutil import resolve

_MODELS: dict[tuple, object] = {}


def _model(key: tuple, loader: Callable[[], object]) -> object:
    """The worker's model under ``key``, loaded at its first use."""
    if key not in _MODELS:
        _MODELS[key] = loader()
    return _MODELS[key]


def _scorer(key: tuple, loader, predict, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    model = _model(key, loader)
    for pdf in batches:
        yield predict(model, pdf)


def batch_score(images: DataFrame, loader: Callable[[], object], predict: Callable[[object, pd.DataFrame], pd.DataFrame],
                schema: str, *, key: str | None = None) -> DataFrame:
    """Detections for every image: ``predict(model, batch) -> DataFrame(schema)``.

    Workers find the cache by importing this module, so a model is loaded once
    per Python worker and application.  Models are told apart by the loader's
    module and name; give ``key`` where one loader stands for several models."""
    ship_package(images.sparkSession)
    name = getattr(loader, "__qualname__", None) or type(loader).__qualname__
    own = (images.sparkSession.sparkContext.applicationId, loader.__module__, name, key)
    return images.mapInPandas(partial(_scorer, own, loader, predict), schema)


# ---------------------------------------------------- a small trained detector ---

WEIGHTS = ("category_id", "n", "width", "height", "x", "y", "w", "h")
DETECTIONS = "det_id long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, score double"


def fit_prototypes(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """Weights of the prototype detector, one row per known category: the mean canvas of
    the images that show it and its mean box there."""
    a = annotations.join(categories.select(F.col("id").alias("category_id")), "category_id", "left_semi")
    j = a.join(images.select(F.col("id").alias("image_id"), "width", "height"), "image_id")
    return j.groupBy("category_id").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in WEIGHTS[2:]])


def save_weights(weights: DataFrame, path: str) -> None:
    """Write the weights (a row per category) as one file below ``path``."""
    weights.select(*WEIGHTS).coalesce(1).write.mode("errorifexists").parquet(path)


class PrototypeLoader:
    """Opens the weights file where it is called: on an executor, once per Python worker."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self) -> dict[str, np.ndarray]:
        import pyarrow.dataset as pads
        fs, root = resolve(self.path)
        table = pads.dataset(root, filesystem=fs, format="parquet").to_table(columns=list(WEIGHTS)).sort_by("category_id")
        return {c: table.column(c).to_numpy() for c in WEIGHTS}


def predict_prototypes(model: dict[str, np.ndarray], pdf: pd.DataFrame, k: int = 2) -> pd.DataFrame:
    """The ``k`` categories whose mean canvas is nearest to each image's (ties: the smaller
    id), each with its mean box scaled to the image; the score falls with the distance."""
    w, h = (pdf[c].to_numpy(float)[:, None] for c in ("width", "height"))
    gap = (w - model["width"]) * (w - model["width"]) + (h - model["height"]) * (h - model["height"])
    near = np.argsort(gap, axis=1, kind="stable")[:, :k]
    rows, rank = np.repeat(np.arange(len(pdf)), near.shape[1]), np.tile(np.arange(near.shape[1]), len(pdf))
    c = near.ravel()
    sx, sy = pdf["width"].to_numpy(float)[rows] / model["width"][c], pdf["height"].to_numpy(float)[rows] / model["height"][c]
    x1, y1 = model["x"][c] * sx, model["y"][c] * sy
    return pd.DataFrame({"det_id": pdf["id"].to_numpy()[rows] * 10 + rank, "image_id": pdf["id"].to_numpy()[rows],
                         "category_id": model["category_id"][c], "x1": x1, "y1": y1, "x2": x1 + model["w"][c] * sx,
                         "y2": y1 + model["h"][c] * sy, "score": 1 / (1 + np.sqrt(gap[rows, c]) / 100)})


def sample_transform(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a per-sample (vectorised over a batch) pandas function."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def compose(*fns: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A chain of ``DataFrame -> DataFrame`` steps, applied in order."""
    return lambda df: reduce(lambda d, f: d.transform(f), fns, df)


def requires(*cols: str):
    """Decorator for a transform step that needs certain input columns."""
    def deco(fn):
        def wrapped(df: DataFrame, *a, **k):
            missing = [c for c in cols if c not in df.columns]
            if missing:
                raise KeyError(f"{fn.__name__} needs columns {missing}")
            return fn(df, *a, **k)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        return wrapped
    return deco
