"""Fits of small models on bounded samples, in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """What ``fit`` makes of a sample that a parameter bounds: numbers and numpy arrays.

    It runs in a task, so the sample never comes to the driver and a lost executor costs another try.
    """
    schema = sample.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(fit(pa.Table.from_batches(held)))], pa.binary())})

    row = sample.coalesce(1).mapInArrow(run, "model binary").first()
    if row is None:
        return fit(pa.table({f.name: pa.array([], pa.null()) for f in schema.fields}))
    return pickle.loads(bytes(row["model"]))
