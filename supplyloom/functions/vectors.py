"""Vectors as ``array<double>`` columns.

Narrow linear maps are plain arithmetic, so they stay inside whole-stage
codegen. Wide ones would exceed the JVM's method size and fall out of it
(15 -> 20 unrolled is 15 times slower than this), so they go through one Arrow
batch product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR = T.ArrayType(T.DoubleType(), False)
NATIVE_TERMS = 64


def literal(values) -> Column:
    return F.lit([float(v) for v in values])


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def relu(x: Column) -> Column:
    return F.transform(x, lambda v: F.greatest(v, F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def linear_score(h_src: Column, h_dst: Column, weights, bias: float) -> Column:
    """``w . [h_src ; h_dst] + b``."""
    return dot(F.concat(h_src, h_dst), literal(weights)) + F.lit(float(bias))


def dot_score(h_src: Column, h_dst: Column) -> Column:
    return dot(h_src, h_dst)


def affine(inputs: list[tuple[str, np.ndarray]], bias: np.ndarray, rectify: bool = False) -> Column:
    """``sum(W_k x_k) + b`` for several (vector column, matrix) pairs, optionally through a ReLU."""
    if sum(w.size for _, w in inputs) <= NATIVE_TERMS:
        out = []
        for i, b in enumerate(bias):
            terms = [f"{float(w[i, j])!r}D * {x}[{j}]" for x, w in inputs for j in range(w.shape[1])]
            value = " + ".join([*terms, f"{float(b)!r}D"])
            out.append(f"greatest({value}, 0D)" if rectify else value)
        return F.expr(f"array({', '.join(out)})")

    matrices = [np.ascontiguousarray(w.T) for _, w in inputs]
    offset = np.asarray(bias, dtype=float)

    @F.arrow_udf(VECTOR)
    def product(*columns: pa.Array) -> pa.Array:
        total = np.tile(offset, (len(columns[0]), 1))
        for column, matrix in zip(columns, matrices):
            flat = column.flatten().to_numpy(zero_copy_only=False)
            total += flat.reshape(len(column), matrix.shape[0]) @ matrix
        if rectify:
            np.maximum(total, 0.0, out=total)
        starts = np.arange(0, total.size + 1, total.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(total.ravel()))

    return product(*[x for x, _ in inputs])
